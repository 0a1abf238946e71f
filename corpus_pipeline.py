"""From documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept. All but the last return the columns of ``documents``;
the last returns where each piece of each document lies in the training sequences.

Nulls, empty and very long texts, repeated rows and clashing column names are handled as
the operators' descriptions say; a stage that gets an empty table returns an empty one. A
row without ``doc_id`` or ``text`` passes the first three stages unless they reject it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readmill.llm.mixture import mix_documents, word_count
from readmill.llm.packing import pack_documents
from readmill.llm.passage_dedup import dedup_passages
from readmill.llm.superminhash import near_duplicate_rows
from readmill.llm.toxicity import fit_on, score
from readmill.session import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is (or, with ``left_anti``, is not) among ``id``."""
    return docs.select(*COLUMNS).join(ids, F.col("doc_id").eqNullSafe(F.col("id")), how)


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` and text together are not among ``rejected``."""
    ids = rejected.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("hash"))
    return docs.select(*COLUMNS).join(ids, same, "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    model = fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, score(docs, model).where("predicted = 1"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of words go; a document that consists of them alone goes too."""
    clean = dedup_passages(docs.select(*COLUMNS))
    left = F.col("runs").isNull() | F.col("clean_text").rlike(r"[^\x20\x09-\x0D]")
    return clean.where(left).select(
        "doc_id",
        F.col("clean_text").alias("text"),
        "lang",
        "source",
        F.when(F.col("runs").isNull(), F.col("n_chars")).otherwise(F.length("clean_text")).cast("long").alias("n_chars"),
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    Rows that share ``doc_id`` and text are one document; of equal texts without ``doc_id`` one row stays.
    """
    dropped = near_duplicate_rows(docs).where("NOT kept")
    docs = docs.select(*COLUMNS)
    bare = F.col("doc_id").isNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    once = docs.where(bare).groupBy("text").agg(F.min(F.struct("doc_id", "lang", "source", "n_chars")).alias("row"))
    once = once.select("row.*", "text").select(*COLUMNS)
    return _without(docs.where(~bare).unionByName(once), dropped)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole copy.

    The document at a source's cut stays if at least half of it lies before the cut. A
    document without words has no share in any budget, and is kept once.
    """
    sizes = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mixing-sizes")
    mixed = mix_documents(sizes, size=F.col("size")).select("doc_id", "size", "taken")
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    # Rows that share a doc_id are copied alike.
    wanted = mixed.select(F.col("doc_id").alias("id"), copies.alias("copies")).groupBy("id").agg(F.max("copies").alias("copies"))
    joined = _with_text(docs, wanted.where("copies > 0"), "inner")
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every copy with its place in a training sequence."""
    return pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: A trained classifier and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
