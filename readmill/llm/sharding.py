"""Sharding by proportional stratified interleaving.

Rows are shuffled with a seed inside their source and ranked; the rank divided by the
source's rows is the row's place in [0, 1]. Sorting all rows by that place interleaves the
sources in proportion, so that any cut of the order holds the whole mixture: a shard has
its share of every source to within a row or so. Cutting at equal counts gives the law
``rows``. Both ranks are distributed prefix sums; no source and no shard meets in one task.

Groups of equal texts are not kept together: a large one would break the law.

Nulls and odd rows: a NULL source is a source of its own and sorts last; a NULL text has
size 1 and the check sum of the empty text; repeated rows are rows; an empty table gives
an empty result; extra columns pass through, except ``shard`` and ``slot``, which are replaced, and
names that begin with an underscore, which are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.llm.columns import passed
from readmill.llm.prefix import running_sum, unit_number
from readmill.session import materialise

SHARDS = 8
SEED = "shard-1"


def interleave(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, tie: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (``doc_id`` and ``source`` are read).

    ``tie`` orders rows with one ``doc_id``. ``docs`` is read several times; pass a
    narrow, materialised table and join wide columns back, or write it first.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    docs = passed(docs, ("shard", "slot"))
    counts = docs.groupBy("source").agg(F.count("*").alias("_rows"))
    total = max(docs.count(), 1)
    keyed = docs.withColumn("_key", digest).withColumn("_unit", unit_number(F.col("_key"))).withColumn("_one", F.lit(1))
    counted = keyed.join(counts.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    ranked = running_sum(counted, ["source"], "_unit", "_rows", ["_key", "doc_id", tie], "_one", "_rank")
    place = (2 * F.col("_rank") + 1).cast("double") / (2 * F.col("_rows")).cast("double")
    order = ["_place", F.col("source").isNull(), "source", "doc_id", tie]
    placed = materialise(ranked.withColumn("_place", place).drop("_rank", "_rows", "_source"), "shard-places")
    placed = placed.withColumn("_all", F.lit(total))
    sorted_rows = running_sum(placed, [], "_place", "_all", order, "_one", "_at")
    # Shard k begins at row floor(k * total / shards).
    shard = F.expr(f"((_at + 1) * {shards} - 1) div {total}")
    begin = F.expr(f"(cast(shard as bigint) * {total}) div {shards}")
    return (
        sorted_rows.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("_at") - begin).cast("long"))
        .drop("_key", "_unit", "_one", "_all", "_place", "_at")
    )


def text_sums(text: Column) -> tuple[Column, Column]:
    whole = F.coalesce(text, F.lit(""))
    return (F.octet_length(whole) + 1).cast("long"), F.crc32(F.encode(whole, "utf-8")).cast("long")


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The digest columns for every document; texts are read once."""
    size, crc = text_sums(F.col("text"))
    narrow = materialise(
        docs.select("doc_id", "source", size.alias("size"), crc.alias("text_crc32")), "shard-rows"
    )
    return interleave(narrow, shards, tie="text_crc32").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
