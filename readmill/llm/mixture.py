"""Mixing sources to target weights.

Rows get hash-random keys, are sorted by them within each source, and a distributed
prefix sum of sizes cuts the order at the source's budget. A budget above the source's
size repeats whole epochs and cuts the last one. Reruns give the same mix.

Nulls and odd rows: a NULL source is a source of its own and comes last; a NULL text or
one without words has size 0 and is never taken; a NULL ``doc_id`` hashes as such;
repeated rows count each; an empty table gives an empty result. Other columns pass
through ``mix_documents`` untouched, except names that it makes itself, which are replaced,
and names that begin with an underscore, which are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readmill.llm.columns import passed
from readmill.llm.prefix import running_sum, unit_number
from readmill.session import materialise

#: Weights by the source's place in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source is taken more often than this.
MAX_EPOCHS = 3
SEED = "mix-1"
#: Spark's form of "a run of characters that are not ASCII white space".
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source: rows, size, weight and target (``source``, ``size`` are read).

    All sizes are shared by weight. A source whose share is above ``max_epochs`` times
    its size stops there; what is left over is shared again by weight. Sorted by
    capacity per weight, the sources that stop are a prefix, found with running sums.
    The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    order = Window.partitionBy().orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(w) for w in weights])
    place = (F.row_number().over(order) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(cycle, (place + 1).cast("int")).cast("long"))
    everything = Window.partitionBy()
    exact = "decimal(38,0)"
    limits = (
        weighted.withColumn("_limit", (F.col("source_size") * max_epochs).cast(exact))
        .withColumn("_all", F.sum(F.col("source_size").cast(exact)).over(everything))
        .withColumn("_weights", F.sum("weight").over(everything))
        .withColumn("_ratio", F.col("_limit").cast("double") / F.col("weight"))
    )
    before = (
        Window.partitionBy()
        .orderBy("_ratio", F.col("source").isNull(), "source")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    left = (
        limits.withColumn("_left", F.col("_all") - F.coalesce(F.sum("_limit").over(before), F.lit(0).cast(exact)))
        .withColumn("_shares", F.col("_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "_stops",
            F.col("_limit").cast("double") * F.col("_shares") <= F.col("_left").cast("double") * F.col("weight"),
        )
    )
    stopped = F.sum(F.when(F.col("_stops"), F.col("_limit")).otherwise(F.lit(0).cast(exact))).over(everything)
    stopped_weight = F.sum(F.when(F.col("_stops"), F.col("weight")).otherwise(0)).over(everything)
    share = (F.col("weight").cast("double") * (F.col("_all") - stopped).cast("double")) / (
        F.col("_weights") - stopped_weight
    ).cast("double")
    return left.select(
        "source",
        "source_rows",
        "source_size",
        "weight",
        F.when(F.col("_stops"), F.col("_limit").cast("double")).otherwise(share).alias("target"),
    )


def mix_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    size: Column | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` for each row.

    ``taken`` counts words with repeats: whole epochs, and of the last epoch what lies
    before the cut. The row at the cut is taken in part, so that a source's sum is its
    target rounded to a whole word.
    """
    size = word_count(F.col("text")) if size is None else size
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    made = ("size", "source_size", "target", "taken", "source_rows")
    sized = docs.drop("_size").withColumn("_size", size)
    keyed = sized.select(*[F.col(f"`{c}`") for c in passed(docs, made).columns], F.col("_size").alias("size"))
    keyed = keyed.withColumn("_key", digest)
    targets = source_targets(keyed.select("source", "size"), weights, max_epochs)
    budget = F.floor(F.col("target") + 0.5).cast("long")
    targets = targets.select(
        F.col("source").alias("_source"), "source_rows", "source_size", "target", budget.alias("_budget")
    )
    joined = keyed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    placed = running_sum(
        joined.withColumn("_unit", unit_number(F.col("_key"))),
        ["source"], "_unit", "source_rows", ["_key", "doc_id", "size"], "size", "_before",
    )
    epochs = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0))
    rest = F.col("_budget") - epochs * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("_before"), F.lit(0)), F.col("size"))
    return placed.withColumn("taken", (epochs * F.col("size") + part).cast("long")).drop(
        "_key", "_unit", "_source", "_budget", "_before", "source_rows"
    )


def mixture_table(docs: DataFrame) -> DataFrame:
    """The digest columns for every document; texts are read once, for their sizes."""
    sizes = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mixture-sizes")
    mixed = mix_documents(sizes, size=F.col("size"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
