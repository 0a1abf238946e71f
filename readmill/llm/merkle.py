"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text.

A section is what stands between line breaks; a paragraph is a sentence-like piece of it, of at
most ``PIECE`` characters before its closing marks. Paragraphs, joined, give the section
back, and sections joined by line breaks give the text, so that the root stands for the
text. A leaf is the hash of a paragraph, a branch the hash of the leaves of a section, the
root the hash of the branches.

Written out, a fingerprint is ``root|branch=leaf.leaf;branch=leaf``, with the root in full
and the other hashes cut to ``SHORT`` digits. Equal roots mean equal texts. Where roots
differ, ``changed_sections`` names the branches that differ, and ``likeness`` is the share of
leaves in common: 2 * common / (leaves of one + leaves of the other), distinct leaves each.

All of it is built-in functions. ``next_texts`` gives each row its successor in falling order of
``doc_id`` with one shuffle of the texts, dealt out by ranges of ids that hold about
``ROWS_PER_RANGE`` rows each.

A NULL or empty text has one section with one empty leaf-less branch. Rows with one ``doc_id``
follow each other by text; rows without come last; a table of one row follows itself; an
empty table gives an empty result. Only ``doc_id`` and ``text`` are read, so that other
columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = 160
PARAGRAPH = rf"[^.!?]{{1,{PIECE}}}[.!?]{{0,16}}|[.!?]{{1,16}}"
SHORT = 12
ROWS_PER_RANGE = 2_048
#: The borders of the ranges are held by the plan; beyond so many, ranges grow instead.
MAX_RANGES = 4_096


def fingerprint(text: Column) -> Column:
    sections = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda line: F.transform(F.regexp_extract_all(line, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.md5(p)),
    )
    branches = F.transform(
        sections,
        lambda leaves: F.struct(
            F.md5(F.array_join(leaves, ".")).alias("hash"),
            F.array_join(F.transform(leaves, lambda leaf: F.substring(leaf, 1, SHORT)), ".").alias("leaves"),
        ),
    )
    return F.transform(
        F.array(branches),  # names the branches once
        lambda b: F.concat(
            F.sha2(F.array_join(F.transform(b, lambda x: x["hash"]), ";"), 256),
            F.lit("|"),
            F.array_join(F.transform(b, lambda x: F.concat(F.substring(x["hash"], 1, SHORT), F.lit("="), x["leaves"])), ";"),
        ),
    )[0]


def root(mark: Column) -> Column:
    return F.substring_index(mark, "|", 1)


def leaves(mark: Column) -> Column:
    """Distinct leaves of a written fingerprint."""
    below = F.substring_index(mark, "|", -1)
    parts = F.flatten(F.transform(F.split(below, ";"), lambda b: F.split(F.substring_index(b, "=", -1), r"\.")))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def likeness(one: Column, other: Column) -> Column:
    """1 for equal roots; else the share of common leaves, from 0 to 1."""
    common = F.transform(
        F.array(F.struct(leaves(one).alias("a"), leaves(other).alias("b"))),
        lambda x: (2 * F.size(F.array_intersect(x["a"], x["b"]))).cast("double")
        / F.greatest(F.size(x["a"]) + F.size(x["b"]), F.lit(1)),
    )[0]
    return F.when(root(one) == root(other), F.lit(1.0)).otherwise(common)


def changed_sections(one: Column, other: Column) -> Column:
    """Numbers (from 0) of the sections of ``one`` whose branch the other fingerprint doesn't have."""
    branches = lambda mark: F.split(F.substring_index(mark, "|", -1), ";")
    places = F.transform(branches(one), lambda b, i: F.when(~F.array_contains(branches(other), b), i))
    return F.filter(places, lambda i: i.isNotNull())


def _borders(docs: DataFrame, rows_per_range: int) -> list[int]:
    """Ids that cut the rows into ranges of about so many rows; approximate, which only moves the cuts."""
    n = min(MAX_RANGES, -(-docs.count() // rows_per_range))
    if n < 2:
        return []
    shares = [i / n for i in range(1, n)]
    return sorted({int(x) for x in docs.approxQuantile("doc_id", shares, 1 / (4 * n))})


def _range(doc_id: Column, borders: list[int]) -> Column:
    """How many borders are at or below the id: a binary search in the sorted borders."""
    if not borders:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast("long") for b in borders])
    steps = [1 << k for k in reversed(range(len(borders).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(borders)) & (F.element_at(table, F.least(at + step, F.lit(len(borders)))) <= doc_id), at + step
        ).otherwise(at),
    )


def next_texts(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, text, mark, next_text and next_mark; the last row's successor is the first."""
    borders = _borders(docs.select("doc_id"), rows_per_range)
    at = F.coalesce(_range(F.col("doc_id"), borders), F.lit(0))
    heads = docs.select("doc_id", at.alias("range")).groupBy("range").agg(F.max("doc_id").alias("head"))
    # A row per range: the id that its order begins with, which also ends the range above it.
    found = sorted(((r["range"], r["head"]) for r in heads.collect()), reverse=True)
    ends = [
        F.struct(F.lit(head).cast("long").alias("head"), F.lit(above).alias("range"))
        for (_, head), (above, _) in zip(found, found[-1:] + found[:-1])
    ]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if not ends:
        return rows.select("*", *[F.lit(None).cast("string").alias(c) for c in ("mark", "next_text", "next_mark")])
    known = [h for _, h in found if h is not None]
    first = F.col("doc_id").isin(known) if len(known) == len(found) else F.col("doc_id").isin(known) | F.col("doc_id").isNull()
    table = F.array(*ends)
    closing = (
        rows.where(first)
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", F.explode(F.filter(table, lambda e: e["head"].eqNullSafe(F.col("doc_id")))).alias("e"))
        .select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("e.range").alias("range"), F.lit(1).alias("closing"))
    )
    dealt = rows.select("doc_id", "text", at.alias("range"), F.lit(0).alias("closing")).unionByName(closing)
    marked = dealt.withColumn("mark", fingerprint(F.col("text")))
    order = Window.partitionBy("range").orderBy("closing", F.desc_nulls_last("doc_id"), "text")
    return (
        marked.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_mark", F.lead("mark").over(order))
        .where("closing = 0")
        .drop("closing", "range")
    )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """The digest columns for every document and its edited text."""
    third = F.expr("n_chars div 3")
    pairs = next_texts(docs.select("doc_id", "text")).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.concat(
        F.substring("text", 1, (F.col("n_chars") - third).cast("int")), F.substring("next_text", 1, third.cast("int"))
    )
    changed = pairs.withColumn("edited", edited).withColumn("edited_mark", fingerprint(F.col("edited")))
    return changed.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("mark").alias("fingerprint"),
        F.col("edited_mark").alias("edited_fingerprint"),
        likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
        likeness(F.col("mark"), F.col("next_mark")).alias("near_next"),
    )
