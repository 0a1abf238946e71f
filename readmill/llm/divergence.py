"""Source divergence audit: how the words of a source differ from those of its language.

Terms are runs of ASCII letters and of characters beyond ASCII, A-Z in lower case. Each language keeps the
terms that at least ``MIN_DOCS`` of its documents hold; V is their number. For a (lang, source) group and for a
language a kept term of ``count`` occurrences there has the smoothed share
``1 + floor(UNIT * (count + SMOOTHING) / (N + SMOOTHING * V))``, N being all occurrences of kept terms.
All of it is whole numbers.

*Pairs.* Each two sources of a language are held against each other over all kept terms. Terms that
neither holds differ alike, so that only what terms make beyond that is added up: counts go by
(blocks of ``BLOCK`` sources twice, share of the terms) to tasks that lay them out as matrices of terms and
sources, a bounded number of cells at a time.

*Terms.* A group's terms whose share is above the language's are ranked by the difference. A term is
*dominated* by one with no lower count in the group, no higher count in the language and an earlier place in
UTF-8 order: that one ranks before it, whatever the totals are. So each task keeps, of each group, the skyband of
terms that fewer than ``TOP`` others dominate, before any total is known; the skybands of all tasks are merged into
one in the same way, and what is left is ranked exactly. A task holds one group's skyband and a buffer.

Counting combines words within each task, in tables of bounded size, and goes through one shuffle by (lang, term).
A document's word counts once towards documents however often it stands in it. NULL text, lang and
source are empty text; a text without terms still makes its group. Rows count one by one, whether or not
they repeat. A language without kept terms gives pairs of value 0. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readmill.llm.batches import map_arrow, slices
from readmill.session import materialise

MIN_DOCS = 30
TOP = 50
UNIT = 1_000_000_000
SMOOTHING = 5
#: Entries of a task's word tables before they are sent on.
TABLE = 300_000
#: Sources laid out together, shares that a language's terms are dealt to, and cells of a matrix.
BLOCK = 256
SHARES = 64
CELLS = 1 << 20
#: Terms that are held against a skyband at once, and rows that wait for it.
STEP = 512
WAITING = 1 << 16

_UPPER = range(0x41, 0x5B)
#: Bytes of terms, A-Z in lower case; all others are space.
_LETTERS = bytes(b + 32 if b in _UPPER else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (words, documents) in counts.items():
            terms = list(words)
            made = [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(list(words.values()), pa.int64()),
                pa.array([documents[t] for t in terms], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(made, ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for part, texts in slices(batch, "text"):
            keys = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
            for key, text in zip(keys, texts):
                found = text.encode().translate(_LETTERS).split()
                words, documents = counts.setdefault(key, (Counter(), Counter()))
                before = len(words)
                words.update(found)
                documents.update(set(found))
                held += len(words) - before
                if held > TABLE:
                    yield from rows()
                    counts, held = {}, 0
    yield from rows()


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, total (occurrences) and ``sources`` (source, n) of every kept term."""
    narrow = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = map_arrow(narrow, _counted, "lang string, source string, term string, n long, docs long")
    # One shuffle serves both groupings.
    dealt = counted.repartition("lang", "term")
    by_source = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return by_term.where(F.col("docs") >= min_docs).drop("docs")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per (lang, source): place among the language's sources, n, v, lang_n.

    ``n`` and ``lang_n`` are the group's and the language's occurrences of kept terms, ``v`` their number.
    """
    present = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    by_group = kept.select("lang", F.inline("sources")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    joined = present.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
    return joined.select("lang", "source", place.alias("place"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n")])


def _share(count: str, total: str, terms: str) -> Column:
    """The smoothed share, exact also where the product is beyond a long; NULL without terms."""
    above = f"CAST({count} + {SMOOTHING} AS DECIMAL(19,0)) * CAST({UNIT} AS DECIMAL(10,0))"
    return F.expr(f"1 + ({above}) DIV NULLIF(CAST({total} + {SMOOTHING} * {terms} AS DECIMAL(19,0)), 0)")


def _shares(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The same for arrays: the quotient is found three digits at a time."""
    rest, quotient = counts + SMOOTHING, np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        quotient = quotient * 1000 + rest // below
        rest = rest % below
    return quotient + 1


def skyband(count: np.ndarray, total: np.ndarray, terms: list[bytes], top: int = TOP) -> np.ndarray:
    """Places of the terms that fewer than ``top`` others dominate.

    In the order of count, total and term a term comes after those that dominate it. One that is left
    out need not be counted later: what it dominates, its own dominators dominate as well.
    """
    rank = np.empty(len(terms), dtype=np.int64)
    rank[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    order = np.lexsort((rank, total, -count))
    kept = np.zeros(0, dtype=np.int64)
    for begin in range(0, len(order), STEP):
        new = order[begin : begin + STEP]
        under = lambda old: (total[old][None, :] <= total[new][:, None]) & (rank[old][None, :] < rank[new][:, None])
        dominators = under(kept).sum(axis=1) + np.tril(under(new), -1).sum(axis=1)
        kept = np.concatenate((kept, new[dominators < top]))
    return kept


def _skybands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The skyband of each group among a task's rows, whatever their order."""
    held: dict[tuple[str, str], list[pa.Table]] = {}
    waiting: Counter = Counter()
    names = ["term", "n", "total"]

    def shrink(key: tuple[str, str]) -> None:
        table = pa.concat_tables(held[key])
        terms = [t.encode() for t in table.column("term").to_pylist()]
        count, total = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "total"))
        held[key] = [table.take(pa.array(skyband(count, total, terms)))]
        waiting[key] = 0

    for batch in batches:
        keys = batch.select(["lang", "source"]).to_pandas()
        for key, rows in keys.groupby(["lang", "source"], sort=False).indices.items():
            part = pa.Table.from_batches([batch.select(names)]).take(pa.array(rows))
            held.setdefault(key, []).append(part)
            waiting[key] += len(rows)
        if sum(waiting.values()) > WAITING:
            for key in [k for k, n in waiting.items() if n]:
                shrink(key)
    for key in held:
        shrink(key)
        made = held[key][0].combine_chunks()
        labels = [pa.array([k] * len(made), pa.string()) for k in key]
        for batch in pa.table([*labels, *made.columns], ["lang", "source", *names]).to_batches():
            yield batch


def distinctive_terms(kept: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank: the ``top`` terms of each group whose share exceeds the language's most."""
    schema = "lang string, source string, term string, n long, total long"
    counts = kept.select("lang", "term", "total", F.inline("sources")).select("lang", "source", "term", "n", "total")
    local = map_arrow(counts, _skybands, schema)
    merged = map_arrow(local.repartition("lang", "source"), _skybands, schema)
    group = totals.select("lang", "source", F.col("n").alias("group_n"), "v", "lang_n")
    valued = merged.join(group, ["lang", "source"])
    valued = valued.withColumn("value", _share("n", "group_n", "v") - _share("total", "lang_n", "v")).where("value > 0")
    return _ranked(valued.select("lang", "source", F.col("term").alias("item"), "value")).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each unit of a sorted partition what its terms make each pair of sources differ beyond absent terms."""
    unit, sources, waiting, cells = None, [], [], 0
    sums = below = absent = None

    def lay_out() -> None:
        nonlocal sums, waiting, cells
        lists = pa.chunked_array(waiting).combine_chunks()
        entries = lists.flatten()
        owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        counts = np.zeros((len(lists), len(sources)), dtype=np.int64)
        place = pa.array([s[0] for s in sources])
        column = pa.compute.index_in(entries.field("source"), value_set=place).to_numpy(zero_copy_only=False)
        counts[owner, column.astype(np.int64)] = entries.field("n").to_numpy(zero_copy_only=False)
        shares = _shares(counts, below)
        for g in range(len(sources)):
            sums[g] += np.abs(shares - shares[:, g : g + 1]).sum(axis=0) - len(lists) * np.abs(absent - absent[g])
        waiting, cells = [], 0

    def finish() -> Iterator[pa.RecordBatch]:
        if waiting:
            lay_out()
        if sums is not None:
            lang, a, b = unit[:3]
            pairs = [(g, h) for g in range(len(sources)) for h in range(len(sources))
                     if g != h and (a == b or sources[g][1] != sources[h][1])]
            made = [
                pa.array([lang] * len(pairs), pa.string()),
                pa.array([sources[g][0] for g, _ in pairs], pa.string()),
                pa.array([sources[h][0] for _, h in pairs], pa.string()),
                pa.array([int(sums[g, h]) for g, h in pairs], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(made, ["lang", "source", "item", "beyond"])

    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in ("lang", "a", "b", "share")]))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for begin, end in zip(cuts, cuts[1:]):
            if begin == end:
                continue
            if keys[begin] != unit:
                yield from finish()
                unit, sources, waiting, cells, sums = keys[begin], [], [], 0, None
            rows = batch.slice(begin, end - begin)
            is_source = rows.column("source").is_valid().to_numpy(zero_copy_only=False)
            for r in rows.filter(pa.array(is_source)).select(["source", "block", "n", "v"]).to_pylist():
                sources.append((r["source"], r["block"], r["n"], r["v"]))
            lists = rows.filter(pa.array(~is_source)).column("sources")
            # Sources come first in a unit.
            if len(lists) and sums is None:
                sums = np.zeros((len(sources), len(sources)), dtype=np.int64)
                below = np.array([n + SMOOTHING * v for *_, n, v in sources], dtype=np.int64)
                absent = _shares(np.zeros(len(sources), dtype=np.int64), below)
            step = max(1, CELLS // max(len(sources), 1))
            for at in range(0, len(lists), step):
                part = lists.slice(at, step)
                waiting.append(part)
                cells += len(part) * len(sources)
                if cells > CELLS:
                    lay_out()
    yield from finish()


def source_pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: how far each two sources of a language are apart over its kept terms."""
    most = totals.groupBy("lang").count().agg(F.coalesce(F.max("count"), F.lit(0))).head()[0]
    blocks = max(1, -(-most // BLOCK))
    block = lambda source: F.pmod(F.xxhash64(source), F.lit(blocks)).cast("int")
    numbers = F.sequence(F.lit(0), F.lit(blocks - 1))
    listed = totals.select("lang", "source", block(F.col("source")).alias("block"), "n", "v", F.explode(numbers).alias("other"))
    listed = listed.select(
        "lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"), "source", "block", "n", "v",
        F.lit(None).cast("array<struct<source:string,n:bigint>>").alias("sources"),
    )
    units = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(blocks) for b in range(a, blocks)])
    dealt = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(SHARES)).cast("int").alias("share"), "sources", F.inline(units))
    inside = F.filter("sources", lambda s: block(s["source"]).isin(F.col("a"), F.col("b")))
    terms = dealt.select(
        "lang", "a", "b", "share", F.lit(None).cast("string").alias("source"), F.lit(None).cast("int").alias("block"),
        F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("v"), inside.alias("sources"),
    ).where(F.size("sources") > 0)
    key = ["lang", "a", "b", "share"]
    rows = listed.unionByName(terms).repartition(*key).sortWithinPartitions(*key, F.col("source").asc_nulls_last())
    beyond = map_arrow(rows, _differences, "lang string, source string, item string, beyond long")
    beyond = beyond.groupBy("lang", "source", "item").agg(F.sum("beyond").alias("beyond"))
    group = totals.select("lang", "source", "v", _share("0", "n", "v").alias("absent"))
    other = totals.select("lang", F.col("source").alias("item"), _share("0", "n", "v").alias("other_absent"))
    pairs = group.join(other, "lang").where("source != item").join(beyond, ["lang", "source", "item"], "left")
    value = F.when(F.col("v") > 0, F.col("v") * F.abs(F.col("absent") - F.col("other_absent")) + F.coalesce("beyond", F.lit(0)))
    return _ranked(pairs.select("lang", "source", "item", F.coalesce(value, F.lit(0)).cast("long").alias("value")))


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank."""
    kept = materialise(term_counts(docs, min_docs), "audit-terms")
    totals = materialise(group_totals(docs, kept), "audit-groups")
    columns = ("lang", "source", "part", "item", "value", "rank")
    pairs = source_pairs(kept, totals).withColumn("part", F.lit("pair"))
    terms = distinctive_terms(kept, totals, top).withColumn("part", F.lit("term"))
    return pairs.select(*columns).unionByName(terms.select(*columns))


def oracle_sql(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """The same in SQL, with a row for each kept term and group."""
    share = lambda n, total: f"(1 + ({UNIT} * ({n} + {SMOOTHING})::HUGEINT) // ({total} + {SMOOTHING} * v))"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), w AS (
  SELECT r, lang, source, unnest(ts) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {min_docs}
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT w.lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL
), l AS (
  SELECT lang, count(*) AS v, sum(total) AS lang_n FROM k GROUP BY lang
), n AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS group_n
  FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL
), p AS (
  SELECT n.lang, n.source, k.term, coalesce(c.n, 0) AS n,
         {share("coalesce(c.n, 0)", "group_n")} AS p, {share("k.total", "lang_n")} AS q
  FROM n JOIN l USING (lang) JOIN k ON k.lang = n.lang
  LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term
), apart AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(apart.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
), terms AS (
  SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
), listed AS (
  SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term', * FROM terms
)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM listed QUALIFY part = 'pair' OR rank <= {top}
"""
