"""Vector code compression: product quantisation whose assignments are Orchard searches.

A vector is cut into ``parts`` equal consecutive parts, and a part is replaced by the number of the
nearest entry of its position's codebook. All arithmetic is in whole numbers: component x is
floor(``SCALE`` * x), so that sums over tasks do not depend on their order and reruns agree.

*Search.* Each codebook entry has a list of the other entries by their distance from it. A search holds
the best entry so far and walks that entry's list; an entry that is nearer to the part (or as near
and of lower number) becomes the best one, and the walk goes on at the head of its list. Entries
are marked when they are measured and never measured again. A walk ends where an entry is more than twice as far
from the best entry as the part is: by the triangle inequality what follows is
farther away from the part. All parts of a batch take their steps together.

*Fitting.* A codebook begins with the parts of the vectors of the least ids. A round assigns all vectors;
each task adds up its parts by entry, and only these sums, a number bounded by the size of the
codebooks, are combined and brought to the driver. An entry that no part chose stays.

A vector that is NULL or empty, or holds a NULL, NaN or infinite component, is dropped. The dimension is that
of the kept vector of the least id; vectors of another dimension, and all of them if ``parts`` does not divide it,
are kept with NULL code and error. Components beyond +-65,536 count as that, which keeps errors within
a long. Ids that repeat are ordered by their vectors, and a NULL id is the greatest. Fewer vectors
than entries make shorter codebooks. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.llm.batches import map_arrow
from readmill.session import materialise

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Largest scaled component: squares of differences, summed over a vector, fit a long.
_LIMIT = 1 << 28
#: Labels with at least this share of all rows are heavy; so there are at most as many of them.
HEAVY = 1_000


@dataclass(frozen=True)
class Codebooks:
    """``entries[p][e]`` are the whole-number components of entry ``e`` at part ``p``."""

    entries: tuple[np.ndarray, ...]

    @property
    def dimension(self) -> int:
        return sum(part.shape[1] for part in self.entries)

    def sha256(self) -> str:
        numbers = (str(x) for part in self.entries for x in part.reshape(-1).tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def neighbour_lists(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the others by squared distance (then number), and those distances."""
    apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(apart, -1)
    order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(apart, order, axis=1)


def orchard(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each row of ``parts``; of equally near ones the lowest."""
    count, others = len(parts), len(entries) - 1
    order, apart = neighbour_lists(entries)
    best = np.zeros(count, dtype=np.int64)
    distance = ((parts - entries[0]) ** 2).sum(axis=1)
    if not others:
        return best, distance
    seen = np.zeros((count, len(entries)), dtype=bool)
    seen[:, 0] = True
    at = np.zeros(count, dtype=np.int64)
    rows = np.arange(count)
    while True:
        # Twice the distance is four times its square.
        rows = rows[at[rows] < others]
        rows = rows[apart[best[rows], at[rows]] <= 4 * distance[rows]]
        if not len(rows):
            return best, distance
        entry = order[best[rows], at[rows]]
        at[rows] += 1
        new = ~seen[rows, entry]
        asked, entry = rows[new], entry[new]
        seen[asked, entry] = True
        found = ((parts[asked] - entries[entry]) ** 2).sum(axis=1)
        nearer = (found < distance[asked]) | ((found == distance[asked]) & (entry < best[asked]))
        jumped = asked[nearer]
        best[jumped], distance[jumped], at[jumped] = entry[nearer], found[nearer], 0


def assign(vectors: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """(entry numbers by part, error) of each row of whole-number ``vectors``."""
    codes, errors, begin = [], np.zeros(len(vectors), dtype=np.int64), 0
    for entries in books.entries:
        end = begin + entries.shape[1]
        code, error = orchard(vectors[:, begin:end], entries)
        codes.append(code)
        errors += error
        begin = end
    return np.stack(codes, axis=1), errors


def scaled(vector: Column) -> Column:
    """Whole-number components."""
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(_LIMIT))), F.lit(-float(_LIMIT))))
    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    """Whether there are components and all are finite numbers."""
    infinite = F.lit(float("inf"))
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == infinite))
    return F.coalesce((F.size(vector) > 0) & ~odd, F.lit(False))


def whole_vectors(embeddings: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id", "label")) -> DataFrame:
    """``keep`` and ``whole``, the scaled vector, of every row that is not dropped."""
    return embeddings.where(usable(F.col(vector))).select(*keep, scaled(F.col(vector)).alias("whole"))


def _matrix(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    lists = batch.column("whole")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, dimension)


def _fits(rows: DataFrame, dimension: int) -> Column:
    return F.size("whole") == dimension


def fit_codebooks(
    whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, key: str = "vec_id"
) -> Codebooks | None:
    """Codebooks of the vectors in ``whole``; None if there is none or its dimension is not a multiple of ``parts``.

    ``whole`` is read once a round; let it be a written table.
    """
    first = whole.orderBy(F.col(key).asc_nulls_last(), "whole").select("whole").limit(1).collect()
    dimension = len(first[0].whole) if first else 0
    if not dimension or dimension % parts:
        return None
    rows = whole.where(_fits(whole, dimension))
    seeds = rows.orderBy(F.col(key).asc_nulls_last(), "whole").select("whole").limit(entries).collect()
    width = dimension // parts
    start = np.array([r.whole for r in seeds], dtype=np.int64)
    books = Codebooks(tuple(start[:, p * width : (p + 1) * width].copy() for p in range(parts)))
    for _ in range(rounds):
        books = _moved(rows, books)
    return books


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry at the componentwise floor of the mean of its parts."""
    parts, size, width = len(books.entries), *books.entries[0].shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * size, width), dtype=np.int64)
        counts = np.zeros(parts * size, dtype=np.int64)
        for batch in batches:
            vectors = _matrix(batch, books.dimension)
            codes, _ = assign(vectors, books)
            cells = (codes + np.arange(parts) * size).reshape(-1)
            np.add.at(sums, cells, vectors.reshape(-1, width))
            counts += np.bincount(cells, minlength=parts * size)
        used = np.flatnonzero(counts)
        cell, place = np.repeat(used, width), np.tile(np.arange(width), len(used))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell), pa.array(place), pa.array(sums[used].reshape(-1)), pa.array(np.repeat(counts[used], width))],
            ["cell", "place", "total", "n"],
        )

    sums = map_arrow(rows.select("whole"), task, "cell long, place long, total long, n long")
    # As many rows as the codebooks have components.
    means = sums.groupBy("cell", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    ).collect()
    moved = [part.copy() for part in books.entries]
    for row in means:
        moved[row.cell // size][row.cell % size, row.place] = int(row.total) // row.n
    return Codebooks(tuple(moved))


def encode(whole: DataFrame, books: Codebooks | None, keep: tuple[str, ...] = ("vec_id", "label")) -> DataFrame:
    """``keep``, ``code`` (two hex digits a part) and ``error`` of every row of ``whole``."""
    if books is None:
        return whole.select(*keep, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    dimension = books.dimension

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fitting = np.array(batch.column("whole").value_lengths()) == dimension
            chosen = batch.filter(pa.array(fitting))
            codes, errors = assign(_matrix(chosen, dimension), books)
            texts = iter([row.tobytes().hex() for row in codes.astype(np.uint8)])
            numbers = iter(errors.tolist())
            made = [
                pa.array([next(texts) if f else None for f in fitting], pa.string()),
                pa.array([next(numbers) if f else None for f in fitting], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], [*keep, "code", "error"])

    fields = [f"`{c}` {whole.schema[c].dataType.simpleString()}" for c in keep]
    return map_arrow(whole.select(*keep, "whole"), task, ", ".join([*fields, "code string", "error long"]))


def decode(codes: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """``codes`` with ``approximate``: the vector that each code stands for."""
    numbers = lambda rows: F.array(*[F.array(*[F.lit(int(x) / SCALE) for x in row]) for row in rows])

    def part(p: int) -> Column:
        entry = F.conv(F.substring(F.col(code), 2 * p + 1, 2), 16, 10).cast("int")
        return F.get(numbers(books.entries[p]), entry)

    whole = F.concat(*[part(p) for p in range(len(books.entries))])
    return codes.withColumn("approximate", F.when(F.col(code).isNotNull(), whole))


def with_group_sum(rows: DataFrame, group: str, value: str, into: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over rows of equal ``group``, NULLs together.

    Groups with a thousandth of all rows or more, of which there are at most a thousand, are broadcast; rows of the others, each
    of bounded share, are joined by a shuffle. So no task holds a large group.
    """
    sums = materialise(rows.groupBy(group).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n")), "group-sums")
    total = sums.agg(F.coalesce(F.sum("_n"), F.lit(0))).head()[0]
    sums = sums.select(F.col(group).alias("_group"), "_sum", (F.col("_n") * HEAVY >= total).alias("_heavy"))
    heavy = F.broadcast(sums.where("_heavy").drop("_heavy").withColumn("_found", F.lit(True)))
    joined = rows.join(heavy, F.col(group).eqNullSafe(F.col("_group")), "left")
    rest = joined.where("_found IS NULL").drop("_group", "_sum", "_found")
    light = rest.join(sums.where("NOT _heavy").drop("_heavy"), F.col(group).eqNullSafe(F.col("_group")))
    both = joined.where("_found").drop("_found").unionByName(light)
    return both.drop("_group").withColumnRenamed("_sum", into)


def compress_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, code, error, label_error (NULL labels together) and codebooks_sha256 of every usable vector."""
    whole = materialise(whole_vectors(embeddings, vector), "whole-vectors")
    books = fit_codebooks(whole)
    codes = materialise(encode(whole, books), "vector-codes")
    digest = hashlib.sha256(b"").hexdigest() if books is None else books.sha256()
    summed = with_group_sum(codes, "label", "error", "label_error")
    return summed.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle_sql(vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in SQL: every part against every entry, one pair of table expressions a round."""
    scale = f"list_transform({vector}, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT))"
    made = f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, {vector}) AS r, vec_id, label, {scale} AS whole, len({vector}) // {parts} AS width
  FROM embeddings
  WHERE {vector} IS NOT NULL AND len({vector}) > 0
    AND len(list_filter({vector}, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
  SELECT r, p, list_slice(whole, p * width + 1, (p + 1) * width) AS v FROM kept, range({parts}) t(p)
), book0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, v AS c FROM part WHERE r <= {entries}
)"""
    near = """
), near{k} AS MATERIALIZED (
  SELECT r, p, any_value(v) AS v, arg_min({{'e': e, 'd': d}}, {{'d': d, 'e': e}}) AS best
  FROM (SELECT part.r, part.p, part.v, b.e,
               list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS d
        FROM part JOIN book{k} b ON part.p = b.p)
  GROUP BY r, p
"""
    move = """
), mean{n} AS (
  SELECT p, e, list(m ORDER BY i) AS c
  FROM (SELECT p, best.e AS e, i, CAST(floor_div(sum(v[i])::HUGEINT, count(*)) AS BIGINT) AS m
        FROM near{k}, range(1, 4097) t(i) WHERE i <= len(v) GROUP BY p, best.e, i)
  GROUP BY p, e
), book{n} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{n} m ON b.p = m.p AND b.e = m.e
"""
    floor_div = "((sum(v[i])::HUGEINT - ((sum(v[i])::HUGEINT % count(*)) + count(*)) % count(*)) // count(*))"
    move = move.replace("floor_div(sum(v[i])::HUGEINT, count(*))", floor_div)
    body = made[:-2]
    for k in range(rounds):
        body += near.format(k=k).rstrip() + move.format(k=k, n=k + 1).rstrip()
    body += near.format(k=rounds).rstrip()
    return body + f"""
), coded AS (
  SELECT r, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM near{rounds} GROUP BY r
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""
