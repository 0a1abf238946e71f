"""Near-duplicate vectors by cross-polytope hashing.

A hash is the signed axis that a vector lies closest to after a pseudo-random rotation, made
of three rounds of random signs and a fast Hadamard transform. ``HASHES`` of them name a
bucket of a table. Besides its own bucket a vector goes to the ``PROBES`` next best ones, where
a coordinate lost least to the second, third, ... axis; two vectors meet in a table if one
of them is at home in a bucket that the other one visits. Pairs that meet are verified by
their cosine in double precision.

At a cosine of 0.9, 64 dimensions and these parameters two vectors meet in a given table
with a probability of 0.6, so that ``TABLES`` = 10 miss a pair in ten thousand, and closer
pairs far more rarely.

* Equal vectors are one class and enter once, with their number.
* A bucket is cut into blocks of ``BLOCK`` classes, and each pair of blocks is a group of its own: no
  task holds more than two blocks, however full a bucket is. Pairs of vectors are not written
  out: a group returns, for each of its vectors, the number of its links and one edge to
  the least vector it reaches there.
* A pair that meets in several buckets counts in the first of them only; the vectors carry
  the names of all their buckets, so that a group can tell.

A vector that is NULL, empty, zero, or holds NULL or a number that is not finite links with
nothing; its component is itself. Vectors of different lengths never link. Rows without
``vec_id`` count as links of others but name no component if another row can. Repeated rows are equal vectors. An empty table
gives an empty result. Only ``vec_id`` and ``embedding`` are read, so that other columns may
have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmill.llm.batches import groups, map_arrow, roots
from readmill.llm.components import components
from readmill.session import materialise

COSINE = 0.9
HASHES, TABLES, PROBES = 2, 10, 3
BLOCK = 1_024
SEED = 8
#: Axes besides the best that a probe may take in one hash.
_SECOND = 4


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row; the length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def bucket_names(unit: np.ndarray, hashes: int, tables: int, probes: int, seed: int = SEED) -> np.ndarray:
    """int32 (vectors, tables, 1 + probes): the home bucket and the next best ones."""
    n, d = unit.shape
    wide = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :d] = unit
    signs = np.random.default_rng([seed, d]).choice([-1.0, 1.0], (tables, hashes, 3, wide))
    take = min(_SECOND, 2 * wide)
    names = np.empty((n, tables, 1 + probes), dtype=np.int64)
    for t in range(tables):
        loss, code = np.zeros((n, 1)), np.full((n, 1), d, dtype=np.int64)
        for h in range(hashes):
            x = padded
            for r in range(3):
                x = hadamard(x * signs[t, h, r])
            both = np.concatenate((x, -x), axis=1)
            best = np.argsort(-both, axis=1, kind="stable")[:, :take]
            value = np.take_along_axis(both, best, axis=1)
            lost = (value[:, :1] - value) ** 2
            loss = (loss[:, :, None] + lost[:, None, :]).reshape(n, -1)
            code = (code[:, :, None] * (2 * wide + 1) + best[:, None, :]).reshape(n, -1)
        order = np.argsort(loss, axis=1, kind="stable")[:, : 1 + probes]
        found = np.take_along_axis(code, order, axis=1)
        names[:, t, : found.shape[1]] = found
        names[:, t, found.shape[1] :] = found[:, :1]
    mixed = names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _classes(vectors: DataFrame) -> DataFrame:
    """cid, copies and embedding of each distinct vector that can link."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where(F.size("embedding") > 0).where(finite & F.exists("embedding", lambda x: x != 0))
    return (
        usable.groupBy("embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .select(F.coalesce("least", F.xxhash64("embedding")).alias("cid"), "least", "copies", "embedding")
    )


def _visits(classes: DataFrame, hashes: int, tables: int, probes: int) -> DataFrame:
    """cid and the buckets (names) of each class."""

    def task(batches):
        for batch in batches:
            vectors = [np.asarray(v, dtype=float) for v in batch.column("embedding").to_pylist()]
            lists: list = [None] * len(vectors)
            for d in {len(v) for v in vectors}:
                rows = [i for i, v in enumerate(vectors) if len(v) == d]
                unit = np.stack([vectors[i] for i in rows])
                unit = unit / np.abs(unit).max(axis=1, keepdims=True)  # no square overflows
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                for i, names in zip(rows, bucket_names(unit, hashes, tables, probes)):
                    lists[i] = names.ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), pa.array(lists, pa.list_(pa.int32()))], ["cid", "names"]
            )

    return map_arrow(classes.select("cid", "embedding"), task, "cid long, names array<int>")


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows x[i], y[i], each from its own sums."""
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def _group_links(rows: dict, table: int, name: int, width: int, cosine: float):
    """(cid, links, root cid) of the vectors of one pair of blocks that are linked there first."""
    unit = rows["vector"] / np.linalg.norm(rows["vector"], axis=1, keepdims=True)
    one, other = np.flatnonzero(rows["side"] == 0), np.flatnonzero(rows["side"] == 1)
    left = one
    right = other if len(other) else one
    near = unit[left] @ unit[right].T >= cosine - 1e-9
    if not len(other):
        near = np.triu(near, 1)
    a, b = np.nonzero(near)
    a, b = left[a], right[b]
    sure = _cosines(rows["vector"][a], rows["vector"][b]) >= cosine
    a, b = a[sure], b[sure]
    if not len(a):
        return None
    p, q = rows["names"][a].reshape(len(a), -1, width), rows["names"][b].reshape(len(b), -1, width)
    visits_p, visits_q = (p[:, :, :1] == q).any(axis=2), (q[:, :, :1] == p).any(axis=2)
    first = (visits_p | visits_q).argmax(axis=1)
    none = np.iinfo(np.int32).max
    row = np.arange(len(a))
    least = np.minimum(
        np.where(visits_p[row, first], p[row, first, 0], none), np.where(visits_q[row, first], q[row, first, 0], none)
    )
    meets = (visits_p | visits_q)[row, first]
    own = meets & (first == table) & (least == name)
    a, b = a[own], b[own]
    if not len(a):
        return None
    n = len(unit)
    links = np.bincount(a, rows["copies"][b], n) + np.bincount(b, rows["copies"][a], n)
    # Edges lead to the least class, so nodes are numbered in the order of cid.
    rank = np.argsort(np.argsort(rows["cid"], kind="stable"), kind="stable")
    back = np.argsort(rank)
    root = back[roots(n, rank[a], rank[b])][rank]
    linked = np.flatnonzero(links)
    return rows["cid"][linked], links[linked].astype(np.int64), rows["cid"][root[linked]]


def _linked(classes: DataFrame, visits: DataFrame, probes: int, cosine: float, block: int) -> DataFrame:
    """cid, links and root per group; sum the links and union the edges."""
    width = 1 + probes
    each = visits.select("cid", F.posexplode("names").alias("at", "name"))
    each = each.select("cid", F.floor(F.col("at") / width).cast("int").alias("table"), "name").distinct()
    sizes = each.groupBy("table", "name").agg(F.count("*").alias("size")).where("size > 1")
    sizes = sizes.select("table", "name", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    held = each.join(sizes, ["table", "name"]).withColumn("own", F.pmod(F.xxhash64("cid", "name"), "blocks").cast("int"))
    dealt = held.select(
        "cid", "table", "name", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    ).select(
        "cid", "table", "name",
        F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
        (F.col("own") > F.col("with")).cast("int").alias("side"),
    )
    full = dealt.join(visits, "cid").join(classes.select("cid", "copies", "embedding"), "cid")
    group = ["table", "name", "i", "j"]
    sorted_rows = full.repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group)

    def settle(key, table):
        vectors = table.column("embedding").to_pylist()
        lengths = np.array([len(v) for v in vectors])
        for d in np.unique(lengths):
            pick = np.flatnonzero(lengths == d)
            if len(pick) < 2:
                continue
            vector = np.array([vectors[i] for i in pick], dtype=float)
            vector /= np.abs(vector).max(axis=1, keepdims=True)
            rows = {c: table.column(c).to_numpy()[pick] for c in ("cid", "side", "copies")}
            rows["vector"] = vector
            rows["names"] = np.array([table.column("names")[int(i)].as_py() for i in pick], dtype=np.int32)
            found = _group_links(rows, key[0], key[1], width, cosine)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["cid", "links", "root"])

    def task(batches):
        for key, rows in groups(batches, group):
            yield from settle(key, rows)

    return map_arrow(sorted_rows, task, "cid long, links long, root long")


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    hashes: int = HASHES,
    tables: int = TABLES,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    classes = materialise(_classes(vectors), "classes")
    visits = materialise(_visits(classes, hashes, tables, probes), "visits")
    found = materialise(_linked(classes, visits, probes, cosine, block), "near")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = classes.join(links, "cid", "left").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("label", F.coalesce("label", "cid"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    solved = named.join(least, "label").select(
        F.col("embedding").alias("_vector"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("_links"),
        F.col("component_id").alias("_component"),
        F.lit(True).alias("_known"),
    )
    joined = vectors.join(solved, F.col("embedding") == F.col("_vector"), "left")
    component = F.when(F.col("_known"), F.col("_component")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
