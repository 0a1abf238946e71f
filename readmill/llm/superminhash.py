"""Near duplicates by SuperMinHash.

For each element of a set SuperMinHash draws ranks 0 + r, 1 + r, 2 + r, ... for the places of the
signature in an order that is a random permutation of its own. The ranks of one element are
thus correlated, which makes signatures vary less than independent minima do; and as ranks
grow by one with each draw, a set can stop as soon as every place holds less than the next
draw could bring. Sets of a few hundred elements stop after two or three draws each.

Signatures are cut into bands. Sets that agree in a band are candidates; candidates are
verified on their full sets, and verified links are grouped by union-find (components).

* Equal sets are one class and are linked by that; only classes go through the bands.
* A bucket of many classes is not turned into all its pairs. First each bucket's least class is
  tested against the others, which settles most buckets: all of their classes are in one
  component then. The others are cut into blocks of ``BLOCK`` classes. A task gets two blocks, counts what
  all their sets have in common by matrix products, and returns for each class that is linked
  one edge to the least class it reaches there. A pair counts in the first band it shares
  only. So no link between candidates is lost, and none of their pairs become rows.
* ``banding`` chooses the bands so that a pair at the threshold shares none with a probability
  of at most ``MISS``; pairs above it are missed still more rarely.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmill.llm.batches import groups, map_arrow, roots, slices
from readmill.llm.components import components
from readmill.session import materialise

WORDS = 5
PERCENT = 80
MISS = 2e-5
MAX_BANDS = 28

_U = np.uint64
_ONE, _MULTIPLIER = _U(1), 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if len(known) > 1 << 24:  # of one very long text: not kept
            return known
        _powers[name] = known
    return known[:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts in order, number of words of each text).

    Words are runs of bytes other than ASCII white space, A-Z in lower case.
    """
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join([*parts, b""]), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    first, last = edge[0::2], edge[1::2]
    lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((lower.astype(np.uint64) + _ONE) * _power("up", _MULTIPLIER, len(data)), out=sums[1:])
    raw = (sums[last] - sums[first]) * _power("down", _INVERSE, len(data))[first]
    ends = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(first, np.concatenate(([0], ends))))
    return _mix(raw + (last - first).astype(np.uint64) * _U(0xD6E8FEB86659FD93)), counts


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; fewer words are one shingle."""
    hashes, counts = word_hashes(texts)
    run = _mix(hashes + _U(words))
    for k in range(1, words):
        run[: len(run) - k] = _mix(run[: len(run) - k] * _U(0x2545F4914F6CDD1D) + hashes[k:])
    found, at = [], 0
    for n in counts.tolist():
        if n >= words:
            found.append(np.unique(run[at : at + n - words + 1]))
        elif n:
            short = int.from_bytes(hashlib.blake2b(hashes[at : at + n].tobytes(), digest_size=8).digest(), "little")
            found.append(np.array([short], dtype=np.uint64))
        else:
            found.append(np.zeros(0, dtype=np.uint64))
        at += n
    return found


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A row of ``size`` ranks (as 32.32 fixed point numbers) for each set that is not empty."""
    if not 1 <= size <= 256:
        raise ValueError("a signature has 1 to 256 places")
    count = len(sets)
    ranks = np.full(count * size, np.iinfo(np.uint64).max, dtype=np.uint64)
    element = np.concatenate(sets) if count else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    order = np.empty((len(element), size), dtype=np.uint8)
    order[:] = np.arange(size, dtype=np.uint8)
    row = np.arange(len(element))
    for draw in range(size):
        if not len(element):
            break
        random = _mix(element + _U((draw + 1) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1)))
        swap = draw + ((random & _U(0xFFFFFFFF)) * _U(size - draw) >> _U(32)).astype(np.int64)
        place = order[row, swap]
        order[row, swap] = order[row, draw]
        order[row, draw] = place
        np.minimum.at(ranks, owner * size + place, (_U(draw) << _U(32)) | (random >> _U(32)))
        # A set whose every rank is below the next draw is done.
        open_ = ranks.reshape(count, size).max(axis=1) >= _U(draw + 1) << _U(32)
        going = open_[owner]
        if not going.all():
            element, owner, order = element[going], owner[going], order[going]
            row = np.arange(len(element))
    return ranks.reshape(count, size)


def banding(percent: int, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the longest rows for which ``MAX_BANDS`` bands keep the chance of a miss."""
    for rows in range(9, 0, -1):
        bands = math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows)) if percent < 100 else 1
        if bands <= MAX_BANDS and bands * rows <= 256:
            return bands, rows
    raise ValueError(f"no bands for a similarity of {percent} %")


def _digest(s: np.ndarray) -> str:
    return hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else ""


def sketch(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (digest of the set, '' if empty) and band keys of every document."""

    def task(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                sets = shingle_sets(texts, words)
                full = [i for i, s in enumerate(sets) if len(s)]
                marks = signatures([sets[i] for i in full], bands * rows).reshape(len(full), bands, rows)
                keys = _mix(np.arange(1, bands + 1, dtype=np.uint64) * _U(0xA0761D6478BD642F))[None, :].repeat(len(full), 0)
                for k in range(rows):
                    keys = _mix(keys * _U(0xE7037ED1A0B428DB | 1) + marks[:, :, k])
                listed: list = [[]] * len(sets)
                for i, k in zip(full, keys.view(np.int64).tolist()):
                    listed[i] = k
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        part.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) for s in sets], pa.string()),
                        pa.array(listed, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "node", "bands"],
                )

    hashed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    return map_arrow(
        hashed, task, "doc_id long, text_hash long, n_shingles long, node string, bands array<long>"
    )


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """node and elements of every row."""

    def task(batches):
        for batch in batches:
            for _, texts in slices(batch, "text"):
                sets = [s for s in shingle_sets(texts, words) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_digest(s) for s in sets], pa.string()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["node", "elements"],
                )

    return map_arrow(docs.select("text"), task, "node string, elements array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    other = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(one, "a").join(other, "b")
    common = F.size(F.array_intersect("x", "y"))
    counted = both.select("a", "b", common.alias("c"), (F.size("x") + F.size("y")).alias("n"))
    return counted.where(f"100L * c >= {percent}L * (n - c)").select("a", "b")


#: Classes of a bucket that meet in one block.
BLOCK = 512
#: Elements that one matrix product counts.
_COLUMNS = 8_192


def _buckets(sketches: DataFrame) -> DataFrame:
    """band, key, node and n of the classes that share a band with another class."""
    exploded = sketches.select("node", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key"))
    members = exploded.groupBy("band", "key", "node").agg(F.first("n").alias("n"))
    shared = members.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1").select("band", "key")
    return members.join(shared, ["band", "key"])


def _class_sets(docs: DataFrame, sketches: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and elements of the classes named, each computed from one of its documents."""
    chosen = sketches.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("id"))
    wanted = chosen.select("id").distinct()
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    return _sets(texts, words).join(nodes, "node", "left_semi").dropDuplicates(["node"])


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left has in common with each on the right."""
    counts = np.zeros((len(left), len(right)), dtype=np.float32)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def placed(sets):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        element = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, element), max(len(shared) - 1, 0))
        found = shared[at] == element if len(shared) else np.zeros(len(element), dtype=bool)
        return row[found], at[found]

    (row_l, at_l), (row_r, at_r) = placed(left), placed(right)
    for begin in range(0, len(shared), _COLUMNS):
        parts = []
        for row, at, n in ((row_l, at_l, len(left)), (row_r, at_r, len(right))):
            own = (at >= begin) & (at < begin + _COLUMNS)
            part = np.zeros((n, min(_COLUMNS, len(shared) - begin)), dtype=np.float32)
            part[row[own], at[own] - begin] = 1
            parts.append(part)
        counts += parts[0] @ parts[1].T
    return counts


def _block_links(rows: pa.Table, band: int, percent: int):
    """(node, root) of the classes of two blocks that are linked to a class of another component there."""
    side = rows.column("side").to_numpy()
    one, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    left, right = one, other if len(other) else one
    if not len(left) or len(rows) < 2:
        return None
    names = rows.column("node").to_pylist()
    label = np.unique(rows.column("label").to_pylist(), return_inverse=True)[1]
    size = rows.column("n").to_numpy().astype(np.int64)
    bands = np.array(rows.column("bands").to_pylist(), dtype=np.int64)
    small, large = np.minimum.outer(size[left], size[right]), np.maximum.outer(size[left], size[right])
    wanted = (label[left][:, None] != label[right][None, :]) & (100 * small >= percent * large)
    for earlier in range(band):
        wanted &= bands[left, earlier][:, None] != bands[right, earlier][None, :]
    if not len(other):
        wanted = np.triu(wanted, 1)
    rows_l, rows_r = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    if not len(rows_l):
        return None
    sets = rows.column("elements").combine_chunks()
    cuts = np.concatenate(([0], np.cumsum(sets.value_lengths().to_numpy())))
    flat = sets.flatten().to_numpy()
    own = lambda i: flat[cuts[i] : cuts[i + 1]]
    common = common_counts([own(i) for i in left[rows_l]], [own(i) for i in right[rows_r]]).astype(np.int64)
    union = np.add.outer(size[left[rows_l]], size[right[rows_r]]) - common
    a, b = np.nonzero(wanted[np.ix_(rows_l, rows_r)] & (100 * common >= percent * union))
    if not len(a):
        return None
    a, b = left[rows_l[a]], right[rows_r[b]]
    root = roots(len(names), a, b)
    linked = np.unique(np.concatenate((a, b)))
    return [names[i] for i in linked], [names[i] for i in root[linked]]


def _settled(open_: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Edges (a, b) between classes of the open buckets (band, key, node, label, size)."""
    blocks = open_.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    placed = blocks.withColumn("own", F.pmod(F.xxhash64("node", "key"), "blocks").cast("int"))
    dealt = placed.select(
        "band", "key", "node", "label", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    ).select(
        "band", "key", "node", "label",
        F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
        (F.col("own") > F.col("with")).cast("int").alias("side"),
    )
    names = open_.select("node").distinct()
    known = sketches.join(names, "node", "left_semi").groupBy("node").agg(
        F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    known = materialise(known.join(sets, "node"), "open-sets")
    group = ["band", "key", "i", "j"]
    rows = dealt.join(known, "node").repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group)

    def task(batches):
        for key, table in groups(batches, group):
            found = _block_links(table, key[0], percent)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in found], ["a", "b"])

    return map_arrow(rows, task, "a string, b string")


def linked_classes(
    docs: DataFrame, sketches: DataFrame, words: int, percent: int, block: int = BLOCK
) -> DataFrame | None:
    """(node, label) for the classes that are linked to another class; None if none are."""
    buckets = materialise(_buckets(sketches), "buckets")
    if buckets.isEmpty():
        return None
    sets = materialise(_class_sets(docs, sketches, buckets.select("node").distinct(), words), "sets")
    centres = buckets.groupBy("band", "key").agg(F.min(F.struct("node", "n")).alias("c"))
    near = f"a <> b AND 100 * least(n, c.n) >= {percent} * greatest(n, c.n)"
    pairs = buckets.join(centres, ["band", "key"]).select(F.col("c.node").alias("a"), F.col("node").alias("b"), "n", "c")
    pairs = materialise(pairs.where(near).select("a", "b").distinct(), "pairs")
    links = materialise(_verified(pairs, sets, percent), "verified")
    labels = materialise(components(links), "labels")
    named = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = named.groupBy("band", "key").agg(
        F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("size")
    )
    # Of two classes one was the centre: the pair is settled, linked or not.
    open_ = open_.where("l <> h AND size > 2").select("band", "key", "size")
    open_ = materialise(named.join(open_, ["band", "key"]), "open")
    if open_.isEmpty():
        return labels
    more = materialise(_settled(open_, sketches, sets, percent, block), "block-links")
    if more.isEmpty():
        return labels
    return materialise(components(links.unionByName(more)), "labels")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document; see ``near_duplicate_rows``."""
    return near_duplicate_rows(docs, words, percent).drop("text_hash")


def near_duplicate_rows(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept of every document.

    Words are runs of characters other than ASCII white space, with A-Z in lower case. Two sets are
    linked if 100 * intersection >= ``percent`` * union. ``component_id`` is the least
    ``doc_id`` that links reach; its first row, by (doc_id, text hash), is kept.

    A NULL text, or one without words, has an empty set and is linked with nothing. Fewer
    than ``words`` words are one shingle. Repeated rows have equal sets and are linked; rows with one
    ``doc_id`` and text are all kept or all not. A row without ``doc_id`` counts in its component but names it only if
    no other row does. Texts are read whole. An empty table gives an empty result. Only
    ``doc_id`` and ``text`` are read, so that other columns may have any name.
    """
    docs = docs.select("doc_id", "text")
    bands, rows = banding(percent)
    sketches = materialise(sketch(docs, words, bands, rows), "sketches")
    labels = linked_classes(docs, sketches, words, percent)
    plain = sketches.select("doc_id", "text_hash", "n_shingles", "node")
    if labels is None:
        named = plain.withColumn("label", F.col("node"))
    else:
        named = plain.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    least = named.where("n_shingles > 0").groupBy("label").agg(F.min(row).alias("least"))
    # Empty sets have the label '' and no partner.
    joined = named.join(least, "label", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least.doc_id"))
    kept = (F.col("n_shingles") == 0) | row.eqNullSafe(F.col("least"))
    return joined.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), kept.alias("kept"))
