"""Key filters of runs: which runs may hold one of a batch's keys.

A run's filter is cut into parts of 32,768 bits, one part for some ``KEYS`` keys; a key sets ``HASHES`` bits of the part that
its hash names. A key that is in the run always has its bits set; one that is not has them by chance in about one case of
fifty thousand. The parts are rows of a Parquet table beside the run, so a batch reads those that its keys name.

Filters are built from the keys of a part, brought together first: words of 64 bits by a hash aggregation, then the words in order.
A key's ``HASHES`` positions are never sorted or moved. A large batch asks with slices of its keys, each much larger than the one
before, and only for the runs that no slice has hit yet: by chance or not, a run is hit after some hundred thousand keys at most, so the
keys asked of a run are bounded however large the batch is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32_768
KEYS = 1_365
HASHES = 12
#: Keys of the first slice of a batch, how much larger each next one is, and hash values that tell slices apart.
FIRST_KEYS = 65_536
SLICE_GROWTH = 4
_SLICES = 1 << 20

_SCHEMA = "folder string, event_date date, _bucket int, part int, bits binary"


def parts(rows: int) -> int:
    return max(1, -(-rows // KEYS))


def _part(count: str) -> Column:
    return F.pmod(F.xxhash64("key", F.lit(-1)), F.col(count)).cast("int")


def _positions() -> Column:
    return F.array(*[F.pmod(F.xxhash64("key", F.lit(k)), F.lit(BITS)) for k in range(HASHES)])


def write(keys: DataFrame, sizes: Sequence[tuple], root: str, folder: str) -> None:
    """Filters of (event_date, _bucket, key) rows; ``sizes`` lists (day, bucket, parts) of the runs, and is as short as they are few."""
    spark = keys.sparkSession
    listed = spark.createDataFrame(list(sizes), "_day string, _in int, _parts int")
    same = F.col("event_date").cast("string").eqNullSafe(F.col("_day")) & (F.col("_bucket") == F.col("_in"))
    placed = keys.join(F.broadcast(listed), same).withColumn("part", _part("_parts"))
    place = ("event_date", "_bucket", "part")
    bits = placed.select(*place, "key").repartition(*place).select(*place, F.explode(_positions()).alias("position"))
    words = bits.groupBy(*place, F.floor(F.col("position") / 64).cast("int").alias("word")).agg(F.bit_or(_bit()).alias("bits"))
    made = words.groupBy(*place).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    made.select(F.lit(folder).alias("folder"), *place, _bytes(F.col("words")).alias("bits")).write.parquet(f"{root}/{folder}")


def _bit() -> Column:
    """The bit of a position in its word: the word's bytes from the left, the bits of a byte from the right."""
    byte = F.floor(F.col("position") / 8) % 8
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), ((7 - byte) * 8 + F.col("position") % 8).cast("int"))


def _bytes(words: Column) -> Column:
    """The bytes of a part from its words in order; words that are missing are empty."""

    def text(entry: Column, i: Column) -> Column:
        gap = entry["word"] - F.when(i > 0, F.get(words, i - 1)["word"] + 1).otherwise(0)
        return F.concat(F.repeat(F.lit("0"), gap * 16), F.lpad(F.hex(entry["bits"]), 16, "0"))

    return F.unhex(F.rpad(F.array_join(F.transform(words, text), ""), BITS // 4, "0"))


def _is_set(position: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bits", F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    flag = F.get(F.array(*[F.lit(1 << k) for k in range(8)]), (position % 8).cast("int"))
    return byte.bitwiseAND(flag) != 0


def hits(keys: DataFrame, runs: Sequence[tuple], root: str) -> list[int]:
    """Numbers of the runs, given as (number, day, bucket, filter folder, parts), that may hold one of the keys.

    ``keys`` has ``key`` (hash) and ``_bucket``.
    """
    if not runs:
        return []
    asked = keys.distinct().withColumn("_slice", F.pmod(F.xxhash64("key", F.lit(-2)), F.lit(_SLICES)))
    asked = asked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found: set[int] = set()
        low = 0
        for high in _slice_ends(asked.count()):
            left = [r for r in runs if r[0] not in found]
            if not left:
                break
            found.update(_hits(asked.where((F.col("_slice") >= low) & (F.col("_slice") < high)).drop("_slice"), left, root))
            low = high
        return sorted(found)
    finally:
        asked.unpersist()


def _slice_ends(keys: int) -> list[int]:
    ends, size = [], FIRST_KEYS
    while size < keys:
        ends.append(max(1, size * _SLICES // keys))
        size *= SLICE_GROWTH
    return [*ends, _SLICES]


def _hits(keys: DataFrame, runs: Sequence[tuple], root: str) -> list[int]:
    spark = keys.sparkSession
    listed = spark.createDataFrame(list(runs), "run int, _day string, _in int, _folder string, _parts int")
    # As many rows as the manifest has runs.
    asked = keys.join(F.broadcast(listed), F.col("_bucket") == F.col("_in")).drop("_bucket")
    asked = asked.withColumn("_part", _part("_parts"))
    bits = spark.read.schema(_SCHEMA).parquet(*sorted({f"{root}/{folder}" for *_, folder, _ in runs}))
    same = (
        (F.col("folder") == F.col("_folder")) & F.col("event_date").cast("string").eqNullSafe(F.col("_day"))
        & (F.col("_bucket") == F.col("_in")) & (F.col("part") == F.col("_part"))
    )
    found = bits.join(asked, same).where(F.forall(_positions(), _is_set))
    return [r.run for r in found.select("run").distinct().collect()]
