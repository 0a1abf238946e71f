import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readmill import files
from readmill.operators import coalesce, merge, retention
from readmill.plans.projections import PROJECTIONS, get_projection
from readmill.sources import key_filter, tables
from readmill.sources.tables import EventLog, UpsertTable

ROW = T.StructType([T.StructField("k", T.StringType()), T.StructField("x", T.IntegerType()), T.StructField("updated_at", T.TimestampType())])
ROW_SCHEMA = "k string, x int, updated_at timestamp, partition int, offset bigint"
EVENT = T.StructType([T.StructField("id", T.StringType()), T.StructField("x", T.IntegerType()), T.StructField("time", T.TimestampType())])
EVENT_SCHEMA = "id string, x int, time timestamp, partition int, offset bigint"


def at(day, hour=0):
    return datetime(2024, 1, day, hour, tzinfo=timezone.utc)


def test_latest_and_earliest(spark):
    df = spark.createDataFrame([("a", 1, 0, 5), ("a", 2, 0, 7), ("a", 3, 1, 1), ("b", 4, 0, 1), (None, 5, 0, 1), (None, 6, 0, 2)],
                               "k string, x int, partition int, offset bigint")
    pick = lambda f: {r.k: r.x for r in f(df, ["k"]).collect()}
    assert pick(coalesce.latest_per_key) == {"a": 3, "b": 4, None: 6}
    assert pick(coalesce.earliest_per_key) == {"a": 1, "b": 4, None: 5}
    assert coalesce.latest_per_key(df, ["k"]).columns == df.columns


def test_upsert_keeps_target_only_columns(spark):
    target = spark.createDataFrame([("a", 1, "n1"), ("b", 2, "n2")], "k string, x int, note string")
    batch = spark.createDataFrame([("b", 20), ("c", 30)], "k string, x int")
    rows = merge.upsert(target, batch, ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("a", 1, "n1"), ("b", 20, "n2"), ("c", 30, None)]


def test_upsert_overwrites_with_null(spark):
    target = spark.createDataFrame([("a", 1)], "k string, x int")
    batch = spark.createDataFrame([("a", None)], "k string, x int")
    assert [tuple(r) for r in merge.upsert(target, batch, ["k"]).collect()] == [("a", None)]


def test_append_new(spark):
    target = spark.createDataFrame([("a", 1)], "id string, x int")
    batch = spark.createDataFrame([("a", 9), ("b", 2)], "id string, x int")
    assert [tuple(r) for r in merge.append_new(target, batch, ["id"]).collect()] == [("b", 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_batches_gives_the_same_table(spark, tmp_path, seed):
    """Replays and compaction at any point change nothing."""
    rng = random.Random(seed)
    table = UpsertTable(spark, str(tmp_path / "t"), ("k",), ROW)
    expected, written = {}, []
    for batch_id in range(4):
        rows = [(rng.choice("abcdef"), rng.randrange(100), at(1), 0, o) for o in range(rng.randint(0, 6))]
        for k, x, *_ in rows:
            expected[k] = x
        df = coalesce.latest_per_key(spark.createDataFrame(rows, ROW_SCHEMA), ["k"])
        table.write_batch(df, batch_id)
        written.append(df)
        if rng.random() < 0.5:
            table.write_batch(df, batch_id)
        if rng.random() < 0.5:
            table.compact() if rng.random() < 0.5 else table.merge(rng.randint(0, batch_id))
            table.write_batch(written[0], 0)
        assert {r.k: r.x for r in table.read().collect()} == expected
    table.merge(3)
    table.vacuum(grace_s=0)
    assert {r.k: r.x for r in table.read().collect()} == expected
    assert table.read().columns == ["k", "x", "updated_at"]
    assert len(table.runs()) == len({r.bucket for r in table.runs()})


def upsert(spark, rows):
    return spark.createDataFrame(rows, ROW_SCHEMA)


def test_what_no_manifest_names_is_invisible(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), ("k",), ROW)
    assert table.read().count() == 0 and table.committed() is None
    table.write_batch(upsert(spark, [("a", 1, at(1), 0, 0)]), 0)
    # A writer that died before its commit: its files are there, finished or not.
    other = UpsertTable(spark, str(tmp_path / "t"), ("k",), ROW)
    other._write(upsert(spark, [("a", 9, at(1), 0, 0), ("z", 9, at(1), 0, 1)]).drop("partition", "offset").withColumn("_write", F.lit(2).cast("long")))
    assert table.committed() == 0 and {r.k: r.x for r in table.read().collect()} == {"a": 1}
    assert table.vacuum() == [] and len(table.vacuum(grace_s=0)) == 1
    assert {r.k: r.x for r in table.read().collect()} == {"a": 1}


def test_a_replay_after_a_prune_keeps_its_rows(spark, tmp_path):
    """The batch is in the table, the stream fails before its own commit, upkeep prunes, the stream delivers again."""
    table = UpsertTable(spark, str(tmp_path / "t"), ("k",), ROW)
    table.write_batch(upsert(spark, [("a", 1, at(1), 0, 0)]), 2)
    table.write_batch(upsert(spark, [(k, 3, at(1), 0, 1) for k in "xyz"]), 3)
    assert table.prune(at(9), 24) == 4 and table.read().count() == 0
    table.vacuum(grace_s=0)
    table.write_batch(upsert(spark, [(k, 3, at(9), 0, 1) for k in "xyz"]), 3)
    assert {r.k for r in table.read().collect()} == set("xyz")
    table.write_batch(upsert(spark, [("a", 1, at(9), 0, 0)]), 2)  # an older one is not news
    table.compact()
    table.write_batch(upsert(spark, [(k, 3, at(9), 0, 1) for k in "xyz"]), 3)
    assert table.prune(at(9), 24) == 0 and {r.k for r in table.read().collect()} == set("xyz")


def test_a_commit_of_another_writer_in_between(spark, tmp_path, monkeypatch):
    table = UpsertTable(spark, str(tmp_path / "t"), ("k",), ROW)
    for batch in range(3):
        table.write_batch(upsert(spark, [(k, batch, at(1 + batch), 0, 0) for k in "abc"]), batch)
    real = table._rewrite

    def slow(groups, state):
        table.write_batch(upsert(spark, [("c", 7, at(8), 0, 0), ("d", 7, at(8), 0, 1)]), 3)  # the stream goes on meanwhile
        return real(groups, state)

    monkeypatch.setattr(UpsertTable, "_rewrite", lambda self, groups, state: slow(groups, state))
    assert table.prune(at(6), 24) == 3
    monkeypatch.undo()
    assert {r.k: r.x for r in table.read().collect()} == {"c": 7, "d": 7}
    with pytest.raises(RuntimeError, match="second stream"):
        before = table._load()
        table.write_batch(upsert(spark, [("q", 1, at(8), 0, 0)]), 4)
        table._commit_batch(before, [], 5)


def test_runs_stay_few_and_untouched_buckets_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKETS", 2)
    monkeypatch.setattr(tables, "MAX_RUNS", 5)
    table = UpsertTable(spark, str(tmp_path / "t"), ("k",), ROW)
    expected = {}
    for batch in range(30):
        rows = [(f"k{(batch * 7 + i) % 50}", batch, at(1), 0, i) for i in range(1 + batch % 3)]
        expected |= {k: x for k, x, *_ in rows}
        table.write_batch(upsert(spark, rows), batch)
    assert {r.k: r.x for r in table.read().collect()} == expected
    table.compact()
    for place in tables._by_place(table.runs()).values():
        rows = [r.rows for r in place]
        assert all(old >= 2 * sum(rows[i + 1 :]) for i, old in enumerate(rows[:-1])) and len(rows) <= 6
    assert {r.k: r.x for r in table.read().collect()} == expected
    assert len(files.children(spark, f"{table.path}/manifest")) <= 2 * tables.manifest.KEPT + 2  # with checksums
    before = {r.path for r in table.runs()}
    (one,) = spark.createDataFrame([("k1",)], "k string").select(table._bucket().alias("b")).collect()
    table.write_batch(upsert(spark, [("k1", 99, at(1), 0, 0)]), 30)
    table.merge(30)
    kept = {r.path for r in table.runs()} & before
    assert all(f"_bucket={one.b}" not in p for p in kept)


def test_merging_applies_the_ttl(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), ("k",), ROW)
    rows = [("old", 1, at(1), 0, 0), ("edge", 2, at(2), 0, 1), ("new", 3, at(3), 0, 2), ("none", 4, None, 0, 3)]
    table.write_batch(upsert(spark, rows), 0)
    table.merge(0, at(3), 24)
    assert {r.k for r in table.read().collect()} == {"edge", "new", "none"}


def test_an_idle_table_is_pruned(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), ("k",), ROW)
    assert table.prune(at(9), 24) == 0
    rows = [("old", 1, at(1), 0, 0), ("new", 3, at(3), 0, 2), ("none", 4, None, 0, 3)]
    table.write_batch(upsert(spark, rows), 0)
    table.compact()
    assert [table.prune(at(d), 24) for d in (2, 3, 3, 20)] == [0, 1, 0, 1]
    assert {r.k for r in table.read().collect()} == {"none"}
    table.write_batch(upsert(spark, [("none", 5, None, 0, 3)]), 1)
    table.write_batch(upsert(spark, rows), 0)  # a replay of an older batch brings nothing back
    table.vacuum(grace_s=0)
    assert {r.k: r.x for r in table.read().collect()} == {"none": 5} and table.committed() == 1


def test_event_log_replay_and_days(spark, tmp_path):
    log = EventLog(spark, str(tmp_path / "t"), ("id",), EVENT)
    first = spark.createDataFrame([("a", 1, at(1), 0, 0), ("b", 2, at(2, 5), 0, 1), ("n", 3, None, 0, 2)], EVENT_SCHEMA)
    second = spark.createDataFrame([("a", 9, at(1), 0, 3), ("c", 4, at(3), 0, 4)], EVENT_SCHEMA)
    for batch_id, rows in ((0, first), (1, second), (1, second), (0, first)):
        log.write_batch(rows, batch_id)
    assert {(r.id, r.x) for r in log.read().collect()} == {("a", 1), ("b", 2), ("n", 3), ("c", 4)}
    assert {r.id for r in log.read(at(3, 6), 24).collect()} == {"c", "n"}
    assert {r.id for r in log.read(at(3, 5), 24).collect()} == {"b", "c", "n"}
    assert log.prune(at(3, 5), None) == 0 and log.prune(at(3, 5), 24) == 1
    assert {r.id for r in log.read().collect()} == {"b", "c", "n"}
    assert any(r.day is None and "HIVE_DEFAULT" in r.path for r in log.runs())


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def test_the_border_day_is_pruned_to_the_row(spark, tmp_path):
    log = EventLog(spark, str(tmp_path / "t"), ("id",), EVENT)
    rows = [(f"{d}-{h}", 1, at(d, h), 0, 24 * d + h) for d in (1, 2, 3) for h in range(24)] + [("none", 1, None, 0, 0)]
    log.write_batch(events(spark, rows[:40]), 0)
    log.write_batch(events(spark, rows[40:]), 1)
    limit = at(2, 7)
    gone = [r for r in rows if r[2] is not None and r[2] < limit]
    assert log.prune(at(3, 7), 24) == len(gone) == 31
    assert {r.id for r in log.read().collect()} == {r[0] for r in rows} - {r[0] for r in gone}
    assert log.prune(at(3, 7), 24) == 0
    log.vacuum(grace_s=0)
    # What was pruned is new again, as in a table from which it was deleted; what stayed is not.
    log.write_batch(events(spark, [("2-6", 5, at(3), 0, 0), ("2-7", 5, at(3), 0, 1)]), 2)
    assert {r.id: r.x for r in log.read().collect() if r.id in ("2-6", "2-7")} == {"2-6": 5, "2-7": 1}


def test_new_ids_read_no_old_run(spark, tmp_path, monkeypatch):
    log = EventLog(spark, str(tmp_path / "t"), ("id",), EVENT)
    for batch in range(3):
        log.write_batch(events(spark, [(f"{batch}-{i}", batch, at(1 + batch), 0, i) for i in range(3_000)]), batch)
    new = events(spark, [(f"new-{i}", 0, at(5), 0, i) for i in range(500)])
    assert len(log.runs()) == 3 * tables.DAY_BUCKETS
    assert len(log.may_hold(new, log.runs())) <= 2  # by chance, one key and run in fifty thousand
    again = events(spark, [("1-77", 9, at(9), 0, 0)])  # with another time
    (run,) = [r for r in log.may_hold(again, log.runs()) if r.day == "2024-01-02"]
    log.write_batch(again, 3)
    log.compact()
    log.write_batch(events(spark, [("2-5", 9, None, 0, 0), ("x", 9, None, 0, 1)]), 4)
    found = {r.id: r.x for r in log.read().collect()}
    assert len(found) == log.read().count() == 9_001 and (found["1-77"], found["2-5"], found["x"]) == (1, 2, 9)


def test_filters_hold_the_bits_of_their_keys(spark, tmp_path):
    keys = spark.range(6_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("2024-01-02")).cast("date").alias("event_date"), (F.col("id") % 2).cast("int").alias("_bucket"),
        F.xxhash64("id").alias("key"))
    sizes = [(day, b, key_filter.parts(n)) for day, n in ((None, 1_000), ("2024-01-02", 2_000)) for b in (0, 1)]
    key_filter.write(keys, sizes, str(tmp_path), "f")
    listed = spark.createDataFrame(sizes, "day string, _bucket int, n int")
    placed = keys.alias("k").join(listed.alias("l"), F.expr("k._bucket = l._bucket and cast(k.event_date as string) <=> l.day"))
    bits = placed.select("event_date", "k._bucket", key_filter._part("n").alias("part"), F.explode(key_filter._positions()).alias("at"))
    wanted = bits.groupBy("event_date", "_bucket", "part").agg(F.bitmap_construct_agg("at").alias("bits"))
    found = spark.read.parquet(str(tmp_path / "f")).drop("folder")
    as_set = lambda df: {tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.collect()}
    assert found.count() == 6 and as_set(found) == as_set(wanted.select(*found.columns))


def test_positions_of_keys_are_not_sorted(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(type(spark.range(0).write), "parquet", lambda w, path: plans.append(w._df._jdf.queryExecution().executedPlan().toString()))
    keys = spark.range(10).select(F.lit("2024-01-02").cast("date").alias("event_date"), F.lit(0).alias("_bucket"), F.col("id").alias("key"))
    key_filter.write(keys, [("2024-01-02", 0, 1)], str(tmp_path), "f")
    assert "SortAggregate" not in plans[0] and "HashAggregate" in plans[0]


def test_large_batches_ask_runs_until_they_are_hit(spark, tmp_path, monkeypatch):
    log = EventLog(spark, str(tmp_path / "t"), ("id",), EVENT)
    for batch in range(2):
        log.write_batch(events(spark, [(f"{batch}-{i}", batch, at(1 + batch), 0, i) for i in range(3_000)]), batch)
    batch = events(spark, [(f"1-{i}", 9, at(9), 0, i) for i in range(2_000)] + [("0-5", 9, at(9), 0, 2_000)])
    wanted = log.may_hold(batch, log.runs())
    asked, ask = [], key_filter._hits
    monkeypatch.setattr(key_filter, "FIRST_KEYS", 100)
    monkeypatch.setattr(key_filter, "_hits", lambda keys, runs, root: asked.append((keys.count(), len(runs))) or ask(keys, runs, root))
    assert log.may_hold(batch, log.runs()) == wanted and {r.day for r in wanted} == {"2024-01-01", "2024-01-02"}
    assert len(asked) == 4 and sum(n for n, _ in asked) == 2_001
    assert asked[0][1] == 2 * tables.DAY_BUCKETS and asked[1][1] == tables.DAY_BUCKETS


def test_prune_is_strict_and_keeps_null(spark):
    df = spark.createDataFrame([(1, at(1)), (2, at(2)), (3, None)], "i int, t timestamp")
    keep = lambda hours: {r.i for r in retention.prune(df, "t", hours, F.lit(at(3))).collect()}
    assert keep(24) == {2, 3} and keep(0) == {1, 2, 3} and keep(None) == {1, 2, 3}
    assert retention.pruned_counts(df, "t", 24, F.lit(at(3))).head().asDict() == {"kept": 2, "pruned": 1}
    assert retention.pruned_counts(df, "t", None, F.lit(at(3))).head().asDict() == {"kept": 3, "pruned": 0}


def test_ttl_policy():
    everything = PROJECTIONS.values()
    hours = lambda override: {p.name: retention.prune_target(p) for p in retention.resolve_ttl(everything, override)}
    plain = hours(None)
    assert plain["tactical_events"] == ("time", 24) and plain["cm_state"] == ("updated_at", 24)
    assert plain["region_top_factors"] == ("updated_at", None)
    assert sum(h is not None for _, h in plain.values()) == 8
    assert hours(6)["region_top_factors"] == ("updated_at", 6) and hours(6)["tactical_events"] == ("time", 24)
    assert hours(0)["cm_state"] == ("updated_at", None) and hours(0)["tactical_events"] == ("time", 24)
    assert [retention.parse_ttl_override(t) for t in (None, "", "  ", "0", " 6 ")] == [None, None, None, 0, 6]
    assert get_projection("cm_state").asset_ttl_hours == 24
