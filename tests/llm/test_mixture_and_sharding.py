from collections import Counter

import pytest
from pyspark.sql import functions as F

from readmill.llm.mixture import mix_documents, mixture_table, source_targets
from readmill.llm.prefix import running_sum
from readmill.llm.sharding import interleave, shard_table
from tests.llm import cases


def levels(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Shares by the rule itself: share, stop what is above, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    stopped: dict = {}
    while True:
        left = sum(sizes.values()) - sum(stopped.values())
        open_ = [s for s in names if s not in stopped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return {**stopped, **share}
        stopped.update({s: most * sizes[s] for s in above})


def test_targets_follow_the_rule(spark):
    sizes = {"a": 900, "b": 2, "c": 5, "d": 100, "é": 40, None: 1, "": 3, "z": 0}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in source_targets(df).collect()}
    assert found == pytest.approx(levels(sizes))


def test_mixture_of_odd_documents(spark):
    docs = cases.clashing(cases.documents(spark), "size target taken _key _source")
    found = mix_documents(docs).collect()
    again = mixture_table(cases.documents(spark).repartition(3)).collect()
    key = lambda r: (r.doc_id, r.size, r.source_size, r.target, r.taken)
    assert Counter(map(key, found)) == Counter(map(key, again))
    assert len(found) == len(cases.rows()) and "_key" not in found[0].asDict()
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target + 0.5)
        assert sum(r.size for r in own) == own[0].source_size
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    assert mixture_table(cases.empty(spark)).collect() == []


def test_running_sum_over_many_slices(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 2).alias("g"), ((F.col("id") * 7919) % 3000 / 3000).alias("u"))
    rows = rows.withColumn("v", F.col("id") % 5).withColumn("n", F.lit(1500))
    found = running_sum(rows, ["g"], "u", "n", ["u", "id"], "v", "before", rows_per_slice=40).collect()
    for g in (0, 1):
        total = 0
        for r in sorted((r for r in found if r.g == g), key=lambda r: (r.u, r.id)):
            assert r.before == total
            total += r.v


def test_shards_of_odd_documents(spark):
    found = shard_table(cases.clashing(cases.documents(spark), "shard slot law _at")).collect()
    assert len(found) == len(cases.rows())
    counts = Counter(r.shard for r in found)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in found if r.shard == s) == list(range(n))
    assert {r.size for r in found if r.doc_id in (7, 8)} == {1}
    assert {r.text_crc32 for r in found if r.doc_id in (7, 8)} == {0}
    again = shard_table(cases.documents(spark).repartition(2)).collect()
    assert Counter(found) == Counter(again)
    assert shard_table(cases.empty(spark)).collect() == []


def test_every_shard_holds_the_mixture(spark):
    docs = spark.range(800).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 20 == 1, "b").otherwise("c").alias("source")
    )
    found = interleave(docs.withColumn("t", F.lit(0)), 8, tie="t").collect()
    sources = Counter(r.source for r in found)
    for s in range(8):
        own = Counter(r.source for r in found if r.shard == s)
        assert all(abs(own[k] - n / 8) <= 2 for k, n in sources.items())
