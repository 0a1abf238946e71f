import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from readmill.llm import batches, crosspolytope, superminhash
from readmill.llm.components import components
from tests.llm import cases

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}


def least_reachable(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def expected(sets, percent):
    linked = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return least_reachable(sets, linked)


def family(seed, n, words=120):
    """Texts that differ in a few words each from one base, so that some pairs are similar enough and others not."""
    rng = random.Random(seed)
    base = cases.prose(words, seed).split()
    made = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, 7)):
            text[rng.randrange(words)] = "w%d" % rng.randrange(10**6)
        made.append(" ".join(text))
    return made


@pytest.mark.parametrize("words, percent, block", [(3, 85, 512), (5, 80, 4)])
def test_components_equal_brute_force(spark, words, percent, block, monkeypatch):
    monkeypatch.setattr(superminhash, "linked_classes", lambda *a, f=superminhash.linked_classes: f(*a, block))
    docs = [t for s in range(3) for t in family(s, 25)] + family(9, 12, 6)
    docs = dict(enumerate(docs + docs[:5]))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(6)
    want = expected({i: shingles(t, words) for i, t in docs.items()}, percent)
    found = superminhash.near_duplicates(df, words, percent).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_odd_documents(spark):
    docs = cases.clashing(cases.documents(spark), "node label bands key id n")
    found = superminhash.near_duplicates(docs, 3, 85).collect()
    assert len(found) == len(cases.rows())
    texts = cases.texts()
    want = expected({i: shingles(t, 3) for i, t in texts.items()}, 85)
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in found if r.doc_id is not None} == {
        i: (want[i], len(shingles(texts[i], 3))) for i in texts
    }
    assert want[12] == 11 and want[3] == 1 and want[4] == 1 and want[8] == 8
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    assert superminhash.near_duplicates(cases.empty(spark)).collect() == []
    lone = spark.createDataFrame([(1, "a b c d"), (2, "e f g h")], "doc_id long, text string")
    assert {r.component_id for r in superminhash.near_duplicates(lone).collect()} == {1, 2}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    errors = []
    for share in (0.2, 0.5, 0.85):
        for _ in range(12):
            pool = rng.integers(0, 1 << 63, 600).astype(np.uint64)
            both = int(share * 400)
            a, b = np.unique(pool[:400]), np.unique(np.concatenate((pool[:both], pool[400 : 800 - both])))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            x, y = superminhash.signatures([a, b], 196)
            errors.append((x == y).mean() - true)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.04
    short, = superminhash.signatures([np.array([7], dtype=np.uint64)], 196)
    assert sorted((short >> np.uint64(32)).tolist()) == list(range(196))  # each draw fills its own place


def test_hashes_do_not_depend_on_the_batch():
    texts = [cases.prose(50, s) for s in range(5)] + ["", "É a", "A  b"]
    whole = superminhash.shingle_sets(texts, 3)
    for t, s in zip(texts, whole):
        assert superminhash.shingle_sets([t], 3)[0].tolist() == s.tolist()
        assert len(s) == len(shingles(t, 3))


def test_common_counts(monkeypatch):
    monkeypatch.setattr(superminhash, "_COLUMNS", 16)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 90, n)) for n in (1, 5, 40, 60, 80)]
    counts = superminhash.common_counts(sets, sets[1:])
    assert counts.tolist() == [[len(np.intersect1d(a, b)) for b in sets[1:]] for a in sets]
    assert superminhash.common_counts([np.array([1])], [np.array([2])]).tolist() == [[0]]


def test_banding_keeps_the_chance_of_a_miss():
    for percent in (50, 70, 80, 85, 90, 99):
        bands, rows = superminhash.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= superminhash.MISS


def test_connected_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = least_reachable({x for p in links for x in p}, links)
    assert {r.node: r.label for r in found} == {n: l for n, l in want.items() if any(n in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_roots():
    assert batches.roots(6, np.array([5, 4, 1]), np.array([4, 3, 2])).tolist() == [0, 1, 1, 3, 3, 3]


def vectors():
    rng = np.random.default_rng(3)
    rows, centre = [], rng.standard_normal((12, 40))
    for i in range(260):
        v = centre[i % 12] + rng.standard_normal(40) * rng.choice([0.1, 0.33])
        rows.append((i, v.astype(np.float32).tolist()))
    rows += [(300 + i, rows[5][1]) for i in range(7)]  # copies
    rows += [(400, None), (401, []), (402, [0.0] * 40), (403, [float("nan")] * 40), (404, [None] * 40), (405, [float("inf")] * 40)]
    rows += [(406, [1.0, 2.0, 3.0]), (407, [2.0, 4.0, 6.1]), (408, [1e38] * 40), (409, [5.0]), (410, [-5.0])]
    return rows + [rows[9], (None, rows[5][1])]


@pytest.mark.parametrize("block", [1024, 8])
def test_vectors_equal_brute_force(spark, block):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found = crosspolytope.near_vectors(cases.clashing(df, "cid copies label names"), block=block).collect()
    usable = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {k: 0 for k in range(len(rows))}
    pairs = []
    for a, b in itertools.combinations(usable, 2):
        x, y = (np.asarray(rows[k][1], dtype=float) for k in (a, b))
        if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
            links[a] += 1
            links[b] += 1
            pairs.append((a, b))
    groups = least_reachable(range(len(rows)), pairs)
    ids = {}
    for k, g in groups.items():
        if rows[k][0] is not None:
            ids[g] = min(ids.get(g, rows[k][0]), rows[k][0])
    want = sorted((str(rows[k][0]), links[k], ids[groups[k]], rows[k][0] == ids[groups[k]]) for k in groups)
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in found) == want
    assert sum(links.values()) > 2000


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert crosspolytope.near_vectors(none).collect() == []
    lone = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "vec_id long, embedding array<float>")
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in crosspolytope.near_vectors(lone).collect()} == {
        (1, 0, 1, True), (2, 0, 2, True)}


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).standard_normal((5, 16))
    assert np.allclose(crosspolytope.hadamard(crosspolytope.hadamard(x)), x)
