import hashlib
import random

import numpy as np
import pytest

from readmill.llm import vector_codes as V
from tests.llm import cases
from tests.llm.sql import difference


def by_hand(rows, parts=8, entries=16, rounds=6):
    """(id, code, error, label error), and the digest of the codebooks, with plain lists."""
    kept = [(i, [int(np.floor(4096 * float(x))) for x in v], k) for i, v, k in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    nearest = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            for e, vs in members.items():
                books[p][e] = [sum(xs) // len(xs) for xs in zip(*vs)]
    made = []
    for i, v, k in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        made.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), k))
    sums = {k: sum(r[2] for r in made if r[3] == k) for *_, k in made}
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return [(i, code, d, sums[k]) for i, code, d, k in made], digest


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("count, dimension", [(120, 16), (9, 8), (1, 24)])
def test_codes_equal_plain_lists(spark, count, dimension):
    rng = random.Random(count)
    # Few values, so that distances tie.
    rows = [(i, [rng.choice([-1.0, -0.5, 0.25, 0.5, rng.random()]) for _ in range(dimension)], rng.choice([0, 1, None])) for i in range(count)]
    rows += [(500, None, 1), (501, [], 1), (502, [None] * dimension, 0), (503, [float("nan")] * dimension, 0),
             (-7, [float("inf")] * dimension, 0), (0, rows[0][1], 1), (0, rows[-1][1], 1), (None, rows[0][1], None)]
    want, digest = by_hand(rows)
    df = cases.clashing(spark.createDataFrame(rows, SCHEMA).repartition(5), "code error whole _sum _group")
    found = V.compress_vectors(df).collect()
    assert key([(r.vec_id, r.code, r.error, r.label_error) for r in found]) == key(want)
    assert {r.codebooks_sha256 for r in found} == {digest}


def test_orchard_equals_exhaustive_search():
    rng = np.random.default_rng(4)
    for size in (1, 2, 16, 64):
        entries = rng.integers(-6, 6, (size, 3))
        parts = rng.integers(-8, 8, (500, 3))
        apart = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        best, distance = V.orchard(parts, entries)
        assert (best == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_odd_tables_and_decoding(spark):
    assert V.compress_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    odd = spark.createDataFrame([(1, [1.0] * 8, 0), (2, [1.0] * 16, 0), (3, [1e30] * 8, None)], SCHEMA)
    found = {r.vec_id: (r.code, r.error) for r in V.compress_vectors(odd).collect()}
    assert found[2] == (None, None) and found[1][1] == found[3][1] == 0
    uneven = spark.createDataFrame([(1, [1.0] * 9, 0)], SCHEMA)
    assert [(r.code, r.error) for r in V.compress_vectors(uneven).collect()] == [(None, None)]
    whole = V.whole_vectors(spark.createDataFrame([(i, [i / 4.0] * 8, 0) for i in range(10)], SCHEMA))
    books = V.fit_codebooks(whole)
    back = {r.vec_id: r.approximate for r in V.decode(V.encode(whole, books), books).collect()}
    assert back == {i: [i / 4.0] * 8 for i in range(10)}


def test_query_equals_sql(spark):
    count, ours, theirs = difference(spark, "op11_vector_codes", "/root/testdata/sf0.001")
    assert count > 100 and ours == theirs == []
