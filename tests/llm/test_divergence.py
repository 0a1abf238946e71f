import random
import re
from collections import Counter, defaultdict

import numpy as np

from readmill.llm import divergence as D
from tests.llm import cases
from tests.llm.sql import difference

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def by_hand(rows, min_docs, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in [tuple(x or "" for x in r) for r in rows]:
        terms = TERM.findall(lowered(text))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    made = []
    for lang in {g[0] for g in counts}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        sources = [g[1] for g in counts if g[0] == lang]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def shares(c):
            below = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + (c[t] + 5) * 10**9 // below for t in kept}

        q = shares(whole)
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                made += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:limit])]
    return sorted(made)


def tuples(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def test_audit_equals_plain_counting(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 3)  # several blocks of sources
    rng = random.Random(3)
    words = ["".join(rng.choices(cases.SYLLABLES, k=2)) for _ in range(150)] + ["Été", "naïve", "漢字", "\U0001f600", "x", "X"]
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "en", "en", "fr", None, ""])
        source = rng.choice(["a", "b", "c", "d", "e", "f", "g", "h", None])
        rows.append((rng.choice([" ", "-", "\n9"]).join(rng.choices(words, k=rng.randint(0, 40))), lang, source))
    rows += [(None, "de", "a"), ("", "de", "b"), ("lone", "it", "a")] + [rows[0]] * 5
    df = cases.clashing(spark.createDataFrame(rows, "text string, lang string, source string").repartition(6), "term n v value rank docs")
    assert tuples(D.audit_sources(df, min_docs=12, top=7)) == by_hand(rows, 12, 7)


def test_audit_of_odd_documents(spark):
    rows = [(r[1], r[2], r[3]) for r in cases.rows()]
    df = cases.clashing(cases.documents(spark), "total sources share a b block")
    assert tuples(D.audit_sources(df, min_docs=3)) == by_hand(rows, 3, 50)
    assert D.audit_sources(cases.empty(spark)).collect() == []


def test_tables_of_words_are_sent_on_when_full(spark, monkeypatch):
    monkeypatch.setattr(D, "TABLE", 20)
    rows = [(r[1], r[2], r[3]) for r in cases.rows()]
    assert tuples(D.audit_sources(cases.documents(spark), min_docs=2)) == by_hand(rows, 2, 50)


def test_skyband_holds_what_can_rank():
    rng = np.random.default_rng(2)
    n = 3_000
    count = rng.integers(1, 60, n)
    total = count + rng.integers(0, 80, n)
    terms = [b"%05d" % x for x in rng.permutation(n)]
    kept = set(D.skyband(count, total, terms, 7).tolist())
    for i in range(n):
        over = sum((count >= count[i]) & (total <= total[i]) & np.array([t < terms[i] for t in terms]))
        assert (over < 7) == (i in kept)


def test_shares_are_exact():
    counts, below = np.array([0, 3, 10**12, 4 * 10**14]), np.array([7, 11, 3 * 10**12, 9 * 10**14])
    assert D._shares(counts, below).tolist() == [1 + (c + 5) * 10**9 // b for c, b in zip(counts.tolist(), below.tolist())]


def test_query_equals_sql(spark):
    count, ours, theirs = difference(spark, "op12_divergence", "/root/testdata/sf0.01")
    assert count > 100 and ours == theirs == []
