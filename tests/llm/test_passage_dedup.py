import random
import re

from readmill.llm import passage_dedup
from readmill.llm.queries import op9_line_dedup
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def without_passages(docs, least):
    """Words of repeated windows by brute force, for distinct documents in order."""
    seen, left = set(), []
    for _, text in docs:
        words, gone = WORD.findall(text), set()
        for i in range(len(words) - least + 1):
            window = tuple(words[i : i + least])
            if window in seen:
                gone |= set(range(i, i + least))
            seen.add(window)
        left.append([w for k, w in enumerate(words) if k not in gone])
    return left


def test_passages_equal_brute_force(spark):
    rng = random.Random(5)
    made = lambda n: ["".join(rng.choices(cases.SYLLABLES, k=2)) for _ in range(n)]
    pool = [made(rng.choice([5, 15, 19, 20, 21, 26, 40, 90])) for _ in range(25)]
    docs = []
    for i in range(150):
        words = made(rng.randint(0, 30))
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(pool)
            words += part[rng.randint(0, 3) : len(part) - rng.randint(0, 3)] + made(rng.choice([0, 1, 7, 30]))
        words += ["again"] * rng.choice([0, 0, 0, 25])
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "  ", "\t\n "]) for w in words)
        docs.append((i, text))
        if rng.random() < 0.1:
            docs.append((i + 1000, text))
    docs.sort()
    df = cases.clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), "runs clean_text n places marks")
    found = {r.doc_id: r for r in passage_dedup.dedup_passages(df, 20).collect()}
    want = without_passages(docs, 20)
    assert [WORD.findall(found[i].clean_text) for i, _ in docs] == want
    assert sum(len(WORD.findall(t)) for _, t in docs) > sum(map(len, want))
    assert all(found[i].clean_text == t for i, t in docs if found[i].runs is None)


def test_a_passage_in_the_middle_of_a_line(spark, tmp_path):
    passage = " ".join(f"w{i}" for i in range(56))
    broken = passage.replace("w20 ", "w20\n").replace("w50 ", "w50\n")
    docs = [
        (1, f"one {passage} two\nthree"),
        (2, f"four\nfive {passage} six\n\nseven "),
        (3, f"eight\nnine {broken} ten\neleven"),  # its only whole line has 30 words
        (4, f"{passage}\ntwelve"),
        (5, f"thirteen\n{passage}\nfourteen"),
        (6, " ".join(passage.split()[:49])),
    ]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in op9_line_dedup(spark, str(tmp_path)).collect()}
    assert [found[i].clean_text for i, _ in docs] == [
        docs[0][1], "four\nfive six\n\nseven ", "eight\nnine\nten\neleven", "twelve", "thirteen\nfourteen", docs[5][1],
    ]
    assert (found[3].n_deleted, found[3].deleted, found[3].n_lines) == (56, "2-57", 5)


def test_passages_of_odd_documents(spark):
    found = passage_dedup.dedup_passage_documents(cases.clashing(cases.documents(spark), "runs clean_text")).collect()
    assert len(found) == len(cases.rows())
    once = sorted({(r[0], r[1] or "") for r in cases.rows() if r[0] is not None})
    want = dict(zip((i for i, _ in once), without_passages(once, 50)))
    assert {r.doc_id: WORD.findall(r.clean_text or "") for r in found if r.doc_id is not None} == want
    assert want[4][-1] == "end" and len(want[4]) < 60  # the rest of a near copy goes, within lines too
    assert {r.clean_text for r in found if r.doc_id == 7} == {None}
    assert passage_dedup.dedup_passage_documents(cases.empty(spark)).collect() == []
    same = spark.createDataFrame([(None, cases.prose(60, 1)), (3, cases.prose(60, 1)), (None, cases.prose(60, 1))], "doc_id long, text string")
    assert {(r.doc_id, r.clean_text) for r in passage_dedup.dedup_passages(same).collect()} == {(None, ""), (3, cases.prose(60, 1))}


def test_marks_and_contexts(spark):
    rows = {r.doc_id: r for r in passage_dedup._marks(cases.documents(spark), 50).collect()}
    for r in cases.rows():
        n = len(WORD.findall(r[1] or ""))
        found = rows[r[0]]
        assert found.n == n if r[0] is not None else True
        if r[0] is not None and n >= 50:  # every window selects one mark
            assert [m.begin for m in found.marks][0] == 0 and found.marks[-1].last == n - 50
            assert all(a.last + 1 == b.begin for a, b in zip(found.marks, found.marks[1:]))
    assert rows[1].marks == rows[3].marks and rows[7].marks == []


def test_a_text_is_split_a_bounded_number_of_times(spark):
    """Filters on a text's words must not copy the passes over them."""
    marks = passage_dedup._marks(cases.documents(spark), 50).where("n >= 50")
    plan = marks._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("split(") <= 3 and len(plan) < 20_000


def test_words_are_hashed_once_and_runs_of_them_at_fingerprints_only(spark):
    """No pass joins the hashes of several words from each word on; a run of words is one piece of a text's hashes."""
    plan = passage_dedup._marks(cases.documents(spark), 50)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(") <= 5


def test_windows_without_a_fingerprint_of_their_own(spark):
    """Texts of few different words, where one in so many words begins no fingerprint, or every word does."""
    rng = random.Random(8)
    docs = [(i, " ".join(["a"] * rng.randint(10, 90))) for i in range(6)]
    docs += [(10 + i, " ".join(rng.choices("bcd", k=rng.randint(10, 90)))) for i in range(20)]
    docs += [(40 + i, " ".join([f"x{i % 4}", f"y{i % 4}"] * rng.randint(10, 60) + [f"z{i}"])) for i in range(12)]
    found = {r.doc_id: r for r in passage_dedup.dedup_passages(spark.createDataFrame(docs, "doc_id long, text string"), 14).collect()}
    assert [WORD.findall(found[i].clean_text) for i, _ in docs] == without_passages(docs, 14)
    marks = passage_dedup._marks(spark.createDataFrame(docs, "doc_id long, text string"), 14).collect()
    assert all(m.begin <= m.last for r in marks for m in r.marks)
    assert all(r.marks[-1].last == r.n - 14 for r in marks if r.n >= 14)


def test_few_windows_select_a_mark_of_their_own(spark):
    """Words as uneven as in prose: at most one mark in nine windows, so that little is written and shuffled."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices(cases.SYLLABLES, k=3)) for _ in range(400)]
    shares = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, shares, k=3000))) for i in range(12)]
    marks = passage_dedup._marks(spark.createDataFrame(docs, "doc_id long, text string"), 50).collect()
    assert all([m.begin for m in r.marks] == [0] + [m.last + 1 for m in r.marks[:-1]] and r.marks[-1].last == 2950 for r in marks)
    assert sum(len(r.marks) for r in marks) < 12 * 2951 / 9
