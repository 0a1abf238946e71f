from collections import Counter

import corpus_pipeline
from readmill.llm.superminhash import near_duplicates
from tests.llm import cases


def test_toxic_rows_go_alone(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "fit_on", lambda docs, labels: {"slope": 1.0})
    marked = lambda docs, model: docs.selectExpr(
        "doc_id", "xxhash64(coalesce(text, '')) AS text_hash", "int(coalesce(text LIKE '%vile%', false)) AS predicted"
    )
    monkeypatch.setattr(corpus_pipeline, "score", marked)
    texts = [(None, "vile one"), (None, "clean"), (None, None), (1, "vile two"), (1, "other"), (2, "third")]
    docs = spark.createDataFrame([(i, t, "en", "web", 1) for i, t in texts], cases.SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: labels)
    left = corpus_pipeline.toxicity(spark, docs, "")
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([t for t in texts if "vile" not in (t[1] or "")])


def test_near_copies_go_alone(spark):
    a, b, c, d = (cases.prose(80, s) for s in (1, 2, 3, 4))
    near = b + " end"
    texts = [(1, a), (None, a), (None, c), (None, b), (None, b), (None, near), (2, d), (1, d), (None, None), (None, None), (None, " ")]
    docs = spark.createDataFrame([(i, t, "en", "web", 1) for i, t in texts], cases.SCHEMA).repartition(3)
    left = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    one = [t for t in (b, near) if (None, t) in left]
    assert len(one) == 1
    assert left == Counter([(1, a), (None, c), (None, one[0]), (1, d), (None, None), (None, None), (None, " ")])
    assert sum(r.kept for r in near_duplicates(docs.where("doc_id IS NOT NULL")).collect()) == 2
