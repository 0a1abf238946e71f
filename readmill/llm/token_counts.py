"""Token counts by a map-side lookup in two tiers.

The first tier is a compact table of frequent pre-tokens and their lengths, at most
``TABLE_ENTRIES`` of at most ``pretokens.CACHE_CHARS`` characters (a few MB), that every
task gets by broadcast. The second tier are the workers' caches for all other pre-tokens.
The corpus itself is never shuffled, neither texts nor pre-tokens.

The first tier is fitted on a random sample of about ``FIT_ROWS`` documents. It only
decides what is looked up where: counts are the library's, whatever the sample holds.

A NULL text is empty and has 0 tokens. Repeated rows, NULL ids and very long texts are
rows like others; an empty table gives an empty result. Only ``doc_id`` and ``text`` are
read, so that other columns may have any name.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmill.llm.batches import map_arrow, slices
from readmill.llm.pretokens import CACHE_CHARS, ByteCounts, encode_parts

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: The sample that the table of frequent pre-tokens is fitted on, and its entries.
FIT_ROWS = 10_000
TABLE_ENTRIES = 65_536

_counters: dict = {}


def frequent_table(docs: DataFrame, path: str, fit_rows: int = FIT_ROWS, entries: int = TABLE_ENTRIES):
    """(pre-tokens joined by NUL, their lengths as bytes): the most frequent of a sample."""
    share = min(1.0, fit_rows / max(docs.count(), 1))

    def count(batches):
        split, found = ByteCounts(path, {}), Counter()
        for batch in batches:
            for _, texts in slices(batch, "text"):
                for text in texts:
                    for piece in split.pieces(text) or ():
                        found.update(split.split(piece))
                if len(found) > 4 * entries:
                    found = Counter(dict(found.most_common(entries)))
        kept = [(k, n) for k, n in found.most_common(entries) if len(k) <= CACHE_CHARS and "\0" not in k]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["part", "n"]
        )

    sample = docs.select("text").sample(share, seed=5) if share < 1 else docs.select("text")
    counts = map_arrow(sample, count, "part string, n long").groupBy("part").agg(F.sum("n").alias("n"))
    top = [r.part for r in counts.orderBy(F.desc("n"), "part").limit(entries).collect()]
    lengths = [len(i) for i in encode_parts(path, top)]
    return "\0".join(top).encode(), np.asarray(lengths, dtype="u1").tobytes()


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    path = path or public_tokenizers.path(TOKENIZER)
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path))
    name = str(hash(table.value))

    def task(batches):
        if (path, name) not in _counters:
            _counters.clear()
            keys, lengths = table.value
            parts = keys.decode().split("\0") if lengths else []
            _counters[path, name] = ByteCounts(path, dict(zip(parts, lengths)))
        counter = _counters[path, name]
        for batch in batches:
            for part, texts in slices(batch, "text"):
                tokens = counter(texts)
                sizes = [len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array([n > limit for n in tokens], pa.bool_()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return map_arrow(
        docs.select("doc_id", "text"), task, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
