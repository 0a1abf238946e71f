import gc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from readmill.llm import pretokens
from readmill.llm.packing import best_fit, pack_documents
from readmill.llm.token_counts import count_tokens
from tests.llm import cases

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


ODD = "aB é'sß  \n\t.,!7²İſ ́漢<|endoftext|>_-“”"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(ODD), max_size=40), max_size=5))
def test_ids_and_counts_are_the_librarys(texts):
    assert [np.frombuffer(i, "<u4").tolist() for i in pretokens.WordIds(WORD)(texts)] == library(WORD, texts)
    frequent = {"a": 1, " B": 1}
    assert pretokens.ByteCounts(BYTE, frequent)(texts) == [len(i) for i in library(BYTE, texts)]


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(pretokens, "CACHE_ENTRIES", 20)
    texts = [cases.prose(60, s % 7) for s in range(30)]
    word, count = pretokens.WordIds(WORD), pretokens.ByteCounts(BYTE, {})
    for i in range(0, 30, 3):
        part = texts[i : i + 3]
        assert [np.frombuffer(x, "<u4").tolist() for x in word(part)] == library(WORD, part)
        assert count(part) == [len(x) for x in library(BYTE, part)]


def test_every_ordinary_character_and_blank_ends():
    ordinary = [c for c in map(chr, range(0x2030)) if not pretokens.ODD.search(c)]
    texts = [f"a{c}b X{c} {c}" for c in ordinary] + ["", " ", "\t a \n", "\x0ba\x0c", "a..b,c 's'Still"]
    assert [np.frombuffer(i, "<u4").tolist() for i in pretokens.WordIds(WORD)(texts)] == library(WORD, texts)


def test_new_words_leave_no_small_containers_behind():
    """The garbage collector would walk over all of them, again and again."""
    words, runs = pretokens.WordIds(WORD), []
    text = " ".join(f"w{chr(97 + i % 26)}{cases.SYLLABLES[i % 7]}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}x." for i in range(17_000))
    words(["warm up"])
    gc.collect()
    gc.callbacks.append(lambda phase, info: runs.append(phase))
    try:
        words([text])
    finally:
        gc.callbacks.pop()
    assert len(words.chunks.young) > 15_000 and runs.count("start") <= 5


@pytest.mark.parametrize("rule", ["norm", "dot"])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_keeps_every_capacity(rule, lengths):
    lengths = np.array(lengths, dtype=np.int64)
    place, offset = best_fit(lengths, 50, documents=4, attention=1500 if not len(lengths) or lengths.max() < 38 else 2500, weights=(1, 0.5, 0.2), rule=rule)
    limit = 1500 if not len(lengths) or lengths.max() < 38 else 2500
    for p in set(place.tolist()):
        own = np.flatnonzero(place == p)
        assert lengths[own].sum() <= 50 and len(own) <= 4 and (lengths[own] ** 2).sum() <= limit
        spans = sorted((offset[i], offset[i] + lengths[i]) for i in own)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_best_fit_takes_the_fullest_that_fits():
    place, _ = best_fit(np.array([6, 7, 3, 4]), 10)
    assert place[0] == place[3] and place[1] == place[2]
    with pytest.raises(ValueError):
        best_fit(np.array([11]), 10)


def test_packing_of_odd_documents(spark):
    docs = cases.clashing(cases.documents(spark), "piece start length sequence_id offset _group")
    found = pack_documents(docs, tokens=256).collect()
    want = Counter()
    for doc_id, text, *_ in cases.rows():
        ids = np.array(library(WORD, [text or ""])[0] + [0], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            want[doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= 256
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert len(sequences) <= 1.02 * sum(r.length for r in found) / 256 + 2


def test_counts_of_odd_documents(spark):
    docs = cases.clashing(cases.documents(spark), "n_tokens part n")
    found = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs).collect())
    lengths = [len(i) for i in library(BYTE, [r[1] or "" for r in cases.rows()])]
    assert found == Counter((r[0], len((r[1] or "").encode()), n, n > 1024) for r, n in zip(cases.rows(), lengths))


def test_empty_tables(spark):
    assert pack_documents(cases.empty(spark)).collect() == []
    assert count_tokens(cases.empty(spark)).collect() == []
