"""Toxicity of whole texts, by a recurrent network over all overlapping windows.

The network (``gru``) scores windows of ``WINDOW`` words that begin every ``STRIDE`` words. A
text's logit is the greatest of its windows', and two numbers fitted on texts set aside from
training turn it into a probability.

Training is weakly supervised, as labels are for texts: windows of toxic texts are first chosen
by how much more frequent their words and word beginnings are in toxic texts, then by the
network itself. Clean texts give windows drawn at random, and those that look most toxic.
It uses at most ``FIT_TOXIC`` toxic and ``FIT_CLEAN`` clean labelled texts of at most
``FIT_CHARS`` characters, chosen by a hash of their ids; texts whose crc32(doc_id) is a multiple
of ``FOLDS`` are never used. Nothing but the text enters a score.

In the workers, what a word adds to the gates is computed once and kept in a bounded table,
so that a text costs two short recurrences per window.

A NULL or empty text, and one without letters or digits, gets the share of toxic texts among
the labelled ones, at most 0.49. Without labels of both kinds every score is 0. Long texts are scored whole, words
beyond ``WORD_CHARS`` characters in pieces. Rows without ``doc_id`` count as held out. Repeated
rows get equal scores. Rows of ``labels`` that repeat or contradict each other count as toxic
if one of them says so. An empty table gives an empty result. Of ``docs`` only ``doc_id`` and ``text``, of ``labels`` only ``doc_id``
and ``toxic`` are read, so that other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.llm import gru
from readmill.llm.batches import map_arrow, slices

FIT_TOXIC, FIT_CLEAN = 1_000, 2_000
FIT_CHARS = 50_000
FOLDS = 5
VOCABULARY = 20_000
THRESHOLD = 0.5
BATCH = 256
#: Windows drawn from clean texts in all, if that is more than three of each.
CLEAN_WINDOWS = 6_000
EPOCHS = (2, 2)
RATE = 0.015
#: Rows of a worker's table of word inputs.
TABLE_WORDS = 300_000
#: Windows that are scored at once.
WINDOWS = 4_096

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    found = _WORD.findall(text.lower())
    n = gru.WORD_CHARS
    if any(len(w) > n for w in found):
        found = [w[i : i + n] for w in found for i in range(0, len(w), n)]
    return found


def window_starts(counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, start within the owner) of all windows of texts with so many words."""
    number = np.maximum(1, -(-(np.asarray(counts) - gru.WINDOW) // gru.STRIDE) + 1) * (np.asarray(counts) > 0)
    owner = np.repeat(np.arange(len(counts)), number)
    first = np.cumsum(number) - number
    return owner, (np.arange(len(owner)) - first[owner]) * gru.STRIDE


class Scorer:
    """Greatest window logits of texts, with a table of word inputs."""

    def __init__(self, parameters: dict, vocabulary: dict[str, int]):
        self.p, self.vocabulary = parameters, vocabulary
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((4_096, 6 * gru.WORD_STATE), dtype=np.float32)

    def _learn(self, words: set) -> None:
        new = sorted((w for w in words if w not in self.rows), key=len)  # short ones take few steps
        if len(self.rows) + len(new) > TABLE_WORDS and self.rows:
            self.clear()
            new = sorted(words, key=len)
        at = len(self.rows)
        if at + len(new) > len(self.table):
            grown = np.zeros((2 * (at + len(new)), self.table.shape[1]), dtype=np.float32)
            grown[:at] = self.table[:at]
            self.table = grown
        for i in range(0, len(new), 8_192):
            part = new[i : i + 8_192]
            numbers = np.array([self.vocabulary.get(w, 0) for w in part])
            self.table[at + i : at + i + len(part)] = gru.word_inputs(self.p, numbers, gru.spell(part))
        self.rows.update(zip(new, range(at, at + len(new))))

    def windows(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, start, logit) of every window."""
        self._learn(set().union(*texts) if texts else set())
        counts = [len(t) for t in texts]
        owner, start = window_starts(counts)
        row = self.rows.__getitem__
        ids = np.fromiter((i for t in texts for i in map(row, t)), dtype=np.int64, count=sum(counts))
        ids = np.concatenate((ids, np.zeros(gru.WINDOW, dtype=np.int64)))
        ends = np.cumsum(counts) if counts else np.zeros(0, dtype=np.int64)
        begins = ends - np.asarray(counts, dtype=np.int64)
        logits = np.empty(len(owner), dtype=np.float32)
        step = np.arange(gru.WINDOW)[:, None]
        for i in range(0, len(owner), WINDOWS):
            at = begins[owner[i : i + WINDOWS]] + start[i : i + WINDOWS]
            place = at[None, :] + step
            mask = (place < ends[owner[i : i + WINDOWS]][None, :]).astype(np.float32)
            logits[i : i + WINDOWS] = gru.window_logits(self.p, self.table, ids[np.minimum(place, len(ids) - 1)], mask)
        return owner, start, logits

    def __call__(self, texts: list[list[str]]) -> np.ndarray:
        """The greatest logit of each text; NaN for one without words."""
        owner, _, logits = self.windows(texts)
        best = np.full(len(texts), -np.inf, dtype=np.float32)
        np.maximum.at(best, owner, logits)
        return np.where(np.isfinite(best), best, np.nan)


def _marks(word: str) -> tuple[str, ...]:
    return (word, "^" + word[:4], "^" + word[:5])


def _suspicion(texts: list[list[str]], toxic: np.ndarray) -> dict[str, float]:
    """How much more frequent words and their beginnings are in toxic texts: log ratios."""
    counts = (Counter(), Counter())
    for words, y in zip(texts, toxic):
        counts[int(y)].update({m for w in set(words) for m in _marks(w)})
    total = np.bincount(toxic.astype(int), minlength=2)
    return {
        m: float(np.log((n + 0.5) / (total[1] + 1)) - np.log((counts[0][m] + 0.5) / (total[0] + 1)))
        for m, n in counts[1].items()
        if n > 1
    }


def _train(model: tuple[dict, dict], windows: list[tuple[list[str], int]], epochs: int, rate: float, rng) -> None:
    parameters, vocabulary = model
    update = gru.Adam(parameters, rate)
    target = np.array([y for _, y in windows], dtype=np.float32)
    balance = np.where(target == 1, 0.5 / max(target.mean(), 1e-6), 0.5 / max(1 - target.mean(), 1e-6)).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            part = [windows[k][0] for k in order[i : i + BATCH]]
            distinct = sorted(set().union(*part))
            row = {w: k for k, w in enumerate(distinct)}
            ids = np.zeros((gru.WINDOW, len(part)), dtype=np.int64)
            mask = np.zeros(ids.shape, dtype=np.float32)
            for k, words in enumerate(part):
                ids[: len(words), k] = [row[w] for w in words]
                mask[: len(words), k] = 1
            numbers = np.array([vocabulary.get(w, 0) for w in distinct])
            # Some known words count as unknown, so that their characters have to tell.
            numbers = np.where(rng.random(len(numbers)) < 0.3, 0, numbers)
            _, gradients = gru.loss_gradients(
                parameters, numbers, gru.spell(distinct), ids, mask, target[order[i : i + BATCH]], balance[order[i : i + BATCH]]
            )
            gradients["word"][0] = 0
            update(gradients)


def fit(texts: list[str], labels: list[int], share: float | None = None, seed: int = 2) -> dict | None:
    """Parameters, vocabulary and calibration; None without labels of both kinds.

    ``share`` is the share of toxic texts to calibrate for, that of the given texts by default.
    """
    split = [words_of(t) for t in texts]
    kept = [i for i, w in enumerate(split) if w]
    split, toxic = [split[i] for i in kept], np.array([labels[i] for i in kept], dtype=int)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    rng = np.random.default_rng(seed)
    aside = np.zeros(len(toxic), dtype=bool)
    for y in (0, 1):  # a fifth of each kind is for the calibration
        own = rng.permutation(np.flatnonzero(toxic == y))
        aside[own[: len(own) // 5]] = True
    train = np.flatnonzero(~aside)
    suspicion = _suspicion([split[i] for i in train], toxic[train])
    frequent = Counter(w for i in train for w in set(split[i]))
    vocabulary = {w: k + 1 for k, (w, n) in enumerate(frequent.most_common(VOCABULARY)) if n > 1}
    parameters = gru.new_parameters(len(vocabulary) + 1, seed)
    parameters["word"][0] = 0

    windows: list[tuple[list[str], int]] = []
    drawn = max(3, round(CLEAN_WINDOWS / max(1, (toxic[train] == 0).sum())))
    for i in train:
        words = split[i]
        _, starts = window_starts([len(words)])
        level = [max((suspicion.get(m, -9.0) for m in _marks(w)), default=-9.0) for w in words]
        best = np.array([max(level[s : s + gru.WINDOW]) for s in starts])
        if toxic[i]:
            chosen = np.argsort(-best, kind="stable")[:3]
            chosen = [k for k in chosen if best[k] >= best.max() - 0.5]
        else:
            chosen = {int(np.argmax(best)), *rng.choice(len(starts), min(drawn, len(starts)), replace=False).tolist()}
        windows += [(words[starts[k] : starts[k] + gru.WINDOW], int(toxic[i])) for k in chosen]
    rounds = max(1, round(8_000 / len(windows)))  # small tables are gone through more often
    _train((parameters, vocabulary), windows, EPOCHS[0] * rounds, RATE, rng)
    owner, start, logit = Scorer(parameters, vocabulary).windows([split[i] for i in train])
    order = np.lexsort((start, -logit, owner))
    first = order[np.concatenate(([True], owner[order][1:] != owner[order][:-1]))]
    for k in first:
        words, at = split[train[owner[k]]], start[k]
        windows.append((words[at : at + gru.WINDOW], int(toxic[train[owner[k]]])))
    _train((parameters, vocabulary), windows, EPOCHS[1] * rounds, RATE / 3, rng)

    held = np.flatnonzero(aside) if aside.any() and len(set(toxic[aside])) == 2 else train
    slope, shift = _calibrate(Scorer(parameters, vocabulary)([split[i] for i in held]), toxic[held])
    drawn_share = float(toxic.mean())
    share = drawn_share if share is None else min(max(share, 1e-4), 1 - 1e-4)
    odds = lambda x: np.log(x / (1 - x))
    shift += float(odds(share) - odds(drawn_share))
    return {
        "parameters": parameters, "vocabulary": vocabulary, "slope": slope, "shift": shift,
        "share": min(0.49, share),
    }


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton's steps with a slight pull to slope 1."""
    a, b = 1.0, 0.0
    x = x.astype(float)
    goal = np.where(y == 1, 1 - 1 / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):
        chance = gru.sigmoid(a * x + b)
        spread = chance * (1 - chance)
        gradient = np.array([((chance - goal) * x).sum() + 0.1 * (a - 1), (chance - goal).sum() + 0.01 * b])
        bend = np.array([[(spread * x * x).sum() + 0.1, (spread * x).sum()], [(spread * x).sum(), spread.sum() + 0.01]])
        move = np.linalg.solve(bend, gradient)
        move *= min(1.0, 2.0 / max(np.abs(move).max(), 1e-9))
        a, b = max(a - move[0], 0.05), b - move[1]
        if np.abs(move).max() < 1e-6:
            break
    return float(a), float(b)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit_on(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Fit on the labelled texts that are not held out, a bounded number of them."""
    docs = docs.select("doc_id", "text")
    known = labels.select("doc_id", "toxic").where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    short = docs.where(F.length("text") <= FIT_CHARS).select("doc_id")
    fitting = known.join(short, "doc_id", "left_semi")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect() if r["toxic"] in (0, 1)}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    pick = lambda y, n: fitting.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = pick(1, FIT_TOXIC).unionByName(pick(0, FIT_CLEAN))  # at most 3,000 pairs of numbers
    rows = docs.join(F.broadcast(chosen), "doc_id").where(F.length("text") <= FIT_CHARS)
    found = rows.select("doc_id", "text", "toxic").dropDuplicates(["doc_id"]).collect()
    found.sort(key=lambda r: r["doc_id"])
    return fit([r["text"] for r in found], [int(r["toxic"]) for r in found], share)


_scorers: dict = {}


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, text_hash, score and predicted of every document."""
    out = "doc_id long, text_hash long, score double, predicted int"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    if model is None:
        return docs.select("doc_id", "text_hash", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    name = f"{model['slope']!r} {model['shift']!r} {len(model['vocabulary'])}"
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        if name not in _scorers:
            _scorers.clear()
            _scorers[name] = Scorer(sent.value["parameters"], sent.value["vocabulary"])
        scorer, m = _scorers[name], sent.value
        for batch in batches:
            for part, texts in slices(batch, "text"):
                logit = scorer([words_of(t) for t in texts]).astype(float)
                chance = np.where(np.isnan(logit), m["share"], gru.sigmoid(m["slope"] * logit + m["shift"]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        part.column("text_hash"),
                        pa.array(chance, pa.float64()),
                        pa.array((chance >= THRESHOLD).astype(np.int32), pa.int32()),
                    ],
                    ["doc_id", "text_hash", "score", "predicted"],
                )

    return map_arrow(docs, task, out)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest columns for every document."""
    scored = score(docs, fit_on(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
