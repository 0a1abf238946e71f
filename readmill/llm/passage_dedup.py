"""Passage dedup by winnowing over words: repeats go wherever in a line they begin and end.

Texts are runs of words, words being what stands between ASCII white space. A *window* is
``min_words`` words in a row. A window that stood earlier, by (doc_id, text hash, place), is a repetition;
touching and overlapping repetitions are one run, and its words are deleted. So a repeated run
is found from its first word to its last, whether or not it ends with a line.

Windows are not all compared. Each selects a fingerprint, a run of ``_gram`` words: the first whose two leading
words have certain hashes. One in so many runs is *rare*, more are *common* (``_sparsity``): a window selects its first rare one, where
it has none its first common one, and where it has neither its own first run. Neighbouring
windows mostly select the same one, and equal windows always do. So a text is a chain of marks, each with the
windows that select it, and the words of those windows are the mark's *context*. Marks that occur once end
there. Of equal contexts all but the first are repeated, extended both ways as far as the mark's windows
reach. Only the first of each context is looked at word by word, and only where its mark stands in other
contexts too: at the ends of a repeated run. What comes back from each comparison is one row per distinct
context or window, the first place, and a text's repeated windows are those of its own that are not
among them; so a passage that a third of all texts share is one row, not a group. A text's words become
one string of hashes of equal length, so that every run of words is a piece of it and costs one hash: a text
costs few passes over its words.

A text that occurs under several ids is compared once, for its first row; in the others every window
stood earlier, so that they go whole if they have ``min_words`` words.

A deleted word takes the white space before it along. If a run begins the text, the white space
after it goes too; if it held a line break and the rest of its last line stays, that rest
begins a line.

Everything is built-in functions. A NULL or empty text has no word and stays. Rows that share
``doc_id`` and text count as one document and are treated alike. A row without ``doc_id``
comes last. Texts are compared whole. An empty table gives an empty result. Other columns
pass through, except ``runs`` and ``clean_text``, which are replaced, and names that begin
with an underscore, which are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.llm.columns import passed
from readmill.session import materialise

MIN_WORDS = 50
#: In Java's expressions ``\s`` is [\x20\x09-\x0D] and nothing else, and the quicker way to say it.
SPACE = r"\s"
#: A word with the white space before it.
TOKEN = r"\s*\S+"
#: The highest bit: a number with it has as many hexadecimal digits as every other.
_HIGH = -(1 << 63)
#: Bytes of a word's hash.
_WIDTH = 8


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(_text()).alias("text_hash"))


def _gram(min_words: int) -> int:
    """Words of a fingerprint: a power of two, about a sixth of a window."""
    return 1 << max(0, (min_words // 6).bit_length() - 1)


def _sparsity(min_words: int) -> tuple[int, int]:
    """One in how many runs is a rare fingerprint, and one in how many a common one: then marks are few, and so are windows without."""
    places = min_words - _gram(min_words) + 1
    return max(1, places * 4 // 7), max(1, places * 2 // 11)


def _hashes() -> Column:
    """A hash with the highest bit of each word of ``text``."""
    words = F.array_remove(F.split(_text(), SPACE, -1), "")
    return F.transform(words, lambda w: F.xxhash64(w).bitwiseOR(_HIGH))


def _digits(hashes: Column) -> Column:
    """``hashes`` end to end, ``_WIDTH`` bytes each."""
    return F.unhex(F.array_join(F.transform(hashes, lambda h: F.hex(h)), ""))


def _run(digits: Column, begin: Column, count: Column) -> Column:
    """Hash of the ``count`` words from word ``begin`` on.

    ``digits`` should be a variable of a lambda: a column's bytes would be copied whole for each run.
    """
    return F.xxhash64(F.substring(digits, begin * _WIDTH + 1, count * _WIDTH))


def _held(rows: DataFrame, made: Column, name: str, *keep: str) -> DataFrame:
    """``keep`` and ``made`` through a one-row generator.

    Filters and lambdas on ``made`` then stay above it; the optimizer would otherwise copy the
    passes over a text's words into each place that names their result.
    """
    return rows.select(*keep, F.inline(F.array(F.struct(made.alias(name)))))


def _fingerprints(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, text_hash, n (words), and of the marks that the windows of each text select ``ends``, ``marks`` and ``contexts``.

    An end is the last window that selects the mark, after those that select the mark before. A mark is the hash of the
    words at its place; its context is the hash of all words from the first word of the first window that selects it to the
    last word of the last one. Arrays of numbers take half the room of structs.
    """
    gram = _gram(min_words)
    width = min_words - gram + 1
    keep = ("doc_id", "text_hash")
    size = F.size("hashes")
    last = size - min_words
    rare, common = _sparsity(min_words)
    # Two words: frequent words alone would begin too many or too few. The first one's hash alone rules out half.
    pairs = gram > 1 and common > 2

    def below(i: Column, every: int) -> Column:
        if not pairs:
            return F.get("hashes", i) < _HIGH + (1 << 63) // every
        return F.get("hashes", i).bitwiseXOR(F.get("hashes", i + 1)) < (1 << 64) // every

    def begins(i: Column) -> Column:
        return (F.get("hashes", i) < _HIGH // 2) & below(i, common) if pairs else below(i, common)

    def before(name: str, k: Column) -> Column:
        return F.coalesce(F.get(name, k - 1), F.lit(-1))

    def mark(place: Column, end: Column) -> Column:
        return F.struct(place.alias("place"), end.alias("end"))

    def let(value: Column, f) -> Column:
        return F.get(F.transform(F.array(value), f), F.lit(0))

    def reached(j: Column, k: Column) -> Column:
        """The marks after the rare fingerprint before and up to the one that is number ``j`` of all."""
        return let(before("rare", k), lambda previous: let(F.get("found", j), lambda stop: chained(j, previous, stop)))

    def chained(j: Column, previous: Column, stop: Column) -> Column:
        limit = stop - width  # the last window that ends before it reaches the stop
        passed_by = lambda m: before("found", previous + m + 1)
        inner = F.filter(F.slice("found", previous + 2, j - previous - 1), lambda _, m: passed_by(m) < limit)

        def piece(place: Column, m: Column) -> Column:
            # Windows without any fingerprint select their own first run.
            alone_to = F.least(place - width, limit)
            alone = F.transform(F.sequence(passed_by(m) + 1, alone_to), lambda b: mark(b, b))
            own = F.array(mark(place, F.when(place < stop, F.least(place, limit)).otherwise(stop)))
            return F.when(place - passed_by(m) <= width, own).when(alone_to > passed_by(m), F.concat(alone, own)).otherwise(own)

        between = F.flatten(F.transform(F.concat(inner, F.array(stop)), piece))
        return F.when(before("found", previous + 1) < limit, between).otherwise(F.array(mark(stop, stop)))

    rows = _held(_keyed(docs), _hashes(), "hashes", *keep)
    found = F.filter(F.sequence(F.lit(0), size - gram), begins)
    # After the last run there is a stop that no window selects.
    found = F.when(last >= 0, F.concat(found, F.array(size - gram + 1))).otherwise(F.array().cast("array<int>"))
    rows = _held(rows, found, "found", *keep, "hashes")
    places = F.when(last >= 0, F.sequence(F.lit(0), F.size("found") - 1)).otherwise(F.array().cast("array<int>"))
    stops = F.filter(places, lambda j: (j == F.size("found") - 1) | below(F.get("found", j), rare))
    rows = _held(rows, stops, "rare", *keep, "hashes", "found")
    rows = _held(rows, F.flatten(F.transform("rare", reached)), "chain", *keep, "hashes")
    # Once the last window has its place, no other follows.
    chain = F.filter("chain", lambda m, k: F.coalesce(F.get("chain", k - 1)["end"], F.lit(-1)) < last)
    rows = _held(rows, chain, "chain", *keep, "hashes")
    ends = F.transform("chain", lambda m: F.least(m["end"], last))
    rows = _held(rows, ends, "ends", *keep, "hashes", "chain")

    def context(digits: Column, end: Column, k: Column) -> Column:
        return _run(digits, before("ends", k) + 1, end - before("ends", k) - 1 + min_words)

    hashed = F.transform(F.array(_digits(F.col("hashes"))), lambda digits: F.struct(
        F.transform("chain", lambda m: _run(digits, m["place"], F.lit(gram))).alias("marks"),
        F.transform("ends", lambda e, k: context(digits, e, k)).alias("contexts"),
    ))
    return rows.select(*keep, size.alias("n"), "ends", F.inline(hashed))


def _mark(k: Column) -> Column:
    """Entry ``k`` of ``ends``, ``marks`` and ``contexts``; ``begin`` and ``last`` are the first and last window that select it."""
    begin = F.coalesce(F.get("ends", k - 1) + 1, F.lit(0))
    return F.struct(F.get("marks", k).alias("mark"), begin.alias("begin"), F.get("ends", k).alias("last"), F.get("contexts", k).alias("context"))


def _marks(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, text_hash, n (words) and ``marks``: the fingerprints that the windows of each text select."""
    return _fingerprints(docs, min_words).select(
        "doc_id", "text_hash", "n", F.transform("ends", lambda _, k: _mark(k)).alias("marks")
    )


def _numbered(rows: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per struct of ``column``: its fields and its place ``k`` there."""
    return rows.select(*keep, F.posexplode(column).alias("k", "_entry")).select(*keep, "k", "_entry.*")


def _unlisted(column: str, listed: str) -> Column:
    """The places of ``column`` that are not in ``listed``; the work is linear in both."""
    places = F.when(F.size(column) > 0, F.sequence(F.lit(0), F.size(column) - 1))
    none = F.array().cast("array<int>")
    return F.array_except(F.coalesce(places, none), F.coalesce(listed, none))


def _without_listed(column: str, listed: str) -> Column:
    """``column`` without the entries whose places are in ``listed``."""
    return F.transform(_unlisted(column, listed), lambda k: F.get(column, k))


def _lone(marks: DataFrame) -> DataFrame:
    """text_hash and ``lone``: the places ``k`` of marks that occur once in all texts."""
    counted = marks.groupBy("mark").agg(F.count("*").alias("c"), F.min("text_hash").alias("text_hash"), F.min("k").alias("k"))
    return counted.where("c = 1").groupBy("text_hash").agg(F.collect_list("k").alias("lone"))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """text_hash, doc_id (of the text's first row), copied, n (words) and runs of every text with something repeated.

    ``runs`` (first, last word from 0, sorted and merged; NULL if there are none) are those of the
    first row; in other rows of the text all words are repeated.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    # A text's marks are the same in all of its rows.
    firsts = _fingerprints(docs, min_words).where(f"n >= {min_words}").groupBy("text_hash").agg(
        F.min(row).alias("first"), F.max(row).alias("last"), *[F.first(c).alias(c) for c in ("n", "ends", "marks", "contexts")]
    )
    firsts = materialise(firsts, "passage-texts")

    # Marks that occur once leave first: no window that selects them is repeated.
    lone = _lone(firsts.select("text_hash", F.posexplode("marks").alias("k", "mark")))
    shared = firsts.drop("last").join(lone, "text_hash", "left")
    shared = _held(shared, _unlisted("marks", "lone"), "left", "text_hash", "first", "n", "ends", "marks", "contexts")
    marks = F.transform("left", _mark)
    shared = materialise(shared.where(F.size("left") > 0).select("text_hash", "first", marks.alias("marks")), "passage-marks")

    # Of equal contexts all but the first are repeated from end to end.
    place = F.struct("first.none", "first.doc_id", "text_hash", "begin", F.col("last").alias("end"), "mark", "k")
    origins = _numbered(shared, "marks", "text_hash", "first").groupBy("context").agg(F.min(place).alias("o")).select("o.*")
    spans = origins.groupBy("text_hash", "none", "doc_id").agg(F.collect_list(F.struct("begin", "end", "mark", "k")).alias("spans"))
    spans = materialise(spans, "passage-contexts")
    listed = spans.select("text_hash", F.col("spans.k").alias("listed"))
    copies = shared.join(listed, "text_hash", "left").select("text_hash", _without_listed("marks", "listed").alias("marks"))
    span = lambda begin, end: F.struct(begin.alias("begin"), end.alias("end"))
    whole = copies.select("text_hash", F.transform("marks", lambda m: span(m["begin"], m["last"])).alias("spans"))

    # Windows of the first contexts are compared one by one where their mark has other contexts.
    lone = _lone(_numbered(spans.select("text_hash", F.transform("spans", lambda s: s.dropFields("k")).alias("spans")), "spans", "text_hash"))
    asked = spans.join(lone, "text_hash", "left").select("text_hash", "none", "doc_id", _without_listed("spans", "lone").alias("spans"))
    asked = materialise(asked.where(F.size("spans") > 0), "passage-spans")
    first = _first_windows(docs, asked, min_words)
    none = F.array().cast("array<int>")
    begins = F.flatten(F.transform("spans", lambda s: F.sequence(s["begin"], s["end"])))
    parts = asked.join(first, "text_hash", "left").select("text_hash", F.array_except(begins, F.coalesce("known", none)).alias("begins"))
    parts = _held(parts, F.col("begins"), "begins", "text_hash")
    firsts_of = F.filter("begins", lambda b, i: ~F.coalesce(F.get("begins", i - 1) == b - 1, F.lit(False)))
    lasts_of = F.filter("begins", lambda b, i: ~F.coalesce(F.get("begins", i + 1) == b + 1, F.lit(False)))
    parts = parts.select("text_hash", F.zip_with(firsts_of, lasts_of, span).alias("spans"))

    # A window selects one mark, so that a text's repeated spans are apart; a row here is bounded by its text.
    both = whole.unionByName(parts).groupBy("text_hash").agg(F.collect_list("spans").alias("spans"))
    sorted_spans = _held(both, F.sort_array(F.flatten("spans")), "spans", "text_hash")
    runs = sorted_spans.where(F.size("spans") > 0).select("text_hash", _runs(F.col("spans"), min_words).alias("runs"))
    found = firsts.select("text_hash", "first.doc_id", (F.col("first") != F.col("last")).alias("copied"), "n")
    return found.join(runs, "text_hash", "left").where("copied OR runs IS NOT NULL")


def _first_windows(docs: DataFrame, spans: DataFrame, min_words: int) -> DataFrame:
    """Per text of ``spans`` the places ``known`` of windows in its spans that stand nowhere earlier.

    One row per distinct window comes back, however often it occurs.
    """
    asked = spans.select(F.col("text_hash").alias("_text_hash"), F.col("none").alias("_none"), F.col("doc_id").alias("_doc_id"), "spans")
    texts = _keyed(docs).join(asked, F.col("text_hash") == F.col("_text_hash"))
    # Not a condition of the join: texts are shuffled here as they are for the deletion.
    texts = texts.where(F.coalesce(F.col("doc_id") == F.col("_doc_id"), F.col("doc_id").isNull() & F.col("_none")))
    begins = F.flatten(F.transform("spans", lambda s: F.sequence(s["begin"], s["end"])))
    windows = F.transform(F.array(_digits(_hashes())), lambda digits: F.transform(
        begins, lambda i: F.struct(i.alias("begin"), _run(digits, i, F.lit(min_words)).alias("hash"))
    ))
    listed = texts.select("doc_id", "text_hash", F.inline(F.flatten(windows)))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "begin")
    firsts = listed.groupBy("hash").agg(F.min(place).alias("o"))
    return firsts.groupBy("o.text_hash").agg(F.collect_list("o.begin").alias("known"))


def _runs(spans: Column, min_words: int) -> Column:
    """Merged runs of the windows of the sorted ``spans`` (first and last window)."""
    apart = lambda a, b: a.isNull() | b.isNull() | (b["begin"] - a["end"] > min_words)
    firsts = F.filter(spans, lambda s, i: apart(F.get(spans, i - 1), s))
    lasts = F.filter(spans, lambda s, i: apart(s, F.get(spans, i + 1)))
    return F.zip_with(firsts, lasts, lambda a, b: F.struct(a["begin"].alias("first"), (b["end"] + (min_words - 1)).alias("last")))


def _without(text: Column, runs: Column) -> Column:
    """What is left of ``text`` without the words of ``runs``."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    tail = F.substring(text, F.length(F.rtrim(text, F.lit(" \t\n\v\f\r"))) + 1, F.length(text))

    def left(tokens: Column) -> Column:
        joined = lambda begin, end: F.array_join(F.slice(tokens, begin + 1, F.greatest(end - begin, F.lit(0))), "")

        def piece(run: Column, i: Column) -> Column:
            end = F.coalesce(F.get(runs, i + 1)["first"], F.size(tokens))
            kept = joined(run["last"] + 1, end)
            broken = joined(run["first"], run["last"] + 1).contains("\n") & ~kept.rlike(r"^[\x20\x09-\x0D]*\n")
            bare = F.regexp_replace(kept, r"^[\x20\x09-\x0D]+", "")
            return F.when(run["first"] == 0, bare).when(broken & (bare != ""), F.concat(F.lit("\n"), bare)).otherwise(kept)

        return F.concat(joined(F.lit(0), F.get(runs, F.lit(0))["first"]), F.array_join(F.transform(runs, piece), ""))

    done = F.transform(F.array(tokens), left)[0]
    return F.when(done == "", F.lit("")).otherwise(F.concat(done, tail))


def dedup_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``clean_text`` and ``runs`` of words (NULL where nothing is deleted)."""
    found = repeated_passages(docs, min_words).select(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash"), "copied", "n", F.col("runs").alias("_runs")
    )
    found = found.select("_text_hash", F.struct("_doc_id", "n", "_runs").alias("_found"))
    keyed = passed(docs, ("runs", "clean_text")).withColumn("_hash", F.xxhash64(_text()))
    joined = keyed.join(found, F.col("_hash") == F.col("_text_hash"), "left")
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("_found.n") - 1).alias("last")))
    first = F.col("doc_id").eqNullSafe(F.col("_found._doc_id"))
    runs = F.when(F.col("_found").isNull(), None).when(first, F.col("_found._runs")).otherwise(whole)
    joined = joined.withColumn("runs", runs)
    clean = F.when(F.col("runs").isNull(), F.col("text")).when(~first, "").otherwise(_without(F.col("text"), F.col("runs")))
    return joined.withColumn("clean_text", clean).drop("_text_hash", "_hash", "_found")


def dedup_passage_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every document: how many lines it has, how many words it loses, and which.

    ``deleted`` lists the runs as first-last word numbers from 0; ``clean_text`` is what is left.
    """
    done = dedup_passages(docs.select("doc_id", "text"), min_words)
    runs = F.coalesce("runs", F.array().cast("array<struct<first:int,last:int>>"))
    return done.select(
        "doc_id",
        (F.octet_length(_text()) - F.octet_length(F.replace(_text(), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1).alias("n_deleted"),
        F.array_join(F.transform(runs, lambda r: F.concat_ws("-", r["first"].cast("string"), r["last"].cast("string"))), ",").alias("deleted"),
        F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("clean_sha256"),
        "clean_text",
    )
