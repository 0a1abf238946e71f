"""Timestamps and durations as they appear on the wire."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from readmill.functions import variants as V
from readmill.functions.variants import Field

# Fixed pattern: the ISO-8601 / RFC3339 texts accepted as instants. The guard is
# needed because a bare cast also takes '2026', 'T03:00' and padded text.
_INSTANT = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?([+-]\d{2}:?\d{2}|Z)?)?$"
)
_ZONED = r"[T ].*(Z|[+-]\d{2}:?\d{2})$"

_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$"

# From 2**30 seconds on (January 2004), the sum of whole seconds and the rounded
# fraction is the correctly rounded quotient: no multiple of a nanosecond comes
# closer than 6e-14 s to the midpoint of two doubles.
_EXACT_NS = (1 << 30) * 1_000_000_000

# Fixed value: nanoseconds at the end of year 9999.
MAX_NS = 253402300799999999999
_MAX_SECONDS = 253402300800.0


def instant(value: Column) -> Column:
    """RFC3339 text -> TIMESTAMP; naive text is UTC whatever the session zone."""
    clean = F.replace(value, F.lit(","), F.lit("."))
    timed = F.when(F.length(clean) == 10, F.concat(clean, F.lit("T00:00:00"))).otherwise(clean)
    # A zone is only understood after seconds, so '03+02:00' and '03:00Z' are filled up.
    minutes = F.regexp_replace(timed, r"^(.{10}[T ]\d{2})(?!:)", "$1:00")
    filled = F.when(timed.rlike(r"^.{10}[T ]\d{2}:\d{2}:"), timed).otherwise(
        F.regexp_replace(minutes, r"^(.{10}[T ]\d{2}:\d{2})(?!:)", "$1:00")
    )
    zoned = F.when(filled.rlike(_ZONED), filled).otherwise(F.concat(filled, F.lit("Z")))
    return F.when(value.rlike(_INSTANT), zoned.try_cast("timestamp"))


def instant_field(f: Field) -> Column:
    """As :func:`instant` on a field; text forms of other types never match."""
    return instant(f.text)


def ns_seconds(f: Field, n: Column) -> Column:
    """Nanoseconds -> seconds as the correctly rounded double. ``n`` is ``integer(f)``."""
    second = F.lit(1000000000).cast("bigint")
    recent = F.call_function("div", n, second) + (n % second) / F.lit(1e9)
    wide = V.wide_integer(f).try_cast("decimal(21,0)")
    other = (wide / F.lit(1000000000).cast("decimal(10,0)")).cast("double")
    return F.when(n >= F.lit(_EXACT_NS), recent).otherwise(other)


def seconds_instant(seconds: Column) -> Column:
    """Seconds as a double -> TIMESTAMP, the fraction rounded half-even to microseconds."""
    whole = F.when(seconds < 0, F.ceil(seconds)).otherwise(F.floor(seconds))
    micros = whole * F.lit(1000000) + F.bround((seconds - whole) * F.lit(1e6)).cast("bigint")
    return F.when(F.abs(seconds) < F.lit(_MAX_SECONDS), F.timestamp_micros(micros))


def positive_instant(seconds: Column) -> Column:
    """Zero and below mean unset."""
    return F.when(seconds > 0, seconds_instant(seconds))


def ns_instant(f: Field) -> Column:
    """Integer nanoseconds -> TIMESTAMP; zero and below mean unset."""
    return positive_instant(ns_seconds(f, V.integer(f)))


def ns_instant_or(f: Field, default: Column) -> Column:
    """Integer nanoseconds of any sign; the default when unusable."""
    return F.coalesce(seconds_instant(ns_seconds(f, V.integer(f))), default)


def ns_out_of_range(f: Field) -> Column:
    short = F.coalesce(F.length(f.text) <= 19, F.lit(True))
    beyond = V.wide_integer(f) > F.lit(str(MAX_NS)).cast("decimal(38,0)")
    return V.unless_settled(short, False, F.coalesce(beyond, F.lit(False)))


def duration_seconds(f: Field) -> Column:
    """'3.5s', '120s', '90' or a number -> whole seconds, truncated."""
    body = F.regexp_replace(f.text, "s$", "")
    return (
        F.when(body.rlike(_NUMBER), body.try_cast("double").try_cast("bigint"))
        .when(V.is_boolean(f), f.get("bigint"))
    )


def bad_duration(f: Field) -> Column:
    """Infinite durations cannot be whole seconds."""
    return F.coalesce(f.text.rlike(r"(?i)^\s*[+-]?inf(inity)?\s*s?$"), F.lit(False))


def epoch_micros(ts: Column) -> Column:
    """TIMESTAMP -> BIGINT microseconds since 1970-01-01 UTC."""
    return F.unix_micros(ts)
