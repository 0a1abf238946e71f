"""Places of pattern matches in texts, with built-in functions only.

Places are counted in code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Running sums are taken over blocks of this many numbers, then over the blocks.
BLOCK = 256


def _running(numbers: Column, start: Column) -> Column:
    """[start, start + n1, start + n1 + n2, ...]"""
    return F.aggregate(
        numbers, F.array(start), lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n))
    )


def sums_before(numbers: Column) -> Column:
    """For each of the whole numbers the sum of those before it.

    Appending to an array copies it; two levels keep the work for long arrays near linear.
    """
    zero = F.lit(0).cast("int")
    blocks = F.when(F.size(numbers) > 0, F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / F.lit(BLOCK)).cast("int")))
    block = lambda b: F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK))
    sums = F.transform(blocks, lambda b: F.aggregate(block(b), zero, lambda a, n: a + n))
    starts = _running(sums, zero)
    parts = F.transform(
        blocks,
        lambda b: F.slice(_running(block(b), F.element_at(starts, b + 1)), F.lit(1), F.size(block(b))),
    )
    return F.coalesce(F.flatten(parts), F.array().cast("array<int>"))


def match_starts(matches: Column, gaps: Column) -> Column:
    """Starts of the matches, given the texts of the matches and of the gaps around them."""
    steps = F.zip_with(matches, F.slice(gaps, F.lit(2), F.size(matches)), lambda m, g: F.length(m) + F.length(g))
    first = F.length(F.element_at(gaps, 1))
    return F.transform(sums_before(steps), lambda s: s + first)
