"""Which columns of a table an operator passes through."""

from __future__ import annotations

from pyspark.sql import DataFrame


def passed(docs: DataFrame, made: tuple[str, ...]) -> DataFrame:
    """``docs`` without columns that the operator makes itself, and without names that begin with an underscore."""
    return docs.select(*[f"`{c}`" for c in docs.columns if c not in made and not c.startswith("_")])
