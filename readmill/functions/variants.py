"""Reading VARIANT messages with the dynamic-language rules producers rely on.

A field can be absent (SQL NULL), JSON null (a VARIANT null) or a value. Those
three cases are kept apart because several columns default only when absent.

Fields are addressed by path from the message and read straight into the wanted
type: cutting out nested VARIANTs first would copy them again and again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
_FLOAT_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
# Texts that are falsy unless the value is itself a string.
_FALSY_TEXTS = ("0", "0.0", "-0.0", "false", "[]", "{}")


@dataclass(frozen=True)
class Field:
    """A path inside a VARIANT column; the empty path is the whole value.

    ``share`` may name an expression and hand back a reference to it, so that the text
    of a scalar is read once however often it is tested.
    """

    root: Column
    path: str = ""
    share: Callable[[str, Column], Column] | None = None

    def __truediv__(self, name: str) -> Field:
        return Field(self.root, f"{self.path}.{name}", self.share)

    def get(self, kind: str, below: str = "") -> Column:
        return F.try_variant_get(self.root, f"${self.path}{below}", kind)

    @property
    def text(self) -> Column:
        """String form; NULL for absent and JSON null."""
        read = self.get("string")
        return self.share(f"text{self.path.replace('.', '_')}", read) if self.share else read

    @property
    def variant(self) -> Column:
        return self.get("variant")

    @property
    def boolean(self) -> Column:
        return self.get("boolean")

    @property
    def kind(self) -> Column:
        """Type name such as STRING, BIGINT or OBJECT<..>; NULL when absent."""
        return F.schema_of_variant(self.variant)


def unless_settled(settled: Column, value: bool, rest: Column) -> Column:
    """``value`` where the cheap test holds, else ``rest``.

    A boolean CASE would be rewritten to AND / OR, whose both sides take part in common
    subexpression elimination and are then always computed. COALESCE stays lazy.
    """
    return F.coalesce(F.when(settled, F.lit(value)), rest)


def field(v: Column, path: str = "") -> Field:
    return Field(v, f".{path}" if path else "")


def is_present(f: Field) -> Column:
    """Present and not JSON null."""
    return f.variant.isNotNull() & ~F.is_variant_null(f.variant)


def truthy(f: Field) -> Column:
    """False for absent, null, '', 0, false, [] and {}; never NULL."""
    return (
        F.when(f.text.isNull() | (f.text == ""), F.lit(False))
        .when(f.text.isin(*_FALSY_TEXTS), f.kind == "STRING")
        .otherwise(F.lit(True))
    )


def truthy_blob(f: Field) -> Column:
    """As :func:`truthy`; does not serialise arrays that have a first entry."""
    return unless_settled(f.get("variant", "[0]").isNotNull(), True, truthy(f))


def truthy_text(f: Field) -> Column:
    """The string form when truthy, else NULL."""
    return F.when(truthy(f), f.text)


def first_present(*fields: Field) -> Column:
    """The first field that is present and not null, as VARIANT."""
    return F.coalesce(*[F.when(is_present(f), f.variant) for f in fields])


def is_object(f: Field) -> Column:
    return F.coalesce(F.startswith(f.kind, F.lit("OBJECT")), F.lit(False))


def truthy_block(f: Field) -> Column:
    """As :func:`truthy`, for a field that normally is an object."""
    return F.coalesce(F.when(is_object(f), f.kind != "OBJECT<>"), truthy(f))


def not_object(f: Field, usual: str) -> Column:
    """A truthy value where a nested object is expected (a producer error).

    Finding the ``usual`` entry proves an object without looking at the rest of it.
    """
    return unless_settled(
        (f / usual).text.isNotNull(), False, unless_settled(is_object(f), False, truthy(f))
    )


def not_array(f: Field) -> Column:
    """A truthy value where an array is expected."""
    return unless_settled(f.get("variant", "[0]").isNotNull(), False, truthy(f))


def or_default(f: Field, default_json: str) -> Column:
    """Default only when the field is absent; JSON null stays null."""
    return F.coalesce(f.variant, F.parse_json(F.lit(default_json)))


def or_falsy(f: Field, default_json: str) -> Column:
    """Default when the field is falsy."""
    return (
        F.when(f.get("variant", "[0]").isNotNull(), f.variant)
        .when(truthy(f), f.variant)
        .otherwise(F.parse_json(F.lit(default_json)))
    )


def is_string(f: Field) -> Column:
    return F.coalesce(f.kind == "STRING", F.lit(False))


def is_boolean(f: Field) -> Column:
    return F.coalesce(f.kind == "BOOLEAN", F.lit(False))


def is_number(f: Field) -> Column:
    return F.coalesce(f.kind.rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.lit(False))


def integer(f: Field) -> Column:
    """Whole number from a number (truncated), a boolean or integer text."""
    return (
        F.when(f.text.rlike(_INTEGER_TEXT), F.trim(_squeeze(f.text)).try_cast("bigint"))
        .when(~is_string(f), f.get("bigint"))
    )


def wide_integer(f: Field) -> Column:
    """As :func:`integer`, as DECIMAL(38,0) so out-of-range values stay visible."""
    digits = F.regexp_extract(f.text, r"^\s*([+-]?\d+)", 1).try_cast("decimal(38,0)")
    return (
        F.when(is_string(f), F.when(f.text.rlike(_INTEGER_TEXT), digits))
        .when(F.startswith(f.kind, F.lit("DECIMAL")), digits)
        .otherwise(f.get("bigint").cast("decimal(38,0)"))
    )


def _surely_integer(f: Field) -> Column:
    return f.text.isNull() | f.text.rlike(r"^[+-]?\d{1,18}$")


def bad_integer(f: Field) -> Column:
    """A truthy value that cannot become a whole number at all."""
    return unless_settled(_surely_integer(f), False, truthy(f) & wide_integer(f).isNull())


def integer_overflow(f: Field) -> Column:
    """A whole number that does not fit the BIGINT column."""
    overflow = wide_integer(f).isNotNull() & integer(f).isNull()
    return unless_settled(_surely_integer(f), False, overflow)


def floating(f: Field) -> Column:
    """Double from a number, boolean or numeric text; NULL otherwise."""
    from_text = F.when(f.text.rlike(_FLOAT_TEXT), _squeeze(f.text).try_cast("double"))
    return (
        F.when(is_string(f), from_text)
        .when(is_boolean(f), f.boolean.cast("double"))
        .otherwise(f.get("double"))
    )


def array_size(blob: Column) -> Column:
    """Number of elements of a VARIANT column; NULL when not an array."""
    return F.size(F.try_variant_get(blob, "$", "array<variant>"))


def _squeeze(value: Column) -> Column:
    return F.regexp_replace(value, r"^\s+|\s+$", "")
