"""Text to value: comma-separated lines and numbers, with null or a default on failure."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartsight.schema import SESSION_FIELDS

# What counts as a number in the column profile and in defaulted parsing.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
FLOAT_TEXT = (
    r"(?i)^\s*[+-]?(([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)"
    r"(e[+-]?[0-9]+(_[0-9]+)*)?|inf|infinity|nan)\s*$"
)
_FRACTION = r"^([+-]?[0-9]+)\.[0-9]*$"


def line_parts(value: Column) -> Column:
    return F.split(value, ",")


def line_fields(parts: Column) -> dict[str, Column]:
    """The 18 texts of a split line by position; a field past the end is null."""
    return {name: F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(SESSION_FIELDS)}


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


def lenient_int(text: Column) -> Column:
    """Null on failure; a decimal fraction is cut off, not rejected."""
    return F.regexp_replace(F.trim(text), _FRACTION, "$1").try_cast("int")


def _plain(text: Column) -> Column:
    return F.replace(F.trim(text), F.lit("_"), F.lit(""))


def double_or_default(text: Column, default: float = 0.0) -> Column:
    parsed = F.when(text.rlike(FLOAT_TEXT), _plain(text).try_cast("double"))
    return F.coalesce(parsed, F.lit(float(default)))


def int_or_default(text: Column, default: int = 0) -> Column:
    parsed = F.when(text.rlike(INTEGER_TEXT), _plain(text).try_cast("bigint"))
    return F.coalesce(parsed, F.lit(default).cast("bigint"))
