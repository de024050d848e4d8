"""Numbers from dirty text, as (value, raw, warning), and small geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import stripped

#: Texts that stand for no number (fixed values).
NULL_MARKERS = ("-", "—", "–", "нет", "н/д", "н.д.", "none", "null")


def stands_for_none(c: Column) -> Column:
    """Null, blank, or one of the texts that say that there is no number."""
    return c.isNull() | F.lower(stripped(c)).isin("", *NULL_MARKERS)


def number_text(c: Column) -> Column:
    """A number as plain text, null for texts that stand for none. All but digits, separators and signs is cut; the last of "," and "." is the decimal
    sign if both occur; a lone comma is one before one or two digits, other commas part thousands."""
    text = F.regexp_replace(c, r"[^0-9,.+-]", "")
    both = F.contains(text, F.lit(",")) & F.contains(text, F.lit("."))
    comma_last = F.length(F.substring_index(text, ",", -1)) < F.length(F.substring_index(text, ".", -1))
    plain = (
        F.when(both & comma_last, F.translate(F.replace(text, F.lit("."), F.lit("")), ",", "."))
        .when(text.rlike(r"^[^,]*,[^,]{1,2}$") & ~both, F.translate(text, ",", "."))
        .otherwise(F.replace(text, F.lit(","), F.lit("")))
    )
    return F.when(~stands_for_none(c), plain)


def parse_decimal(c: Column) -> Column:
    """struct(value decimal(38,10), raw, warning): warning is "invalid_number" where the text is no number, words included; texts that stand for no number give a null value without one."""
    text = number_text(c)
    value = F.when(text.rlike(r"^[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?$"), text.try_cast("decimal(38,10)"))
    return F.struct(value.alias("value"), c.alias("raw"), F.when(text.isNotNull() & value.isNull(), "invalid_number").alias("warning"))


def parse_int(c: Column) -> Column:
    """struct(value long, raw, warning): "not_integral" where the number has a fraction."""
    number = parse_decimal(c)
    value, whole = number["value"], number["value"] == F.floor(number["value"])
    return F.struct(
        F.when(whole, value.try_cast("long")).alias("value"), c.alias("raw"), F.coalesce(number["warning"], F.when(value.isNotNull() & ~whole, "not_integral")).alias("warning")
    )


def wire(c: Column) -> Column:
    """A decimal in fixed notation without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(c.cast("decimal(38,10)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def first_number(c: Column) -> Column:
    """The first number in a text as a double (decimal comma or point), null if none."""
    found = F.regexp_extract(F.translate(c, "−", "-"), r"[-+]?\d+([.,]\d+)?", 0)
    return F.translate(found, ",", ".").try_cast("double")


def positive_int(c: Column) -> Column:
    """A text of digits, or of a number with an integral value, as a positive integer; else null."""
    value = F.when(stripped(c).rlike(r"^\d+(\.0+)?$"), stripped(c).try_cast("double").try_cast("int"))
    return F.when(value > 0, value)


def overlap(left: Column, right: Column, other_left: Column, other_right: Column) -> Column:
    """The length that two spans share; negative is the gap between them."""
    return F.least(right, other_right) - F.greatest(left, other_left)


def span_distance(x: Column, left: Column, right: Column) -> Column:
    """0 inside the span, else the distance to its nearer end."""
    return F.greatest(F.lit(0.0), left - x, x - right)


def clamp(left: Column, right: Column) -> Column:
    """struct(left, right) in order and within 0..1."""
    inside = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))
    return F.struct(inside(F.least(left, right)).alias("left"), inside(F.greatest(left, right)).alias("right"))


def strict_number(c: Column) -> Column:
    """The column as a double if its type is a number's; text is null, even if it reads like one."""
    return F.when(F.typeof(c).rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$"), c.try_cast("double"))
