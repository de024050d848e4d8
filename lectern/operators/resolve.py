"""Resolver chains: several ways to get one value, with status, method, confidence and warnings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

RESOLUTION = "struct<value:double,status:string,method:string,confidence:double,warnings:array<string>>"
#: What warnings say (fixed values).
NOT_NUMERIC, COMPONENTS_NOT_NUMERIC, FROM_CREDITS = "{} is not numeric", "hour components contain non-numeric values", "hours derived from credits"


def is_number(c: Column) -> Column:
    """The column's type is a number's; text is none, even if it reads like one."""
    return F.typeof(c).rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")


def resolution(value: Column | float | None, status: str, method: str, confidence: float, *warnings: str) -> Column:
    told = F.array(*[F.lit(w) for w in warnings]).cast("array<string>")
    value = value if isinstance(value, Column) else F.lit(value)
    return F.struct(value.cast("double").alias("value"), F.lit(status).alias("status"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"), told.alias("warnings"))


def direct(c: Column, numeric: Column | None = None, field: str = "total_hours") -> Column:
    """A published number as it is; `numeric` says whether what was read is a number, else the column's type does."""
    numeric = is_number(c) if numeric is None else numeric
    return (
        F.when(c.isNull() | (c.cast("string") == ""), resolution(None, "not_published", "direct", 0.0))
        .when(~numeric, resolution(None, "invalid", "direct", 0.0, NOT_NUMERIC.format(field)))
        .otherwise(resolution(c.try_cast("double"), "published", "direct", 1.0))
    )


def sum_components(components: Column) -> Column:
    """The sum of a map's values (doubles; null where a value is no number), invalid if any is none."""
    values = F.map_values(components)
    total = F.aggregate(values, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    return (
        F.when(F.coalesce(F.size(components), F.lit(0)) <= 0, resolution(None, "not_published", "sum_components", 0.0))
        .when(F.exists(values, lambda x: x.isNull()), resolution(None, "invalid", "sum_components", 0.0, COMPONENTS_NOT_NUMERIC))
        .otherwise(resolution(total, "derived", "sum_components", 1.0))
    )


def credits_to_hours(c: Column, hours: float = 36, numeric: Column | None = None) -> Column:
    """Hours from credits, with less confidence; text is invalid."""
    return (
        F.when(c.isNull() | (c.cast("string") == ""), resolution(None, "not_published", "credits_to_hours", 0.0))
        .when(~(is_number(c) if numeric is None else numeric), resolution(None, "invalid", "credits_to_hours", 0.0, NOT_NUMERIC.format("credits")))
        .otherwise(resolution(c.try_cast("double") * hours, "derived", "credits_to_hours", 0.7, FROM_CREDITS))
    )


def chain(*resolvers: Column) -> Column:
    """The first resolution that is published, derived or ambiguous, else the last one."""
    if not resolvers:
        return resolution(None, "not_published", "chain", 0.0)
    out = resolvers[-1]
    for r in reversed(resolvers[:-1]):
        out = F.when(r["status"].isin("published", "derived", "ambiguous"), r).otherwise(out)
    return out


BUILT_IN: dict[str, Callable[..., Column]] = {"direct": direct, "sum_components": sum_components, "credits_to_hours": credits_to_hours}


def build_chain(specs: list[tuple[str, tuple]], custom: dict[str, Callable[..., Column]] | None = None) -> Column:
    """A chain from (name, arguments) pairs; a custom resolver goes before a built-in one of its name."""
    known = BUILT_IN | (custom or {})
    unknown = [name for name, _ in specs if name not in known]
    if unknown:
        raise ValueError(f"unknown resolvers: {', '.join(unknown)}")
    return chain(*[known[name](*arguments) for name, arguments in specs])
