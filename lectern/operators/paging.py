"""Filtered, searched and paged reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROWS, ROWS = 500, 50


def equal_to(df: DataFrame, filters: dict[str, str | None], allowed: Sequence[str] | None = None) -> DataFrame:
    """Rows whose columns, as text (null as ""), equal the filters; empty filters are ignored, ones not allowed raise."""
    for name, value in filters.items():
        if allowed is not None and name not in allowed:
            raise ValueError(f"no filter {name}")
        if value:
            df = df.where(F.coalesce(F.col(name).cast("string"), F.lit("")) == F.lit(value))
    return df


def search(df: DataFrame, query: str | None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that hold `query` in any letter case: in the given columns, else in the row as JSON with its column names."""
    if not query:
        return df
    row = F.concat_ws(" ", *[F.col(c).cast("string") for c in columns]) if columns else F.to_json(F.struct("*"))
    return df.where(F.contains(F.lower(row), F.lower(F.lit(query))))


def page(df: DataFrame, order: Sequence, offset: int = 0, limit: int = ROWS, with_total: bool = True) -> DataFrame:
    """Rows offset .. offset + limit - 1 in `order`, with total and has_more. Spark keeps offset + limit rows a task, it doesn't sort all."""
    if offset < 0 or not 1 <= limit <= MOST_ROWS:
        raise ValueError(f"offset must be 0 or more, limit 1 to {MOST_ROWS}")
    rows = df.orderBy(*order).offset(offset).limit(limit)
    if not with_total:
        return rows
    total = df.agg(F.count("*").alias("total"))
    return rows.join(F.broadcast(total)).withColumn("has_more", F.col("total") > offset + limit)
