"""Reading tables and queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def table_read(
    source: DataFrame,
    columns: Sequence[str] | None = None,
    where: str | Column | None = None,
    order_by: Sequence[str | Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Columns, filter, order and limit of a table; Catalyst pushes them down."""
    if where is not None:
        source = source.where(where)
    if order_by:
        source = source.orderBy(*order_by)
    if limit is not None:
        source = source.limit(limit)
    return source.select(*columns) if columns else source


def sql_read(
    spark: SparkSession,
    query: str,
    args: Mapping[str, object] | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """A SQL query with named parameters over the given DataFrames."""
    return spark.sql(query, args=dict(args or {}), **tables)
