"""Ordered work per key in which no key has to fit into one task.

A plain window over (key, time) brings all rows of a key into one task. Here the
window runs over (key, time bucket), and what crosses a bucket's border comes
from a table with one row per key and bucket. That table follows the length of
the history, not the number of rows, and is the only thing windowed per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwright.session import spread

_BUCKET = "timeline_bucket"


def running_totals(
    df: DataFrame,
    keys: list[str],
    bucket: Column,
    order: list[str],
    totals: dict[str, Column],
    fold=F.sum,
) -> DataFrame:
    """Add running sums, the current row included, ordered within each key.

    `fold` may also be `F.max` or `F.min`.
    """
    parts = {f"part_{name}": value for name, value in totals.items()}
    rows = df.withColumn(_BUCKET, bucket).withColumns(parts)
    spans = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(*keys, _BUCKET)
        .agg(*(fold(p).alias(p) for p in parts))
        .select(
            *keys,
            _BUCKET,
            *(fold(p).over(spans).alias(f"before_{p}") for p in parts),
        )
    )

    def combine(here: Column, before: str) -> Column:
        if fold is F.sum:
            return here + F.coalesce(before, F.lit(0))
        return F.greatest(here, before) if fold is F.max else F.least(here, before)

    local = (
        Window.partitionBy(*keys, _BUCKET)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        spread(rows, *keys, _BUCKET)
        .join(before, [*keys, _BUCKET])
        .withColumns(
            {name: combine(fold(f"part_{name}").over(local), f"before_part_{name}") for name in totals}
        )
        .drop(_BUCKET, *parts, *(f"before_{p}" for p in parts))
    )


def neighbour(
    df: DataFrame,
    keys: list[str],
    bucket: Column,
    order: list[str],
    columns: list[str],
    name: str,
    ahead: bool = False,
) -> DataFrame:
    """Add `name`, a struct of `columns` from the row before (or after) in the key."""
    rows = df.withColumn(_BUCKET, bucket)
    value = F.struct(*columns)
    local = Window.partitionBy(*keys, _BUCKET).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(_BUCKET)
    edge = F.min_by if ahead else F.max_by
    step = F.lead if ahead else F.lag
    edges = rows.groupBy(*keys, _BUCKET).agg(edge(value, F.struct(*order)).alias("edge"))
    carried = edges.select(*keys, _BUCKET, step("edge").over(across).alias("carried"))
    return (
        spread(rows, *keys, _BUCKET)
        .join(carried, [*keys, _BUCKET])
        .withColumn(name, F.coalesce(step(value).over(local), F.col("carried")))
        .drop(_BUCKET, "carried")
    )
