"""Previous rows and top rows within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_value(
    df: DataFrame, by: list[str], order: list[str], value: str, name: str, chunk: Column
) -> DataFrame:
    """`value` of the row before, within `by` in the order of `order`, as column `name`.

    The same as a plain lag, but a group is sorted chunk by chunk: `chunk` must
    not decrease along `order`. Only the first row of each chunk looks beyond
    it, at the last value of the chunk before; those rows are few, so no task
    holds more of a hot group than one chunk.
    """
    local = Window.partitionBy(*by, "_chunk").orderBy(*order)
    whole = local.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        df.withColumn("_chunk", chunk)
        .withColumn("_first", F.lag(F.lit(True)).over(local).isNull())
        .withColumn(name, F.lag(value).over(local))
        .withColumn("_tail", F.last(value).over(whole))
    )
    across = Window.partitionBy(*by).orderBy("_chunk")
    firsts = rows.where("_first").withColumn(name, F.lag("_tail").over(across))
    return rows.where("not _first").unionByName(firsts).drop("_chunk", "_first", "_tail")


def running_sum(
    df: DataFrame, by: list[str], order: list[str], value: str, name: str, chunk: Column
) -> DataFrame:
    """The sum of `value` up to and with each row, within `by` in the order of `order`, as column `name`.

    The same as a plain running sum, but a group is sorted chunk by chunk:
    `chunk` must not decrease along `order`. What the chunks before add up to
    is computed from one row per chunk.
    """
    rows = df.withColumn("_chunk", chunk)
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*by, "_chunk")
        .agg(F.sum(value).alias("_total"))
        .withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    local = (
        Window.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn(name, F.sum(value).over(local))
        .join(offsets, [*by, "_chunk"])
        .withColumn(name, F.col(name) + F.col("_offset"))
        .drop("_chunk", "_offset")
    )


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    """The first `n` rows of each group, numbered. Each task cuts its rows to `n` before the shuffle."""
    numbered = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(rank, numbered).where(F.col(rank) <= n)


def latest_per_key(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group."""
    return top_per_group(df, by, order, 1, "_rank").drop("_rank")
