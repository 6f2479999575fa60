"""SK1-SK7: writing tables so that a rerun gives the same table."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.functions.times import landing_parts
from airtally.operators.games import ByCode
from airtally.sources.landing import is_missing
from airtally.sources.log import entry_path, last_number, put_if_absent
from airtally.sources.tables import log_folder, names_folder, published, version_folder


def spread_by(df: DataFrame, column: str, tasks_per_value: int) -> DataFrame:
    """SK2: rows of one value together, over several tasks.

    With two platforms, a repartition by platform alone keeps two tasks busy.
    The salt comes from the row, so a task that is run again makes the same split.
    """
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(tasks_per_value))
    return df.repartition(column, salt)


def overwrite_partitions(
    df: DataFrame,
    folder: str,
    keys: list[str],
    *,
    sort_within: list[str] | None = None,
    rows_per_file: int | None = None,
    owned: DataFrame | None = None,
) -> None:
    """SK1, SK5: write the partitions that `df` has rows for, in place of what they held.

    `owned` names the partitions that a run answers for, as rows of `keys`: those
    it has no rows for are emptied, so that nothing of an earlier run stays.

    Rows are brought together by partition before they are written, so there is
    no file per task and partition. Files get their size from adaptive
    execution's advisory size and `rows_per_file` (SK3); a single file would
    take the whole job through one task.
    """
    # Unlike a repartition, a rebalance lets adaptive execution split a hot partition.
    laid_out = df.hint("rebalance", *[F.col(k) for k in keys])
    if sort_within:
        laid_out = laid_out.sortWithinPartitions(*keys, *sort_within)
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file or 0)
        .partitionBy(*keys)
        .parquet(folder)
    )
    if owned is not None:
        # A row per partition of one run; few, however large the table.
        empty = owned.select(*keys).distinct().join(df.select(*keys).distinct(), keys, "left_anti").collect()
        for row in empty:
            path = "/".join([folder.rstrip("/"), *(f"{k}={row[k]}" for k in keys)])
            if _holds_files(df.sparkSession, path):
                df.drop(*keys).limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _holds_files(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.format("binaryFile").load(path).inputFiles())
    except AnalysisException as missing:
        if is_missing(missing):
            return False
        raise


def append_increment(df: DataFrame, folder: str, load_key: str, load: Column) -> None:
    """SK5: append one load under its key. The same load run again takes the place of itself, also if it has no rows now."""
    owned = df.sparkSession.range(1).select(load.alias(load_key))
    overwrite_partitions(df.withColumn(load_key, load), folder, [load_key], owned=owned)


def publish(df: DataFrame | ByCode, folder: str, *, sort_within: list[str] | None = None, partition_by: tuple[str, ...] = ()) -> int:
    """SK4: replace a mart as a whole; returns the version's number.

    The rows go to a folder of their own; a log entry then makes it current. A
    failure before that leaves the old version in place, and readers go on
    with the version they opened. Entries are numbered, and a number is
    taken by creating its file if it is absent: of two publishers at once, the
    later one takes the next number, so both are in the log, in order. Old
    versions stay until `expire` removes them. Rows under game codes are published as
    they are, with the names of their codes beside them.
    """
    mark = uuid.uuid4().hex[:12]
    if isinstance(df, ByCode):
        df.names.write.mode("errorifexists").parquet(names_folder(folder, mark))
        df = df.rows
    spark = df.sparkSession
    rows = df.hint("rebalance", *[F.col(k) for k in partition_by]) if partition_by else df
    if sort_within:
        rows = rows.sortWithinPartitions(*partition_by, *sort_within)
    rows.write.mode("errorifexists").partitionBy(*partition_by).parquet(version_folder(folder, mark))
    version = last_number(spark, log_folder(folder)) + 1
    while not put_if_absent(spark, entry_path(log_folder(folder), version), json.dumps({"version": version, "mark": mark})):
        version += 1
    return version


def expire(spark: SparkSession, folder: str, keep: int) -> list[str]:
    """SK4: empty the folders of all but the last `keep` published versions; readers of older ones must have ended."""
    log = published(spark, folder)
    rows = log.orderBy(F.desc("version")).collect() if log is not None else []
    marks = [r["mark"] for r in rows[max(1, keep) :]]
    old = [version_folder(folder, mark) for mark in marks]
    for path in [*old, *(names_folder(folder, mark) for mark in marks)]:
        if _holds_files(spark, path):
            none = spark.read.parquet(path).limit(0)
            spark.createDataFrame([], none.schema).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return old


def register(spark: SparkSession, name: str, folder: str) -> None:
    """SK6: make a folder of partitions a table; run again to add new partitions."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=folder, source="parquet")
    else:
        spark.sql(f"REFRESH TABLE {name}")
    spark.sql(f"MSCK REPAIR TABLE {name}")


def land(df: DataFrame, folder: str, ts: str, *, poll: str | None = None, hourly: bool = True) -> None:
    """SK7: write documents under year, month, day[, hour] of their time on the collectors' clock.

    `poll` names a run of a collector: its documents lie in folders of that
    name below these, and the same run again takes the place of itself. All of a
    table's documents are landed with it or all without.
    """
    keys = ["year", "month", "day", "hour"] if hourly else ["year", "month", "day"]
    rows = landing_parts(df, ts, hourly).drop(ts)
    if poll is not None:
        rows, keys = rows.withColumn("poll", F.lit(poll)), [*keys, "poll"]
    (
        rows.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("append" if poll is None else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .json(folder)
    )
