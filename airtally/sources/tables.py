"""SC2-SC4: normalised tables, dimensions and marts."""

from __future__ import annotations

import json
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from airtally.operators.games import NAMES, ByCode
from airtally.schemas import SILVER, partition_columns
from airtally.sources.landing import _with_folder_keys, in_folders, is_missing, table_folder
from airtally.sources.log import entries, last_number, read_entry


def read_normalized(
    spark: SparkSession, root: str, table: str, *, first: date | None = None, last: date | None = None
) -> DataFrame:
    """SC2: a normalised table, its folder keys as columns. Only the days asked for are read."""
    reader = spark.read.schema(_with_folder_keys(SILVER[table], table))
    return in_folders(reader.parquet(table_folder(root, "parquet", table)), first, last)


def stream_normalized(spark: SparkSession, root: str, table: str) -> DataFrame:
    """SC2 as a stream of the files not read yet."""
    folder = table_folder(root, "parquet", table)
    return spark.readStream.schema(_with_folder_keys(SILVER[table], table)).parquet(folder)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """SC3: a dimension kept as Parquet. Spark knows its size and broadcasts it only if it is small."""
    return spark.read.parquet(path)


def read_dimension_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    tasks: int = 8,
    **options: str,
) -> DataFrame:
    """SC3: a dimension in a relational database, read by several tasks if a column to split on is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split_column is not None:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", tasks)
        )
    return reader.load()


def read_mart(spark: SparkSession, folder: str) -> DataFrame:
    """SC4: the version of a mart that was published last, a row per name of its codes if it was published under codes."""
    rows = read_published(spark, folder)
    return rows.spelled() if isinstance(rows, ByCode) else rows


def read_published(spark: SparkSession, folder: str) -> DataFrame | ByCode:
    """SC4: the version that was published last, as it was published."""
    current = current_version(spark, folder)
    if current is None:
        raise FileNotFoundError(f"nothing has been published in {folder}")
    rows = spark.read.parquet(version_folder(folder, current[1]))
    try:
        return ByCode(rows, spark.read.schema(NAMES).parquet(names_folder(folder, current[1])))
    except AnalysisException as missing:
        if is_missing(missing):
            return rows
        raise


def log_folder(folder: str) -> str:
    return f"{folder.rstrip('/')}/published"


def published(spark: SparkSession, folder: str) -> DataFrame | None:
    """The mart's log: a small row per publication, its number and its folder's mark."""
    return entries(spark, log_folder(folder), "version long, mark string")


def current_version(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """Number and mark of the last publication."""
    number = last_number(spark, log_folder(folder))
    return (number, json.loads(read_entry(spark, log_folder(folder), number))["mark"]) if number else None


def version_folder(folder: str, mark: str) -> str:
    """Each publication has a folder of its own, so none is ever written where another is read."""
    return f"{folder.rstrip('/')}/versions/{mark}"


def names_folder(folder: str, mark: str) -> str:
    """Where a publication under codes has the names of its codes."""
    return f"{folder.rstrip('/')}/names/{mark}"
