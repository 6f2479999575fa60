"""SC1, SC5: landing documents, as a batch or only those not read yet."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from airtally.functions.times import within_days
from airtally.schemas import FEEDS, LANDING, MULTILINE, partition_columns


def table_folder(root: str, layer: str, table: str) -> str:
    """Where a table of a layer (`json` or `parquet`) lies under the root."""
    return f"{root.rstrip('/')}/source/{layer}/table_name={table}"


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def in_folders(rows: DataFrame, first: date | None, last: date | None, hour: int | None = None) -> DataFrame:
    """The days first..last of a table, or all of it.

    Any number of days is the same read of the table's root, and the days are a
    condition on the folders' keys, which prunes files by their folders' names.
    """
    if first is None:
        return rows
    rows = within_days(rows, first, last or first)
    return rows if hour is None else rows.where(rows["hour"] == hour)


def _with_folder_keys(schema: StructType, table: str) -> StructType:
    out = StructType(list(schema.fields))
    for key in partition_columns(table):
        out = out.add(key, IntegerType())
    return out


def read_documents(
    spark: SparkSession,
    root: str,
    table: str,
    *,
    first: date | None = None,
    last: date | None = None,
    hour: int | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """SC1: documents of a table with their folder keys; only the folders asked for are read.

    `multiline` says whether a file holds one document over several lines or a
    document per line; by default it is what the table's collector writes.
    """
    reader = spark.read.schema(_with_folder_keys(LANDING[table], table)).option(
        "multiLine", table in MULTILINE if multiline is None else multiline
    )
    return in_folders(reader.json(table_folder(root, "json", table)), first, last, hour)


def read_folders(
    spark: SparkSession, root: str, table: str, folders: list[Row], *, multiline: bool | None = None
) -> DataFrame:
    """SC1 for a list of folders, as rows of their keys; no other folder is listed or read."""
    base = table_folder(root, "json", table)
    reader = spark.read.schema(_with_folder_keys(LANDING[table], table)).option("basePath", base)
    paths = ["/".join([base, *(f"{k}={v}" for k, v in folder.asDict().items())]) for folder in folders]
    return reader.option("multiLine", table in MULTILINE if multiline is None else multiline).json(paths)


UNREAD = "_unread"


def unreadable_documents(
    spark: SparkSession,
    root: str,
    table: str,
    *,
    first: date | None = None,
    last: date | None = None,
    hour: int | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """SC1: the documents that `read_documents` takes for empty, as they can't be parsed: their folder keys, file and text."""
    schema = _with_folder_keys(LANDING[table], table)
    reader = (
        spark.read.schema(StructType(list(schema.fields)).add(UNREAD, "string"))
        .option("columnNameOfCorruptRecord", UNREAD)
        .option("multiLine", table in MULTILINE if multiline is None else multiline)
    )
    rows = in_folders(reader.json(table_folder(root, "json", table)), first, last, hour)
    # Nothing is parsed, so nothing found amiss, unless a field of the document is asked for as well.
    some_field = F.coalesce(F.to_json(F.struct(LANDING[table].fieldNames()[0])), F.lit(""))
    document = F.concat(UNREAD, F.substring(some_field, 1, 0)).alias("document")
    keys = [F.col(k) for k in partition_columns(table)]
    return rows.select(*keys, F.col("_metadata.file_path").alias("file"), document).where(F.col("document").isNotNull())


def stream_documents(
    spark: SparkSession,
    root: str,
    table: str,
    *,
    files_per_batch: int | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """SC5: a stream of documents; its checkpoint remembers which files have been read.

    No file is too old to be read: the source's own limit is a week.
    """
    reader = (
        spark.readStream.schema(_with_folder_keys(LANDING[table], table))
        .option("multiLine", table in MULTILINE if multiline is None else multiline)
        .option("maxFileAge", "36500d")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(table_folder(root, "json", table))


def read_feed(spark: SparkSession, path: str | None, feed: str) -> DataFrame:
    """One platform's feed; a feed that did not land is no rows."""
    schema = FEEDS[feed]
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)
