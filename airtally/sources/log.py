"""A log of entries in a folder, each won by creating its file if it is not there.

An entry is a file of its number that is never changed. Of several writers of one
number, one creates the file and the others learn that they came too late.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.sources.landing import is_missing


def entry_path(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/{number:020d}.json"


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text; False, and nothing changed, if there is one by that name.

    The text is written beside it under a hidden name first, so that a file seen
    is a whole one. Taking the name is one step that fails if it is taken: a
    link on a local file system, a rename without overwriting on any other.
    """
    hadoop = spark._jvm.org.apache.hadoop
    target = hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    draft = hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    create = _by_link if fs.getScheme() == "file" else _by_rename
    return create(spark, fs, draft, target, text.encode())


def _by_link(spark: SparkSession, fs, draft, target, content: bytes) -> bool:
    own, taken = (p.toUri().getPath() for p in (draft, target))
    with open(own, "wb") as out:
        out.write(content)
    try:
        os.link(own, taken)
    except FileExistsError:
        return False
    finally:
        os.unlink(own)
    return True


def _by_rename(spark: SparkSession, fs, draft, target, content: bytes) -> bool:
    stream = fs.create(draft, False)
    stream.write(bytearray(content))
    stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def entries(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """All entries, a row each; None if there is no log."""
    try:
        return spark.read.schema(schema).json(folder)
    except AnalysisException as missing:
        if is_missing(missing):
            return None
        raise


def last_number(spark: SparkSession, folder: str) -> int:
    """The number of the last entry, 0 if there is none; names are listed, nothing is read."""
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return max((int(name.removesuffix(".json")) for name in names if name[:1].isdigit() and name.endswith(".json")), default=0)


def read_entry(spark: SparkSession, folder: str, number: int) -> str:
    """The text of one entry."""
    return spark.read.text(entry_path(folder, number), wholetext=True).select(F.first("value")).first()[0]
