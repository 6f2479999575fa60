"""What the operators of this subpackage share: tables, held-out buckets, stored steps, Arrow loops."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.session import work_folder

#: Rows, and bytes of them, that a task works on at once: an Arrow batch is cut into such slices, a
#: row that is longer by itself is one of its own.
SLICE = 512
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column | str, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as the text ''."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The rows written to the shared folder and read again: lost executors lose nothing of them."""
    folder = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def sliced(batches: Iterator[pa.RecordBatch], size: int = SLICE, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [batch.slice(at, size) for at in reversed(range(0, batch.num_rows, size))]
        while parts:
            part = parts.pop()
            if part.num_rows > 1 and part.nbytes > most:
                half = part.num_rows // 2
                parts += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def per_slice(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
    schema: str,
    size: int = SLICE,
    most: int = SLICE_BYTES,
) -> DataFrame:
    """Apply to each slice of rows what make() returns; make runs once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for part in sliced(batches, size, most):
            out = step(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)
