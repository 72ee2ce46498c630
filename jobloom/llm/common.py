"""Helpers shared by the operators: written intermediate tables, joins on hot keys and Arrow batches."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where that is unset a local session gets a temporary
    folder of its own and a cluster is refused, since its executors would not see each other's files."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="jobloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a thousand rows: long texts then fill neither a worker's memory nor the JVM's buffers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_dir(spark)}/jobloom-{uuid.uuid4().hex}/{name}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there, so a lost
    executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as there are cores, where a small scan has fewer."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def hot_rows(total: int) -> int:
    """Rows from which a key counts as hot: a 4096th of all, so there are at most 4096 hot keys, and not less than 10,000."""
    return max(10_000, total // 4096)


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], hot: Column) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row a key and is cheap to read. Its ``hot`` rows, few by
    construction, are broadcast; only rows of the other keys are shuffled, so no task gets a hot key."""
    often = table.where(hot)
    many = rows.join(F.broadcast(often), keys)
    few = rows.join(F.broadcast(often.select(*keys)), keys, "left_anti").join(table.where(~hot), keys)
    return many.unionByName(few)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_slices(offsets: np.ndarray, most: int = (1 << 18) - 1):
    """Row ranges whose texts hold about ``most`` bytes together (one longer text stands alone)."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end
