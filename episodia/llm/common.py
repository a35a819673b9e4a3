"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a table may have to be sent to every executor; a larger one is joined by shuffle.
BROADCAST_ROWS = 50_000
#: Rows of two or three numbers that may be sent to every executor.
KEY_ROWS = 1_000_000
#: Keys with more than this share of all rows, of which there are few, are broadcast.
HEAVY_SHARE = 1 / 2000
_scratch: contextvars.ContextVar[tuple[str, ...]] = contextvars.ContextVar("scratch", default=())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which the cluster names in spark.checkpoint.dir.

    Where that is unset, a local master takes a temporary folder of its own; on a cluster, whose machines could not
    read each other's folders, it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage is cut, and lost executors lose nothing."""
    path = f"{[*_scratch.get(), shared_dir(df.sparkSession)][0]}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables that are materialized within go to a folder of their own, which is deleted at the end."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    token = _scratch.set((folder, *_scratch.get()))
    try:
        yield
    finally:
        _scratch.reset(token)
        delete(spark, folder)


@contextlib.contextmanager
def lasting() -> Iterator[None]:
    """Within scratch(): what is materialized here outlives it, as long as the scratch() around it if there is one."""
    token = _scratch.set(_scratch.get()[1:])
    try:
        yield
    finally:
        _scratch.reset(token)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], total: int) -> DataFrame:
    """rows left-joined with counted: keys, n (how many rows have the key), one or more further columns, the first of them never null.

    The keys with more than HEAVY_SHARE of total rows, 2000 at most, go to the rows by broadcast; the other rows move
    by key. No task gets more than a small part of the rows for its key.
    """
    heavy = F.col("n") > F.greatest(F.lit(64), F.lit(int(total * HEAVY_SHARE)))
    names = [c for c in counted.columns if c not in (*keys, "n")]
    first = rows.join(F.broadcast(counted.where(heavy).drop("n")), keys, "left")
    rest = first.where(F.col(names[0]).isNull()).drop(*names).join(counted.where(~heavy).drop("n"), keys, "left")
    return first.where(F.col(names[0]).isNotNull()).unionByName(rest)


def trimmed(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for mapInPandas or mapInArrow that hands the memory it has freed back to the machine when it ends.

    Python workers live on from stage to stage, and what their allocators keep would add up.
    """

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library's
            if trim:
                trim(0)

    return run


def small(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has no more rows than BROADCAST_ROWS, else as it is (AQE then splits skewed joins)."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def narrow(df: DataFrame, rows: int) -> DataFrame:
    """As small(), for rows of two or three numbers."""
    return F.broadcast(df) if rows <= KEY_ROWS else df


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hash_below(c: Column, share: float) -> Column:
    """Whether c's hash falls into the first `share` of the hash range: a repeatable sample, exact at any share."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(c).bitwiseAND(F.lit((1 << 63) - 1)) < F.lit(int(share * (1 << 63)))
