"""Intermediate tables that several plans read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .episodes import scratch_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once into the shared folder and read from there: what is built on it does not compute it again."""
    return stored_at(df, new_folder(df.sparkSession, name))


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return scratch_folder(spark, name)


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """As stored(), at a path, so that delete() can clear it when it is no longer read."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
