"""Reading and writing episodes (survey rows S1-S23)."""

from __future__ import annotations

import io
import tarfile
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.common import hash_order, hash_uniform
from ..functions.text import episode_number
from ..operators.ranks import row_ranks
from ..operators.windows import forward_chunk


def csv_names(value: str | None) -> list[str] | None:
    """Names from a comma-separated argument; empty, `all` and `none` mean no filter."""
    names = [x.strip() for x in (value or "").split(",") if x.strip()]
    return None if not names or [x.lower() for x in names] in (["all"], ["none"]) else names


def discover(paths: DataFrame, tasks: Sequence[str] | None = None, max_per_task: int = 0) -> DataFrame:
    """(task, episode, path) of files <task>/.../<stem>.<ext>, the first max_per_task of each task by (number, path); 0 means all."""
    task = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    rows = paths.select("path", task.alias("task"), episode_number(F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)).alias("episode"))
    rows = rows.where(F.col("task").isin(list(tasks))) if tasks else rows
    if max_per_task > 0:
        rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("task").orderBy("episode", "path"))).where(F.col("nth") <= max_per_task).drop("nth")
    return rows


def contiguous(frames: DataFrame) -> DataFrame:
    """(ep, contiguous): whether an episode's frames are exactly 0 .. n-1; repeated frames count once."""
    ends = frames.groupBy("ep").agg(F.min("idx").alias("low"), F.max("idx").alias("high"), F.countDistinct("idx").alias("n"))
    return ends.select("ep", ((F.col("low") == 0) & (F.col("high") + 1 == F.col("n"))).alias("contiguous"))


def write_episodes(frames: DataFrame, path: str, *partitions: str) -> None:
    """Parquet with zstd, by task and config or the like."""
    frames.write.option("compression", "zstd").partitionBy(*partitions).mode("overwrite").parquet(path)


def json_lines(spark: SparkSession, path: str, keys: Sequence[str], schema: str) -> DataFrame:
    """Rows of a JSON-lines log that hold any of the keys; incomplete lines are left out."""
    return parse_lines(spark.read.text(path), "value", [f'"{k}"' for k in keys], schema).select("row.*")


def parse_lines(lines: DataFrame, column: str, wanted: Sequence[str], schema: str) -> DataFrame:
    """Lines that hold one of the texts and end with a brace, plus the parsed `row`."""
    any_of = F.lit(False)
    for text in wanted:
        any_of = any_of | F.col(column).contains(text)
    return lines.where(any_of & F.col(column).endswith("}")).withColumn("row", F.from_json(column, schema))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which a cluster's machines share; a local master may do without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def read_split(episodes: DataFrame, key: str, split: str, share: float = 0.95) -> DataFrame:
    """The train, val or all rows, an episode as a whole, by a hash of its key; in a shuffled, repeatable order of files it is the reader's to sort by `shuffle`."""
    train = hash_uniform(F.col(key)) < share
    rows = episodes.withColumn("shuffle", hash_order(F.col(key), 1))
    if split not in ("train", "val", "all"):
        raise ValueError(f"no split {split}")
    return rows if split == "all" else rows.where(train if split == "train" else ~train)


def build_table(paths: DataFrame, parse: Callable[[str], Iterator[dict]], schema: str, rows: int = 10_000) -> DataFrame:
    """The rows that parse() reads from each path, one file at a time, as many files at once as there are tasks.

    Paths are dealt to all tasks; a task passes its rows on in frames of up to `rows`, from one file or many.
    """
    names = [f.split()[0] for f in schema.split(",")]

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict] = []
        for frame in frames:
            for path in frame["path"]:
                for row in parse(path):
                    held.append(row)
                    if len(held) == rows:
                        yield pd.DataFrame(held, columns=names)
                        held = []
        if held:
            yield pd.DataFrame(held, columns=names)

    tasks = 4 * paths.sparkSession.sparkContext.defaultParallelism
    return paths.select("path").repartition(tasks).mapInPandas(build, schema)


def frame_tables(frames: DataFrame, tasks: DataFrame, fps: int = 50) -> dict[str, DataFrame]:
    """Frames, episodes and tasks as tables. frames: ep, idx, further columns; tasks: ep, texts.

    A frame has its time at `fps`; an episode its length and one of its instructions, drawn by a hash of its number; a
    task is a different instruction with its number in code-point order.
    """
    timed = frames.withColumn("timestamp", F.col("idx") / float(fps))
    drawn = F.get("texts", (hash_order(F.col("ep")) % F.size("texts")).cast("int"))
    episodes = frames.groupBy("ep").agg(F.count(F.lit(1)).alias("length")).join(tasks, "ep", "left").withColumn("task", drawn).drop("texts")
    names = episodes.select("task").distinct().where("task is not null")
    numbered = row_ranks(names, ["task"]).select("task", (F.col("rank") - 1).cast("int").alias("task_index"))
    return {"frames": timed, "episodes": episodes, "tasks": numbered}


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table as Parquet below the folder."""
    for name, df in tables.items():
        df.write.option("compression", "zstd").mode("overwrite").parquet(f"{folder}/{name}")


def delta_windows(frames: DataFrame, value: str, horizon: int, fps: int) -> DataFrame:
    """For every frame the values at the times t / fps ahead, t below horizon, the episode's last one repeated, and those times."""
    times = F.array(*[F.lit(t / fps) for t in range(horizon)])
    return forward_chunk(frames, value, horizon).withColumn("delta_timestamps", times)


def manifest_lines(summary: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return summary.select(F.to_json(F.struct("*")).alias("line"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines."""
    df.write.mode("overwrite").json(path)


def numeric_lines(rows: DataFrame) -> DataFrame:
    """A JSON text of each row's numeric columns."""
    names = [f.name for f in rows.schema if isinstance(f.dataType, NumericType)]
    return rows.select(F.to_json(F.struct(*names)).alias("line"))


def complete_lines(lines: DataFrame) -> DataFrame:
    """The lines that are whole JSON objects; a tail that a crash cut short is left out."""
    return lines.where(F.try_parse_json("line").isNotNull() & F.col("line").startswith("{") & F.rtrim("line").endswith("}"))


def tar_shards(samples: DataFrame, split: str, max_bytes: int) -> DataFrame:
    """(name, content) of tar shards of up to max_bytes of samples (key, payload).

    Samples are hashed into as many groups as their bytes need, so that each task holds one shard; a group that grew
    beyond max_bytes is written as several. A shard is one binary value, so max_bytes may be 512 MB at most.
    """
    if max_bytes > 512_000_000:
        raise ValueError("a shard of more than 512 MB does not fit into one value")
    total = samples.agg(F.sum(F.length("payload"))).first()[0] or 0
    groups = max(1, -(-total // max(1, max_bytes)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        out, group = [], int(frame["group"].iloc[0])
        buffer, size, part = io.BytesIO(), 0, 0
        tar = tarfile.open(fileobj=buffer, mode="w")
        for key, payload in sorted(zip(frame["key"], frame["payload"], strict=True)):
            if size and size + len(payload) > max_bytes:
                tar.close()
                out.append((f"{split}-rank00-{group:06d}-{part:03d}.tar", buffer.getvalue()))
                buffer, size, part = io.BytesIO(), 0, part + 1
                tar = tarfile.open(fileobj=buffer, mode="w")
            info = tarfile.TarInfo(key)
            info.size = len(payload)
            tar.addfile(info, io.BytesIO(payload))
            size += len(payload)
        tar.close()
        out.append((f"{split}-rank00-{group:06d}-{part:03d}.tar", buffer.getvalue()))
        return pd.DataFrame(out, columns=["name", "content"])

    return samples.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups))).groupBy("group").applyInPandas(pack, "name string, content binary")

