"""Streaming: clips from a frame stream (survey rows R1, R2, R9) and running statistics."""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CLIP_SCHEMA = "ep long, clip long, j long, idx long, is_pad boolean, complete boolean"
CLIP_COLUMNS = [c.split()[0] for c in CLIP_SCHEMA.split(", ")]
#: Seconds for which a closed episode is remembered, if there are timers.
MEMORY = 86_400
STATE_SCHEMA = "next long, clip long, waiting string"


def stream_clips(frames: DataFrame, length: int, stride: int, interval: int, patience: int | None = None) -> DataFrame:
    """Clips as soon as their frames are there; frames: ep, idx, is_end.

    A closed episode gives one more row, with the number of its clips in `clip`, no j, and `complete`. An episode that
    gets no frame for `patience` seconds is closed as it is, not complete, so that a lost frame does not hold it and
    what waits for it in state for ever; a closed one is forgotten after MEMORY seconds. Without patience neither
    happens, as such timers need a stream that never ends. processors.cut_clips() gives the frames' columns as well, has a
    patience of its own accord and takes frames after the end for errors.

    A row with is_end closes its episode, its idx being the number of frames: frames left over then give one padded
    clip, and what comes later is ignored. Frames may arrive out of order; they wait in state until those before them
    are there, so a restart emits no clip twice. Repeated frames count once. State is a counter and the frames that
    arrived early, not the episode.
    """
    reach = (length - 1) * interval + 1
    step = min(stride, reach)

    def cut(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ready, clip, waiting = state.get if state.exists else (0, 0, "")
        if state.hasTimedOut:
            if ready < 0:
                state.remove()
            else:
                state.update((-1, clip, ""))
                state.setTimeoutDuration(1000 * MEMORY)
                yield pd.DataFrame([(key[0], clip, None, None, None, False)], columns=CLIP_COLUMNS)
            return
        if ready < 0:
            return
        early = {int(x) for x in waiting.split(",") if x and not x.startswith("e")}
        end = next((int(x[1:]) for x in waiting.split(",") if x.startswith("e")), None)
        for batch in batches:
            at, ends = batch["idx"].to_numpy(), batch["is_end"].to_numpy(dtype=bool)
            early.update(i for i in at[~ends].tolist() if i >= ready)
            if ends.any():
                end = int(at[ends].max())
        while ready in early:
            early.discard(ready)
            ready += 1
        begun = clip
        clip = full = max(clip, (ready - reach) // step + 1)
        closed = end is not None and ready >= end
        if closed and clip * step < end:
            clip += 1
        if closed:
            state.update((-1, clip, ""))
            if patience:
                state.setTimeoutDuration(1000 * MEMORY)
        else:
            state.update((ready, clip, ",".join([*map(str, sorted(early)), *([f"e{end}"] if end is not None else [])])))
            if patience:
                state.setTimeoutDuration(1000 * patience)
        if closed or clip > begun:
            yield _clip_rows(key[0], begun, full, clip, length, step, interval, end if closed else None)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if patience else GroupStateTimeout.NoTimeout
    return frames.groupBy("ep").applyInPandasWithState(cut, CLIP_SCHEMA, STATE_SCHEMA, "append", timeout)


def _clip_rows(ep: int, begun: int, full: int, clip: int, length: int, step: int, interval: int, end: int | None) -> pd.DataFrame:
    """The rows of the clips from `begun` up to `clip`, padded from `full` on, and that of the episode's end if it has one; columns are arrays, as most of an episode's time would go into tuples."""
    clips = np.repeat(np.arange(begun, clip, dtype=np.int64), length)
    j = np.tile(np.arange(length, dtype=np.int64), clip - begun)
    idx = clips * step + j * interval
    pad = np.zeros(len(j), dtype=bool) if end is None else (clips >= full) & (idx > end - 1)
    if end is not None:
        idx = np.where(pad, end - 1, idx)
        clips, j, idx, pad = np.append(clips, clip), np.append(j, 0), np.append(idx, 0), np.append(pad, False)
    last = np.zeros(len(j), dtype=bool)
    if end is not None:
        last[-1] = True
    number = pd.arrays.IntegerArray
    flag = pd.arrays.BooleanArray
    return pd.DataFrame({"ep": np.full(len(j), ep), "clip": clips, "j": number(j, last), "idx": number(idx, last.copy()), "is_pad": flag(pad, last.copy()), "complete": flag(last, ~last)})


def files_a_batch(stream_folder: str, spark: SparkSession, least: int = 4, batches: int = 4) -> int:
    """Files that a batch may have so that all of the folder's take about `batches` batches: each batch reads and writes all partitions of the state."""
    return max(least, -(-len(spark.read.parquet(stream_folder).inputFiles()) // batches))


def running_statistics(frames: DataFrame, value: str) -> DataFrame:
    """Mean, deviation and range by episode so far; run it in complete or update mode."""
    return frames.groupBy("ep").agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("low"), F.max(value).alias("high"))


def run_over_table(stream: DataFrame, folder: str, timers: bool = False) -> DataFrame:
    """What an append-mode stream gives for all that its source holds now, as a table below the folder.

    With timers a stream has another batch for ever; it is stopped after the first one without input.
    """
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append")
    if timers:
        query = writer.start()
        while query.isActive and not (query.lastProgress and query.lastProgress.numInputRows == 0):
            time.sleep(0.1)
        query.stop()
        if query.exception():
            raise query.exception()
    else:
        writer.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def continued_grid(rows: DataFrame, state: DataFrame, key: str, time: str, value: str, dt: float, eps: float = 1e-5) -> tuple[DataFrame, DataFrame]:
    """(steps, state): the next call's steps of a grid of dt seconds, from the step after the last one filled.

    state: key, next_step. A sample fills all steps up to its own that are still open; of samples for the same steps the
    first counts. The new state goes with the next call.
    """
    sampled = rows.join(state, key, "left").withColumn("next_step", F.coalesce("next_step", F.lit(0).cast("long"))).withColumn("k", F.floor(F.col(time) / dt + eps))
    firsts = sampled.where(F.col("k") >= F.col("next_step")).groupBy(key, "next_step", "k").agg(F.min_by(value, time).alias("value"))
    before = F.lag("k").over(Window.partitionBy(key).orderBy("k"))
    filled = firsts.withColumn("from", F.coalesce(before + 1, F.col("next_step")))
    steps = filled.select(key, F.explode(F.sequence("from", "k")).alias("step"), "value")
    new = filled.groupBy(key).agg((F.max("k") + 1).alias("_next"))
    return steps, state.join(new, key, "full").select(key, F.coalesce("_next", "next_step").alias("next_step"))


def merge_statistics(parts: DataFrame, *keys: str) -> DataFrame:
    """running statistics of parts (n, mean, std, low, high, deviations over n) as those of the whole."""
    n, mean = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    square = F.sum(F.col("n") * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean"))) / n
    return parts.groupBy(*keys).agg(n.alias("n"), mean.alias("mean"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("std"), F.min("low").alias("low"), F.max("high").alias("high"))
