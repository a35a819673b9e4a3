"""Clips, padded sequences and aligned steps of episodes (survey rows W1-W28).

Frames are rows with an episode `ep` and a number `idx` from 0 without gaps. Operators that pair frames with
positions do it by an equi join on (ep, idx), so one long episode is no single task; the others, and the numbering
itself, sort an episode in one task, which spills but does not split. Every window has a frame that Spark carries on
from row to row, so that the cost is linear in an episode's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .ranks import running_sum


def number_frames(df: DataFrame, episode: str, *order: str) -> DataFrame:
    """df plus ep and idx, the row's number from 0 within its episode."""
    return df.withColumn("ep", F.col(episode)).withColumn("idx", (F.row_number().over(Window.partitionBy(episode).orderBy(*order)) - 1).cast("long"))


def in_order() -> Window:
    return Window.partitionBy("ep").orderBy("idx")


def lengths(frames: DataFrame) -> DataFrame:
    return frames.groupBy("ep").agg(F.count(F.lit(1)).alias("n"))


def _clip_count(length: int, stride: int, interval: int) -> tuple[int, Column]:
    """The frames from a clip to the next, and the number of clips of an episode of n frames."""
    reach = (length - 1) * interval + 1
    step = min(stride, reach)
    full = F.when(F.col("n") < reach, 0).otherwise(F.floor((F.col("n") - reach) / step) + 1)
    return step, (full + F.when(full * step < F.col("n"), 1).otherwise(0)).cast("long")


def clip_positions(frames: DataFrame, length: int, stride: int, interval: int) -> DataFrame:
    """(ep, clip, j, idx, is_pad). Clips of `length` frames, `interval` apart, every `stride` frames; a last,
    padded clip if frames remain. A stride beyond a clip's reach counts as the reach."""
    step, clips = _clip_count(length, stride, interval)
    at = F.col("clip") * step + F.col("j") * interval
    return (
        lengths(frames)
        .withColumn("clip", F.explode(F.sequence(F.lit(0).cast("long"), clips - 1)))
        .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(length - 1).cast("long"))))
        .select("ep", "clip", "j", F.least(at, F.col("n") - 1).alias("idx"), (at > F.col("n") - 1).alias("is_pad"))
    )


def clips(frames: DataFrame, length: int, stride: int, interval: int) -> DataFrame:
    """W1 with the frames' columns. A frame that knows its episode's length lists its places, so that places don't move:
    those at its own number, and the last frame also those beyond it."""
    step, count = _clip_count(length, stride, interval)
    sizes = lengths(frames).select("ep", (F.col("n") - 1).alias("_last"), count.alias("_clips"))
    ahead = F.col("idx") - F.col("j") * interval
    from_here = F.greatest(F.ceil(ahead / step), F.lit(0).cast("long"))
    beyond = F.when(from_here < F.col("_clips"), F.sequence(from_here, F.col("_clips") - 1))
    own = F.when((ahead >= 0) & (ahead % step == 0) & (from_here < F.col("_clips")), F.array(from_here))
    return (
        frames.join(sizes, "ep")
        .where(F.col("idx") <= F.col("_last"))
        .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(length - 1).cast("long"))))
        .withColumn("clip", F.explode(F.when(F.col("idx") == F.col("_last"), beyond).otherwise(own)))
        .select("ep", "idx", "clip", "j", (F.col("clip") * step + F.col("j") * interval > F.col("_last")).alias("is_pad"), *[c for c in frames.columns if c not in ("ep", "idx")])
    )


def clip_summary(clipped: DataFrame, value: str) -> DataFrame:
    """Per clip its source frames, first and last frame, padding and range of `value`."""
    return clipped.groupBy("ep", "clip").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("j", "idx"))), lambda s: s.idx.cast("string")), ",").alias("frames"),
        F.min("idx").alias("start_frame"),
        F.max("idx").alias("end_frame"),
        F.count_if("is_pad").alias("pads"),
        F.max(value).alias("top"),
    )


def sequence_positions(frames: DataFrame, horizon: int, pad_before: int, pad_after: int) -> DataFrame:
    """(ep, start, j, idx) of all sequences of `horizon` steps that overhang an episode by at most the paddings."""
    before, after = min(max(pad_before, 0), horizon - 1), min(max(pad_after, 0), horizon - 1)
    last = F.col("n") - horizon + after
    return (
        lengths(frames)
        .where(last >= -before)
        .withColumn("start", F.explode(F.sequence(F.lit(-before).cast("long"), last.cast("long"))))
        .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(horizon - 1).cast("long"))))
        .select("ep", "start", "j", F.greatest(F.least(F.col("start") + F.col("j"), F.col("n") - 1), F.lit(0)).alias("idx"))
    )


def forward_chunk(frames: DataFrame, value: str, size: int) -> DataFrame:
    """The value of this and the next size-1 frames, the episode's last one repeated."""
    return frames.withColumn("chunk", F.array(F.col(value), *_ahead(value, size - 1)))


def _ahead(value: str, size: int) -> list[Column]:
    """The value of the next `size` frames, the episode's last one repeated beyond its end."""
    w = in_order()
    last = F.last(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    left = F.count(F.lit(1)).over(Window.partitionBy("ep")) - 1 - F.col("idx")
    return [F.when(left >= k, F.lead(value, k).over(w)).otherwise(last) for k in range(1, size + 1)]


def past_window(frames: DataFrame, value: str, size: int) -> DataFrame:
    """The value of the last size-1 frames and this one, the first repeated; mask says which are real."""
    w = in_order()
    first = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    back = [F.when(F.col("idx") >= k, F.lag(value, k).over(w)).otherwise(first) if k else F.col(value) for k in range(size - 1, -1, -1)]
    return frames.withColumn("past", F.array(*back)).withColumn("mask", F.array(*[F.col("idx") >= k for k in range(size - 1, -1, -1)]))


def future_window(frames: DataFrame, value: str, size: int) -> DataFrame:
    """The value of the next `size` frames from idx+1, the last repeated; mask says which are real."""
    n = F.count(F.lit(1)).over(Window.partitionBy("ep"))
    return frames.withColumn("future", F.array(*_ahead(value, size))).withColumn("mask", F.array(*[F.col("idx") + k < n for k in range(1, size + 1)]))


def gather_sequences(frames: DataFrame, value: str, horizon: int, pad_before: int, pad_after: int) -> DataFrame:
    """(ep, start, values) of the sequences of W3, the episode's ends repeated; reads `horizon` rows ahead and joins nothing."""
    before, after = min(max(pad_before, 0), horizon - 1), min(max(pad_after, 0), horizon - 1)
    n = F.count(F.lit(1)).over(Window.partitionBy("ep"))
    chunks = forward_chunk(frames, value, horizon).withColumn("n", n).select("ep", "idx", "n", "chunk")
    starts = F.when(F.col("idx") == 0, F.sequence(F.lit(-before).cast("long"), F.lit(0).cast("long"))).otherwise(F.array("idx"))
    values = F.slice(F.concat(F.array_repeat(F.col("chunk")[0], -F.least(F.col("start"), F.lit(0)).cast("int")), "chunk"), 1, horizon)
    return chunks.withColumn("start", F.explode(starts)).where(F.col("start") <= F.col("n") - horizon + after).select("ep", "start", values.alias("values"))


def keep_first(sequences: DataFrame, values: str, first: int) -> DataFrame:
    """Of a key of which only the first steps are read, the others are null."""
    return sequences.withColumn(values, F.transform(values, lambda x, i: F.when(i < first, x)))


def flat_windows(frames: DataFrame, value: str, past: int, future: int) -> DataFrame:
    """One row per frame: `past` frames up to this one and `future` frames after it, with time masks."""
    return future_window(past_window(frames, value, past).withColumnRenamed("mask", "past_mask"), value, future).withColumnRenamed("mask", "future_mask")


def moving_start(frames: DataFrame, value: str, limit: float) -> DataFrame:
    """Plus first_idx, the first frame more than `limit` from frame 0; null in an episode that never is."""
    base = F.first(value).over(in_order())
    moved = F.abs(F.col(value) - F.col("base")) > limit
    return frames.withColumn("base", base).withColumn("first_idx", F.min(F.when(moved, F.col("idx"))).over(Window.partitionBy("ep"))).drop("base")


def skip_still_start(frames: DataFrame, value: str, limit: float) -> DataFrame:
    """Frames from the one before the first that moved; episodes without one go."""
    return moving_start(frames, value, limit).where(F.col("idx") >= F.col("first_idx") - 1).drop("first_idx")


def chunk_with_history(frames: DataFrame, value: str, chunk: int, history: int, limit: float) -> DataFrame:
    """For the frames from the one before the first that moved on: the next `chunk` values from this frame, the last
    repeated, and the last `history` ones, the first repeated, with a mask that is true from the frame before the first
    that moved."""
    both = past_window(forward_chunk(moving_start(frames, value, limit), value, chunk), value, history)
    real = F.least(F.col("idx") - F.col("first_idx") + 2, F.lit(history))
    mask = F.array(*[F.lit(history - 1 - k) < real for k in range(history)])
    return both.withColumn("mask", mask).where(F.col("idx") >= F.col("first_idx") - 1).drop("first_idx")


def _with_nulls(value: str, w: WindowSpec) -> Column:
    """The values of a window in order; collect_list alone would leave out nulls."""
    return F.transform(F.collect_list(F.struct(F.col(value).alias("v"))).over(w), lambda s: s.v)


def zero_padded_suffix(frames: DataFrame, value: str, size: int) -> DataFrame:
    """For every frame the values from the frame before it (from 0 for frame 0) to the end, cut at `size` or filled
    up with zeros, and is_pad. A null value keeps its place."""
    rest = _with_nulls(value, in_order().rowsBetween(-1, size - 1))
    suffix = F.slice("rest", 1, size)
    padded = F.concat(suffix, F.array_repeat(F.lit(0.0), F.lit(size) - F.size(suffix)))
    return frames.withColumn("rest", rest).withColumn("actions", padded).withColumn("is_pad", F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: i > F.size(suffix))).drop("rest")


def stack_last(frames: DataFrame, value: str, size: int) -> DataFrame:
    """The last `size` observations, a short history filled up at the front with its first."""
    return past_window(frames, value, size).drop("mask").withColumnRenamed("past", "stack")


def temporal_ensemble(chunks: DataFrame, rate: float = 0.01) -> DataFrame:
    """(ep, t, action): at every step the mean of what all chunks predict for it, the oldest heaviest.

    chunks: ep, q, actions; a chunk's element i is its prediction for step q + i. The i-th oldest prediction weighs
    exp(-rate * i), over the sum of the weights.
    """
    predicted = chunks.select("ep", "q", F.posexplode("actions").alias("i", "a")).withColumn("t", F.col("q") + F.col("i"))
    age = F.row_number().over(Window.partitionBy("ep", "t").orderBy("q")) - 1
    weight = F.exp(-rate * F.col("age"))
    return predicted.withColumn("age", age).groupBy("ep", "t").agg((F.sum(weight * F.col("a")) / F.sum(weight)).alias("action"))


def replay_chunks(chunks: DataFrame, steps: DataFrame, every: int) -> DataFrame:
    """(ep, t, action): steps (ep, t) take element t % every of the chunk asked for at step t - t % every."""
    asked = steps.withColumn("q", F.col("t") - F.col("t") % every)
    return asked.join(chunks, ["ep", "q"]).select("ep", "t", F.get("actions", (F.col("t") % every).cast("int")).alias("action"))


def save_steps(frames: DataFrame, every: int) -> DataFrame:
    """Every `every`-th frame and the last of the episode."""
    n = F.count(F.lit(1)).over(Window.partitionBy("ep"))
    return frames.withColumn("n", n).where((F.col("idx") % every == 0) | (F.col("idx") == F.col("n") - 1)).drop("n")


def held_streams(streams: DataFrame, dims: int) -> DataFrame:
    """Streams (ep, stream, idx, v) side by side as s0, s1, ...; one that ends before the episode's longest holds its last value."""
    by = streams.groupBy("ep", "idx").pivot("stream", list(range(dims))).agg(F.first("v"))
    return by.select("ep", "idx", *[F.last(F.col(f"`{k}`"), ignorenulls=True).over(in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"s{k}") for k in range(dims)])


def slice_episodes(frames: DataFrame, begin: int, end: int) -> DataFrame:
    """Frames begin .. end-1 of each episode, numbered from 0 again."""
    return frames.where((F.col("idx") >= begin) & (F.col("idx") < end)).withColumn("idx", F.col("idx") - begin)


def drop_last_episode(frames: DataFrame) -> DataFrame:
    """All episodes but the one of the largest `ep`."""
    return frames.join(F.broadcast(frames.agg(F.max("ep").alias("last"))), F.col("ep") < F.col("last"), "left_semi")


def previous_action(frames: DataFrame, value: str) -> DataFrame:
    """The action before as state, zero at first."""
    return frames.withColumn("state", F.lag(value, 1, 0.0).over(in_order())).withColumn("action", F.col(value))


def sliding_mean(frames: DataFrame, value: str, size: int) -> DataFrame:
    """The mean of the last `size` values."""
    return frames.withColumn("mean", F.avg(value).over(in_order().rowsBetween(1 - size, 0)))


def _before_last(frames: DataFrame) -> DataFrame:
    """All but each episode's last frame."""
    return frames.withColumn("_next", F.lead("idx").over(in_order())).where("_next is not null").drop("_next")


def state_action(frames: DataFrame, value: str) -> DataFrame:
    """State of a frame, action = the next frame's state; the last frame goes, one with a null value stays."""
    return _before_last(frames.withColumn("action", F.lead(value).over(in_order()))).withColumnRenamed(value, "state")


def relative_action(frames: DataFrame, value: str) -> DataFrame:
    """The step to the next frame; the last frame copies the step before it."""
    w = in_order()
    return frames.withColumn("delta", F.coalesce(F.lead(value).over(w) - F.col(value), F.col(value) - F.lag(value).over(w)))


def binarize_gripper(frames: DataFrame, value: str, opened: float = 0.95, closed: float = 0.05) -> DataFrame:
    """1 above `opened`, 0 below `closed`, between them as the next decided frame; after the last one, the raw last value."""
    decided = F.when(F.col(value) > opened, 1.0).when(F.col(value) < closed, 0.0)
    backwards = Window.partitionBy("ep").orderBy(F.desc("idx")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.last("decided", ignorenulls=True).over(backwards)
    return frames.withColumn("decided", decided).withColumn("gripper", F.coalesce(following, F.first(value).over(backwards))).drop("decided")


def relative_gripper_to_absolute(frames: DataFrame, value: str, threshold: float = 0.1) -> DataFrame:
    """Strong moves set the state, weak ones keep it; before the first one it is the opposite of that move, or open."""
    w = in_order()
    move = F.when(F.col(value) < -threshold, 1.0).when(F.col(value) > threshold, -1.0)
    held = F.last("move", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = F.first("move", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return frames.withColumn("move", move).withColumn("gripper", F.coalesce(held, -first, F.lit(1.0)) / 2 + 0.5).drop("move")


def goal_relabel(frames: DataFrame, uniform: Column) -> DataFrame:
    """A goal frame drawn evenly from the frames after this one."""
    n = F.count(F.lit(1)).over(Window.partitionBy("ep"))
    return frames.withColumn("goal", F.least(F.floor(uniform * (n - F.col("idx") - 1) + F.col("idx") + 1), n - 1))


def moving_average(frames: DataFrame, value: str, reach: int = 2) -> DataFrame:
    """Mean over 2*reach+1 frames, zeros beyond the ends."""
    return frames.withColumn("smooth", F.sum(value).over(in_order().rowsBetween(-reach, reach)) / (2 * reach + 1))


def step_flags(frames: DataFrame) -> DataFrame:
    """First, last and terminal flags; reward 1 at the last step."""
    last = F.col("idx") == F.count(F.lit(1)).over(Window.partitionBy("ep")) - 1
    return frames.withColumns({"is_first": F.col("idx") == 0, "is_last": last, "is_terminal": last, "reward": F.when(last, 1.0).otherwise(0.0)})


def episode_ends(frames: DataFrame) -> DataFrame:
    """Per episode its length and its end in the concatenation of all episodes."""
    return running_sum(lengths(frames), ["ep"], F.col("n"), "episode_end").withColumnRenamed("n", "length")


def subsample(frames: DataFrame, stride: int) -> DataFrame:
    """W26."""
    return frames.where(F.col("idx") % stride == 0)


def sample_frames(frames: DataFrame, size: int, key: Column) -> DataFrame:
    """`size` frames of each episode, those with the smallest keys."""
    return frames.withColumn("draw", F.row_number().over(Window.partitionBy("ep").orderBy(key, "idx"))).where(F.col("draw") <= size).drop("draw")


def step_difference(frames: DataFrame, value: str) -> DataFrame:
    """The step to the next frame's value; the last frame goes, one with a null step stays."""
    return _before_last(frames.withColumn("delta", F.lead(value).over(in_order()) - F.col(value)))


def unsettled(frames: DataFrame, value: str, size: int, limit: float) -> DataFrame:
    """Per episode whether any of its last `size` frames is more than `limit` from the last one."""
    ends = frames.groupBy("ep").agg(F.count(F.lit(1)).alias("n"), F.max_by(value, "idx").alias("final"))
    late = frames.join(ends, "ep").where(F.col("idx") >= F.col("n") - size)
    return late.groupBy("ep").agg(F.bool_or(F.abs(F.col(value) - F.col("final")) > limit).alias("unsettled"))


def recent(frames: DataFrame, value: str, size: int) -> DataFrame:
    """The values a ring of `size` slots holds after every frame, oldest first, none before the first frame; a null fills a slot."""
    return frames.withColumn("ring", _with_nulls(value, in_order().rowsBetween(1 - size, 0)))


def collate(frames: DataFrame, batch: Column, value: str, size: int, fill: int = 0) -> DataFrame:
    """Per episode its first `size` values, filled up at the right to the longest of the batch, and their number."""
    cut = frames.where(F.col("idx") < size).withColumn("batch", batch)
    rows = cut.groupBy("batch", "ep").agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", value))), lambda s: s[value]).alias("values"))
    longest = rows.groupBy("batch").agg(F.max(F.size("values")).alias("longest"))
    padded = F.concat("values", F.array_repeat(F.lit(fill).cast("long"), F.col("longest") - F.size("values")))
    return rows.join(longest, "batch").select("batch", "ep", padded.alias("values"), F.size("values").cast("long").alias("real"))
