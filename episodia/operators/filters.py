"""Rows, frames and episodes kept or dropped (survey rows P1-P21, X16, X22, X24, F3, F8)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def valid_pixels(pixels: DataFrame, keep: Iterable[int] | None = None, drop: Iterable[int] = ()) -> DataFrame:
    """Pixels (x, y, z, w, actor_id) with a finite position and w < 1, of actors to keep, without those to drop."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    rows = pixels.where(finite("x") & finite("y") & finite("z") & (F.col("w") < 1) & ~F.isnan("w"))
    rows = rows if keep is None else rows.where(F.col("actor_id").isin(*keep))
    return rows.where(~F.col("actor_id").isin(*drop)) if list(drop) else rows


def of_tasks(rows: DataFrame, tasks: Iterable[str] | None, column: str = "task") -> DataFrame:
    """Rows of the tasks; all without a list."""
    return rows if tasks is None else rows.where(F.col(column).isin(*tasks))


def list_issues(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Plus issues, the names of the checks that a row fails, in their order; null counts as passed."""
    return rows.withColumn("issues", F.array_compact(F.array(*[F.when(bad, name) for name, bad in checks.items()])))


def issues_by(rows: DataFrame, checks: dict[str, Column], *keys: str) -> DataFrame:
    """Per key the sorted issues of all its rows; keys without one don't appear."""
    found = list_issues(rows, checks).select(*keys, F.explode("issues").alias("issue"))
    return found.groupBy(*keys).agg(F.sort_array(F.collect_list("issue")).alias("issues"))


def moving_clips(clipped: DataFrame, value: str, least: float) -> DataFrame:
    """Clips whose value moves by `least` or more, numbered anew within their episode."""
    moved = clipped.groupBy("ep", "clip").agg((F.max(value) - F.min(value)).alias("motion")).where(F.col("motion") >= least)
    return moved.withColumn("ordinal", (F.row_number().over(Window.partitionBy("ep").orderBy("clip")) - 1).cast("long"))


def labelled_episodes(rows: DataFrame, key: str, labelled: Column) -> DataFrame:
    """P5: all rows of episodes that have a labelled one."""
    return rows.join(rows.where(labelled).select(key).distinct(), key, "left_semi")


def bounded_episodes(frames: DataFrame, value: str, bound: float) -> DataFrame:
    """(ep, n) of the episodes whose absolute values all stay within the bound."""
    return frames.groupBy("ep").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.abs(value) <= bound).alias("ok")).where("ok").drop("ok")


def matching_paths(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows whose whole path matches."""
    return rows.where(F.col(path).rlike(rf"\A(?:{pattern})\z"))


def in_ranges(frames: DataFrame, ranges: DataFrame) -> DataFrame:
    """Frames in some range (ep, begin, end) of their episode; begin counts, end doesn't."""
    r = ranges.select(F.col("ep").alias("_ep"), "begin", "end")
    return frames.join(r, (F.col("ep") == F.col("_ep")) & (F.col("idx") >= F.col("begin")) & (F.col("idx") < F.col("end")), "left_semi")


def successful(rows: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet every condition; null is not met."""
    for c in conditions:
        rows = rows.where(c)
    return rows


def episode_lengths(frames: DataFrame, low: int) -> DataFrame:
    """Frames of episodes of at least `low` frames, plus n."""
    return frames.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("ep"))).where(F.col("n") >= low)


def skip_files(paths: DataFrame, column: str = "path", directories: Iterable[str] = ("pointcloud",), names: Iterable[str] = ("features", "mirror")) -> DataFrame:
    """Paths without one of the directories and without one of the names in the file's own."""
    rows = paths
    for d in directories:
        rows = rows.where(~F.col(column).contains(f"{d}/"))
    own = F.regexp_extract(column, "([^/]*)$", 1)
    for n in names:
        rows = rows.where(~own.contains(n))
    return rows


def drop_strings(rows: DataFrame) -> DataFrame:
    """The columns that are no texts."""
    return rows.select(*[f.name for f in rows.schema if not isinstance(f.dataType, StringType)])


def swap_in_last(frames: DataFrame, episode: str, gone: int) -> DataFrame:
    """Without episode `gone`, whose number the last episode takes."""
    last = frames.agg(F.max(episode).alias("_last"))
    rest = frames.where(F.col(episode) != gone).join(F.broadcast(last))
    return rest.withColumn(episode, F.when(F.col(episode) == F.col("_last"), gone).otherwise(F.col(episode))).drop("_last")


def within_box(rows: DataFrame, point: tuple[Column, ...], low: tuple[float, ...], high: tuple[float, ...]) -> DataFrame:
    """P20: points in the box, its sides included."""
    for c, a, b in zip(point, low, high, strict=True):
        rows = rows.where(c.between(a, b))
    return rows


def camera_slots(images: Column, slots: list[str], zeros: Column, mask_missing: bool = True) -> Column:
    """A struct of (image, mask) by slot from a map of images; missing ones are zeros and, where masked, false. A name
    that is no slot is an error."""
    unknown = F.array_except(F.map_keys(images), F.array(*map(F.lit, slots)))
    checked = F.when(F.size(unknown) == 0, images).otherwise(F.raise_error(F.concat(F.lit("unexpected cameras: "), F.array_join(unknown, ", "))).cast("map<string,string>"))
    of = lambda s: F.element_at(checked, F.lit(s))
    return F.struct(*[F.struct(F.coalesce(of(s), zeros).alias("image"), (of(s).isNotNull() if mask_missing else F.lit(True)).alias("mask")).alias(s) for s in slots])


def drop_conditions(rows: DataFrame, drops: dict[str, tuple[Column, Column]], share: float) -> DataFrame:
    """Each column (its uniform number, what stands for nothing) replaced where its own draw falls below the share."""
    return rows.withColumns({name: F.when(uniform < share, nothing).otherwise(F.col(name)) for name, (uniform, nothing) in drops.items()})


def keep_one(rows: DataFrame, image: str, text: str, uniform: Column, unlabelled: Column, share: float = 0.5) -> DataFrame:
    """The image goal or the text, by a draw; the image where there is no label."""
    keep_image = (uniform < share) | unlabelled
    return rows.withColumns({image: F.when(keep_image, F.col(image)), text: F.when(keep_image, "").otherwise(F.col(text))})
