"""Poses along trees of joints (survey row G10)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..functions import geometry
from ..sources.storage import delete, new_folder, stored, stored_at
from .scene import IDENTITY, as_array, as_matrix

#: Links that a tree may have to be sent to every executor.
BROADCAST_LINKS = 50_000
#: Links that a tree may have to be worked out by one task, for GROUP_SAMPLES samples at once.
GROUP_LINKS = 8192
GROUP_SAMPLES = 32


def origin_matrix(position: geometry.Vector, angles: geometry.Vector) -> Column:
    """A joint's place in its parent's frame: a shift, and turns about x, y and z, one after the other, as an array of 16."""
    turn = geometry.euler_matrix(*angles)
    return as_array(geometry.homogeneous(tuple((*row, p) for row, p in zip(turn, position, strict=True))))


def motion_matrix(kind: Column, axis: Column, value: Column) -> Column:
    """What a joint adds to its place: a turn by `value` about its axis (revolute, continuous), a shift along it (prismatic), or nothing.

    The axis of a turn counts by its direction, that of a shift as it is.
    """
    x, y, z = (F.get(axis, F.lit(i)).cast("double") for i in range(3))
    norm = F.sqrt(x * x + y * y + z * z)
    length = F.when(norm > 0, norm).otherwise(F.raise_error(F.lit("a joint's axis must not be zero")).cast("double"))
    a = tuple(c / length for c in (x, y, z))
    c, s = F.cos(value), F.sin(value)
    cross = ((F.lit(0.0), -a[2], a[1]), (a[2], F.lit(0.0), -a[0]), (-a[1], a[0], F.lit(0.0)))
    turn = tuple(tuple((c if i == j else F.lit(0.0)) + a[i] * a[j] * (1 - c) + s * cross[i][j] for j in range(3)) + (F.lit(0.0),) for i in range(3))
    shift = tuple(tuple(F.lit(1.0 if i == j else 0.0) for j in range(3)) + (v * value,) for i, v in enumerate((x, y, z)))
    matrix = lambda m: as_array(geometry.homogeneous(m))
    return F.when(kind.isin("revolute", "continuous"), matrix(turn)).when(kind == "prismatic", matrix(shift)).otherwise(F.array(*map(F.lit, IDENTITY)))


def product(a: Column, b: Column) -> Column:
    """The product of two 4 x 4 matrices, each an array of 16."""
    return as_array(geometry.matmul(as_matrix(a), as_matrix(b)))


def ancestors(links: DataFrame) -> list[DataFrame]:
    """(link, up) for each doubling of the step: the parent, its parent's parent, the fourth, eighth ... ancestor of the links that have one.

    links: link, parent. A link with two parents and a circle of links are errors: in a tree of n links no step of n
    and more leads anywhere.
    """
    up = stored(links.select("link", F.col("parent").alias("up")), "tree")
    n = up.count()
    if up.select("link").distinct().count() < n:
        raise ValueError("a link hangs on two joints")
    steps, reach = [], 1
    while not up.isEmpty():
        if reach > n:
            raise ValueError("the joints form a circle")
        steps.append(up)
        further = up.select(F.col("link").alias("up"), F.col("up").alias("further"))
        up = stored(up.join(further, "up").select("link", F.col("further").alias("up")), "tree")
        reach *= 2
    return steps


def tree_tops(links: DataFrame) -> DataFrame:
    """(link, top, depth): the root of each link's tree and the number of joints up to it; links: link, parent.

    A link that has found its root rests; the others jump to where their ancestor has got. Two parents and circles are errors.
    """
    spark, folder = links.sparkSession, new_folder(links.sparkSession, "tops")
    state = stored_at(links.select("link", F.col("parent").alias("top"), F.lit(1).cast("long").alias("depth"), F.lit(True).alias("open")), f"{folder}/0")
    n = state.count()
    if state.select("link").distinct().count() < n:
        raise ValueError("a link hangs on two joints")
    k = 0
    while not state.where("open").isEmpty():
        if 1 << k > n:
            raise ValueError("the joints form a circle")
        above = state.select(F.col("link").alias("top"), F.col("top").alias("further"), F.col("depth").alias("more"))
        moved = state.where("open").join(above, "top", "left").select("link", F.coalesce("further", "top").alias("top"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("further").isNotNull().alias("open"))
        state = stored_at(state.where("not open").unionByName(moved), f"{folder}/{k + 1}")
        delete(spark, f"{folder}/{k}")
        k += 1
    return state.drop("open")


def _motions(kinds: np.ndarray, axes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """motion_matrix() of values (samples, links), as (samples, links, 4, 4)."""
    out = np.zeros((*values.shape, 4, 4))
    out[..., range(4), range(4)] = 1.0
    turns = np.isin(kinds, ("revolute", "continuous"))
    norms = np.sqrt((axes[turns] ** 2).sum(axis=1))
    if not (norms > 0).all():
        raise ValueError("a joint's axis must not be zero")
    x, y, z = (axes[turns] / norms[:, None]).T
    c, s = np.cos(values[:, turns]), np.sin(values[:, turns])
    rows = (c + x * x * (1 - c), x * y * (1 - c) - z * s, x * z * (1 - c) + y * s), (x * y * (1 - c) + z * s, c + y * y * (1 - c), y * z * (1 - c) - x * s), (x * z * (1 - c) - y * s, y * z * (1 - c) + x * s, c + z * z * (1 - c))
    for i, row in enumerate(rows):
        for j, cell in enumerate(row):
            out[:, turns, i, j] = cell
    shifts = kinds == "prismatic"
    out[..., :3, 3][:, shifts] = axes[shifts] * values[:, shifts, None]
    return out


def _tree_poses(links: DataFrame, values: DataFrame, samples: DataFrame, placed: DataFrame, n: int) -> DataFrame:
    """link_poses() without roots for trees of bounded size: several trees and samples are one group, which a task works out from the roots down."""
    dealt = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts))
    buckets, blocks = -(-n // (GROUP_LINKS // 2)) or 1, -(-samples.count() // GROUP_SAMPLES) or 1
    home = placed.withColumn("bucket", dealt("top", buckets))
    left = links.join(home, "link").select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "link", "parent", "depth", F.coalesce("kind", F.lit("")).alias("kind"), as_array(as_matrix(F.col("origin"))).alias("origin"), F.array(*[F.get("axis", F.lit(i)).cast("double") for i in range(3)]).alias("axis"))
    of = links.select("link", "joint").join(home.select("link", "bucket"), "link")
    given = values.join(of, "joint").select("bucket", "sample", "link", F.col("value").cast("double").alias("value"))
    link_type = links.schema["link"].dataType
    every = home.select("bucket").distinct().join(samples).select("bucket", "sample", F.lit(None).cast(link_type).alias("link"), F.lit(None).cast("double").alias("value"))
    right = given.unionByName(every).withColumn("block", dealt("sample", blocks))
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # names of its own, as both sides come from the links

    def work(tree: pa.Table, moved: pa.Table) -> pa.Table:
        names, shown = tree["link"].combine_chunks(), moved["sample"].unique()
        if isinstance(shown, pa.ChunkedArray):
            shown = shown.combine_chunks()
        wide, size = len(names), len(shown)
        up = pc.index_in(tree["parent"], value_set=names).combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False)
        depth, kinds = tree["depth"].to_numpy(), np.array(tree["kind"].to_pylist(), dtype=object)
        matrix = tree["origin"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(wide, 4, 4)
        axes = tree["axis"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(wide, 3)
        moved = moved.filter(pc.and_(pc.is_valid(moved["link"]), pc.is_valid(moved["value"])))
        at = np.zeros((size, wide))
        if len(moved):
            at[pc.index_in(moved["sample"], value_set=shown).to_numpy(), pc.index_in(moved["link"], value_set=names).to_numpy()] = moved["value"].to_numpy()
        pose = matrix @ _motions(kinds, axes, at)
        order = np.argsort(depth, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)[1:]:  # a root's own pose is the identity
            pose[:, level] = pose[:, up[level]] @ pose[:, level]
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, 16 * size * wide + 1, 16, dtype=np.int32)), pa.array(pose.reshape(-1)))
        return pa.table({"sample": shown.take(pa.array(np.repeat(np.arange(size), wide))), "link": names.take(pa.array(np.tile(np.arange(wide), size))), "pose": flat})

    schema = StructType([StructField("sample", values.schema["sample"].dataType), StructField("link", link_type), StructField("pose", ArrayType(DoubleType()))])
    return left.groupBy("bucket", "block").cogroup(right.groupBy("bucket", "block")).applyInArrow(work, schema)


def _halved_poses(links: DataFrame, values: DataFrame, samples: DataFrame) -> DataFrame:
    """link_poses() without roots for trees of any size: a round's table is deleted when the next one is written."""
    spark, folder = links.sparkSession, new_folder(links.sparkSession, "poses")
    steps = ancestors(links)
    n = links.count()
    small = (lambda df: F.broadcast(df)) if n <= BROADCAST_LINKS else (lambda df: df)
    rows = samples.join(small(links)).join(values, ["sample", "joint"], "left")  # each sample moves the whole tree
    moved = rows.withColumn("motion", motion_matrix(F.col("kind"), F.col("axis"), F.coalesce("value", F.lit(0.0))))
    poses = stored_at(moved.select("sample", "link", product(F.col("origin"), F.col("motion")).alias("pose")), f"{folder}/0")
    for k, step in enumerate(steps):
        above = poses.select("sample", F.col("link").alias("up"), F.col("pose").alias("above"))
        whole = F.when(F.col("above").isNull(), F.col("pose")).otherwise(product(F.col("above"), F.col("pose")))  # a root's own pose is the identity
        poses = stored_at(poses.join(small(step), "link", "left").join(above, ["sample", "up"], "left").select("sample", "link", whole.alias("pose")), f"{folder}/{k + 1}")
        delete(spark, f"{folder}/{k}")
    return poses


def link_poses(links: DataFrame, values: DataFrame, most: int = GROUP_LINKS) -> DataFrame:
    """(sample, link, pose): the pose of every link for every sample of joint values, in the frame of its tree's root.

    links: link, parent, joint, kind, origin (an array of 16), axis (an array of three); the parent of a first link is a
    root, whose pose is the identity and which gets a row as well. values: sample, joint, value; a joint without one
    stands at 0, and repeated values of a joint count once (the smallest). Poses are products along the way from the
    root. Trees of up to `most` links move once, with their values, to tasks that work them out from the root down, for
    some samples at a time. In larger ones the way is halved from round to round: each link takes the product of the
    ancestor that the ways so far lead to, so that a chain of d joints takes log2(d) joins on (sample, link).
    """
    placed = tree_tops(links)
    values = values.groupBy("sample", "joint").agg(F.min("value").alias("value"))
    samples = values.select("sample").distinct()
    sizes = placed.groupBy("top").agg(F.count(F.lit(1)).alias("size"))
    large, n = sizes.where(F.col("size") > most).select("top"), placed.count()
    if large.isEmpty():
        poses = _tree_poses(links, values, samples, placed, n)
    else:
        kept, rest = placed.join(large, "top", "left_anti"), placed.join(large, "top", "left_semi").select("link")
        poses = _tree_poses(links.join(kept.select("link"), "link"), values, samples, kept, n).unionByName(_halved_poses(links.join(rest, "link"), values, samples))
    roots = placed.select(F.col("top").alias("link")).distinct()
    small = F.broadcast(roots) if n <= BROADCAST_LINKS else roots
    return poses.unionByName(samples.join(small).select("sample", "link", F.array(*map(F.lit, IDENTITY)).alias("pose")))
