"""Scene clips from the pixels of a first frame and the poses of parts (survey §2.14, rows P1, J6-J9, T1, G3-G6).

Frames of a clip are rows; a 4 x 4 pose is an array of 16 numbers by row. Parts are told apart by their position, so two
parts may have one name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry
from ..sources.storage import stored
from .filters import valid_pixels
from .sampling import even_place

#: Names that other tools read. Fixed values.
OBJECT, ROBOT, STATIC = "task_object", "robot", "static"
ROBOT_PREFIX, STATIC_PREFIX = "robot__", "static_actor_"
IDENTITY = [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]


def as_matrix(pose: Column) -> tuple[tuple[Column, ...], ...]:
    return tuple(tuple(F.get(pose, F.lit(4 * i + j)).cast("double") for j in range(4)) for i in range(4))


def as_array(m: tuple[tuple[Column, ...], ...]) -> Column:
    return F.array(*[c for row in m for c in row])


def camera_normals(pixels: DataFrame, *keys: str) -> DataFrame:
    """Pixels (keys, v, u, x, y, z, w, actor_id) plus nx, ny, nz: estimated from the neighbours left, right, above and
    below, turned to the camera at the origin.

    They are zero at the image's borders, where the pixel or a neighbour is not valid, and where a neighbour shows
    another actor. Pixels of one row or column of an image are put in order together.
    """
    ok = F.col("x").isNotNull() & (F.abs("x") + F.abs("y") + F.abs("z") < F.lit(float("inf"))) & (F.col("w") < 1)
    here = F.struct("x", "y", "z", "actor_id", ok.alias("ok"))
    row, column = Window.partitionBy(*keys, "v").orderBy("u"), Window.partitionBy(*keys, "u").orderBy("v")
    at = pixels.withColumn("_here", here)
    at = at.withColumns({"_left": F.lag("_here").over(row), "_right": F.lead("_here").over(row)}).withColumns({"_up": F.lag("_here").over(column), "_down": F.lead("_here").over(column)})
    around = [F.col(c) for c in ("_left", "_right", "_up", "_down")]
    good = F.col("_here").ok
    for c in around:
        good = good & F.coalesce(c.ok & (c.actor_id == F.col("actor_id")), F.lit(False))
    dx, dy = (tuple(b[k] - a[k] for k in "xyz") for a, b in ((around[0], around[1]), (around[2], around[3])))
    n = geometry.facing(geometry.cross(dx, dy), (F.col("x"), F.col("y"), F.col("z")), (F.lit(0.0),) * 3)
    return at.withColumns({f"n{k}": F.when(good, c).otherwise(0.0) for k, c in zip("xyz", n, strict=True)}).drop("_here", "_left", "_right", "_up", "_down")


def world_points(pixels: DataFrame, camera_to_world: Column, keep: Sequence[int] | None = None, drop: Sequence[int] = ()) -> DataFrame:
    """The valid pixels' points and normals in the world; the camera's pose is an array of 16."""
    m = as_matrix(camera_to_world)
    point = geometry.transform_point([r[:3] for r in m[:3]], tuple(r[3] for r in m[:3]), tuple(F.col(c).cast("double") for c in "xyz"))
    normal = geometry.unit(geometry.rotate([r[:3] for r in m[:3]], tuple(F.coalesce(F.col(c), F.lit(0.0)).cast("double") for c in ("nx", "ny", "nz"))))
    names = ("x", "y", "z", "nx", "ny", "nz")
    return valid_pixels(pixels, keep, drop).withColumns({f"_{n}": c for n, c in zip(names, (*point, *normal), strict=True)}).drop(*names).withColumnsRenamed({f"_{n}": n for n in names})


def clip_parts(points: DataFrame, parts: DataFrame, drop: Sequence[int] = (), statics: bool = True) -> DataFrame:
    """(clip, part_pos, part_name, object_name, category, is_robot, actor_id) of the parts that have points.

    parts: clip, part_pos, actor_id, part_name, object_name, is_robot. Objects come in their order, then robots, each
    actor once, then the actors that no part tracks, by number. Negative and dropped actors are left out.
    """
    known = parts.where(F.col("actor_id") >= 0).where(~F.col("actor_id").isin(*drop) if list(drop) else F.lit(True))
    once = F.row_number().over(Window.partitionBy("clip", "is_robot", "actor_id").orderBy("part_pos"))
    known = known.withColumn("_nth", once).where(~F.col("is_robot") | (F.col("_nth") == 1)).drop("_nth")
    seen = points.select("clip", "actor_id").distinct()
    name = F.when(F.col("is_robot"), F.concat(F.lit(ROBOT_PREFIX), "part_name")).otherwise(F.col("part_name"))
    tracked = known.join(seen, ["clip", "actor_id"], "left_semi").select(
        "clip", "part_pos", name.alias("part_name"), F.when(F.col("is_robot"), name).otherwise(F.col("object_name")).alias("object_name"),
        F.when(F.col("is_robot"), ROBOT).otherwise(OBJECT).alias("category"), "is_robot", "actor_id",
    )
    if statics:
        loose = seen.join(known.select("clip", "actor_id"), ["clip", "actor_id"], "left_anti")
        own = F.concat(F.lit(STATIC_PREFIX), F.col("actor_id").cast("string"))
        tracked = tracked.unionByName(loose.select("clip", F.lit(None).cast(parts.schema["part_pos"].dataType).alias("part_pos"), own.alias("part_name"), own.alias("object_name"), F.lit(STATIC).alias("category"), F.lit(False).alias("is_robot"), "actor_id"))
    group = F.when(F.col("category") == OBJECT, 0).when(F.col("category") == ROBOT, 1).otherwise(2)
    order = F.row_number().over(Window.partitionBy("clip").orderBy(group, F.col("part_pos"), F.col("actor_id"))) - 1
    return tracked.withColumn("part", order.cast("long"))


def local_points(points: DataFrame, parts: DataFrame, poses: DataFrame, most: int | None = None) -> DataFrame:
    """(clip, part, point, x, y, z, nx, ny, nz, r, g, b) in the frame of the part's pose at frame 0, at most `most`
    points of a part, evenly spread over its pixels in order. Static parts keep world coordinates."""
    pixel = Window.partitionBy("clip", "part").orderBy("v", "u")
    rows = points.join(parts.select("clip", "part", "part_pos", "actor_id"), ["clip", "actor_id"])
    rows = rows.withColumn("point", (F.row_number().over(pixel) - 1).cast("long"))
    if most is not None:
        n = F.count(F.lit(1)).over(pixel.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        rows = rows.withColumn("_n", n).withColumn("point", even_place(F.col("point"), F.col("_n"), most)).where("point is not null").drop("_n")
    first = poses.where("t = 0").select("clip", "part_pos", F.col("pose").alias("_pose"))
    rows = rows.join(first, ["clip", "part_pos"], "left").withColumn("_pose", F.coalesce("_pose", F.array(*map(F.lit, IDENTITY))))
    m = as_matrix(F.col("_pose"))
    turn, shift = [r[:3] for r in m[:3]], tuple(r[3] for r in m[:3])
    p = geometry.to_local(turn, shift, tuple(F.col(c) for c in "xyz"))
    n = geometry.unit(geometry.rotate(tuple(zip(*turn, strict=True)), tuple(F.col(c) for c in ("nx", "ny", "nz"))))
    return rows.select("clip", "part", "point", *[c.alias(k) for c, k in zip((*p, *n), ("x", "y", "z", "nx", "ny", "nz"), strict=True)], "r", "g", "b")


def part_trajectories(parts: DataFrame, poses: DataFrame) -> DataFrame:
    """(clip, part, t, pose, px, py, pz, qx, qy, qz, qw) of every part at every frame of its clip; static parts stand still."""
    times = poses.select("clip", "t").distinct()
    rows = parts.select("clip", "part", "part_pos").join(times, "clip").join(poses, ["clip", "part_pos", "t"], "left")
    rows = rows.withColumn("pose", F.coalesce("pose", F.array(*map(F.lit, IDENTITY)))).select("clip", "part", "t", "pose")
    m = as_matrix(F.col("pose"))
    q = geometry.matrix_quaternion(tuple(r[:3] for r in m[:3]))
    return rows.select("*", *[c.alias(n) for c, n in zip((*[r[3] for r in m[:3]], *q), ("px", "py", "pz", "qx", "qy", "qz", "qw"), strict=True)])


def scene_flows(local: DataFrame, trajectories: DataFrame) -> DataFrame:
    """Every point and its normal at every frame of the clip."""
    m = as_matrix(F.col("pose"))
    turn = [r[:3] for r in m[:3]]
    p = geometry.transform_point(turn, tuple(r[3] for r in m[:3]), tuple(F.col(c) for c in "xyz"))
    n = geometry.unit(geometry.rotate(turn, tuple(F.col(c) for c in ("nx", "ny", "nz"))))
    return local.join(trajectories.select("clip", "part", "t", "pose"), ["clip", "part"]).select("clip", "part", "point", "t", *[c.alias(k) for c, k in zip((*p, *n), ("x", "y", "z", "nx", "ny", "nz"), strict=True)], "r", "g", "b")


def build_clips(pixels: DataFrame, cameras: DataFrame, parts: DataFrame, poses: DataFrame, most: int | None = None, drop: Sequence[int] = (), statics: bool = True) -> dict[str, DataFrame]:
    """The composite: parts, local points, trajectories and flows of clips. Each is written once and read by what builds on it.

    pixels: clip, v, u, x, y, z, w, actor_id, r, g, b and nx, ny, nz, or without normals, which are then estimated.
    cameras: clip, pose (camera to world at frame 0). parts as in clip_parts(); poses: clip, part_pos, t, pose.
    """
    if "nx" not in pixels.columns:
        pixels = camera_normals(pixels, "clip")
    keep = pixels.join(cameras.select("clip", F.col("pose").alias("_camera")), "clip")
    points = stored(world_points(keep, F.col("_camera"), None, drop).drop("_camera"), "points")
    parts, poses = stored(parts, "parts"), stored(poses, "poses")
    found = stored(clip_parts(points, parts, drop, statics), "found")
    local = stored(local_points(points, found, poses, most), "local")
    trajectories = stored(part_trajectories(found, poses), "trajectories")
    return {"parts": found, "points": local, "trajectories": trajectories, "flows": scene_flows(local, trajectories)}


def rebased(poses: DataFrame, bases: DataFrame) -> DataFrame:
    """Poses (clip, part_pos, t, pose) in the frame of the clip's base pose at frame 0; bases: clip, t, pose."""
    first = bases.where("t = 0").select("clip", F.col("pose").alias("_base"))
    return poses.join(first, "clip").withColumn("pose", as_array(geometry.rebase(as_matrix(F.col("_base")), as_matrix(F.col("pose"))))).drop("_base")


def interpolate(poses: DataFrame, wanted: DataFrame) -> DataFrame:
    """(ep, t, x, y, z, qx, qy, qz, qw) at wanted times (ep, t), between the poses (ep, t, the same columns) before and
    after; times beyond the ends take the end's pose. Poses and wanted times of an episode are put in order together."""
    names = ("x", "y", "z", "qx", "qy", "qz", "qw")
    pose = F.struct("t", *names)
    rows = poses.select("ep", F.col("t").cast("double").alias("t"), *names)
    both = rows.select("ep", "t", pose.alias("pose"), F.lit(False).alias("asked"))
    both = both.unionByName(wanted.select("ep", F.col("t").cast("double").alias("t"), F.lit(None).cast(both.schema["pose"].dataType).alias("pose"), F.lit(True).alias("asked")))
    before = F.last("pose", ignorenulls=True).over(Window.partitionBy("ep").orderBy("t", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.last("pose", ignorenulls=True).over(Window.partitionBy("ep").orderBy(F.desc("t"), "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = both.withColumns({"a": before, "b": after}).where("asked")
    both = both.withColumns({"a": F.coalesce("a", "b"), "b": F.coalesce("b", "a")})
    a, b = F.col("a"), F.col("b")
    share = F.when(b.t > a.t, (F.col("t") - a.t) / F.when(b.t > a.t, b.t - a.t).otherwise(1.0)).otherwise(0.0)
    both = both.withColumn("s", share)
    s = F.col("s")
    place = [(a[c] + (b[c] - a[c]) * s).alias(c) for c in ("x", "y", "z")]
    q = geometry.slerp(tuple(a[c] for c in names[3:]), tuple(b[c] for c in names[3:]), s)
    return both.select("ep", "t", *place, *[c.alias(n) for c, n in zip(q, names[3:], strict=True)])


def waypoint_times(waypoints: DataFrame, max_shift: float, max_turn: float) -> DataFrame:
    """Plus time, when each waypoint (ep, idx, t, x, y, z, qx, qy, qz, qw) is reached if neither the speed of shifts nor
    that of turns may exceed its limit: each leg lasts at least as long as asked for by t and as the limits need."""
    w = Window.partitionBy("ep").orderBy("idx")
    last = {c: F.lag(c).over(w) for c in ("t", "x", "y", "z", "qx", "qy", "qz", "qw")}
    rows = waypoints.withColumns({f"_{c}": e for c, e in last.items()})
    shift = F.sqrt(sum(((F.col(c) - F.col(f"_{c}")) * (F.col(c) - F.col(f"_{c}")) for c in "yz"), (F.col("x") - F.col("_x")) * (F.col("x") - F.col("_x"))))
    turn = geometry.rotation_distance(tuple(F.col(c) for c in ("qx", "qy", "qz", "qw")), tuple(F.col(f"_{c}") for c in ("qx", "qy", "qz", "qw")))
    leg = F.greatest(F.col("t") - F.col("_t"), shift / max_shift, turn / max_turn)
    first = F.first("t").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    legs = rows.withColumn("_leg", F.coalesce(leg, F.lit(0.0))).withColumn("_first", first)
    return legs.withColumn("time", F.col("_first") + F.sum("_leg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_leg", "_first", *[f"_{c}" for c in last])
