"""Actions and states as tokens and text, and back (survey rows N20-N26)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import clip
from .normalize import edges_below

#: (first edge, end, number of edges, end included) of the seven segments. Fixed values.
SEGMENTS = ((-1.0, -0.5, 15, False), (-0.5, -0.25, 40, False), (-0.25, -0.1, 42, False), (-0.1, 0.1, 62, False), (0.1, 0.25, 42, False), (0.25, 0.5, 40, False), (0.5, 1.0, 15, True))
#: Which joints change sign, the gripper's linear and angular ranges, and the lengths of its linkage. Fixed values.
FLIPPED_JOINTS = (1, -1, -1, 1, 1, 1, 1, 1, -1, -1, 1, 1, 1, 1)
GRIPPER_DIMS = (6, 13)
LINEAR, ANGULAR, JOINT = (0.01844, 0.05800), (0.4, 1.5), (-0.6213, 1.4910)
ARM_LENGTH, HORN_RADIUS = 0.036, 0.022


def uneven_bin(x: Column, segments: Sequence[tuple[float, float, int, bool]] = SEGMENTS) -> Column:
    """How many edges of the segments, which follow on each other, are not above the clipped x."""
    inside, count = clip(x, segments[0][0], segments[-1][1]), F.lit(0)
    for low, high, size, closed in segments:
        step = (high - low) / (size - 1 if closed else size)
        own = edges_below(inside, low, step, size, 1e-12)
        count = count + F.when(inside < low - 1e-12, 0).when(inside >= high, size).otherwise(own)
    return count


def parse_numbers(text: Column) -> Column:
    """Numbers parted by blanks."""
    return F.transform(F.split(text, " "), lambda x: x.cast("double"))


def tiled(values: Column, constants: Sequence[float], what: str = "length") -> Column:
    """Each value with its constant, constants repeated; the values' number must be a multiple of theirs."""
    table = F.array(*[F.lit(float(c)) for c in constants])
    ok = F.size(values) % len(constants) == 0
    checked = F.when(ok, values).otherwise(F.raise_error(F.lit(f"{what} is no multiple of {len(constants)}")).cast("array<double>"))
    return F.transform(checked, lambda x, i: F.struct(x.alias("x"), F.get(table, i % len(constants)).alias("c")))


def three_sigma(values: Column, mean: Sequence[float], std: Sequence[float], eps: float = 1e-5) -> Column:
    """Standard scores over three; the tokens' clip comes after."""
    centred = F.transform(tiled(values, mean), lambda v: v.x - v.c)
    return F.transform(tiled(centred, std), lambda v: v.x / (v.c + eps) / 3)


def three_sigma_inverse(values: Column, mean: Sequence[float], std: Sequence[float], eps: float = 1e-5) -> Column:
    """N23."""
    scaled = F.transform(tiled(values, std), lambda v: v.x * 3 * (v.c + eps))
    return F.transform(tiled(scaled, mean), lambda v: v.x + v.c)


def bounded(values: Column, low: Sequence[float], high: Sequence[float], eps: float = 0.0) -> Column:
    """To [-1, 1] by the bounds, with eps added to the range."""
    wide = [b - a for a, b in zip(low, high, strict=True)]
    above = F.transform(tiled(values, low), lambda v: v.x - v.c)
    return F.transform(tiled(above, wide), lambda v: v.x / (v.c + eps) * 2 - 1)


def bounded_inverse(values: Column, low: Sequence[float], high: Sequence[float], eps: float = 0.0) -> Column:
    """N23."""
    wide = [b - a for a, b in zip(low, high, strict=True)]
    scaled = F.transform(tiled(values, wide), lambda v: (v.x + 1) / 2 * (v.c + eps))
    return F.transform(tiled(scaled, low), lambda v: v.x + v.c)


def even_tokens(values: Column, vocabulary: int = 32000, bins: int = 256) -> Column:
    """N20 for arrays, by arithmetic: vocabulary minus the number of the `bins` even edges of [-1, 1] not above each clipped value."""
    step = 2.0 / (bins - 1)
    return F.transform(values, lambda x: (F.lit(vocabulary) - 1 - F.floor((clip(x, -1.0, 1.0) + 1) / step + 1e-9)).cast("int"))


def state_bin(x: Column, bins: int = 256) -> Column:
    """The number of the `bins` even edges of [-1, 1), from -1, that are not above x, less 1; -1 below the range."""
    return F.least(F.greatest(F.floor((x + 1) / F.lit(2.0 / bins)), F.lit(-1)), F.lit(bins - 1)).cast("int")


def state_prompt(task: Column, state: Column, bins: int = 256) -> Column:
    """`Task: ..., State: ...;` with a cleaned task and the state's bins."""
    clean = F.lower(F.replace(F.trim(task), F.lit("_"), F.lit(" ")))
    numbers = F.array_join(F.transform(state, lambda x: state_bin(x, bins).cast("string")), " ")
    return F.concat(F.lit("Task: "), clean, F.lit(", State: "), numbers, F.lit(";"))


def token_masks(prefix: Column, postfix: Column, size: int) -> tuple[Column, Column, Column, Column]:
    """(tokens, mask, autoregressive, loss) of `size`: prefix and postfix in a row, cut or filled up with 0 and false.

    All real tokens are in the mask; those of the postfix are autoregressive and in the loss.
    """
    n, m = F.size(prefix), F.size(postfix)
    tokens = F.slice(F.concat(prefix, postfix, F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(size) - n - m, F.lit(0)))), 1, size)
    at = F.sequence(F.lit(0), F.lit(size - 1))
    late = F.transform(at, lambda i: (i >= n) & (i < n + m))
    return tokens, F.transform(at, lambda i: i < n + m), late, late


def _between(x: Column, source: tuple[float, float], target: tuple[float, float] = (0.0, 1.0)) -> Column:
    return (x - source[0]) / (source[1] - source[0]) * (target[1] - target[0]) + target[0]


def gripper_to_angular(x: Column) -> Column:
    """A gripper's share of its linear range as a share of its angular range, by the law of cosines."""
    linear = _between(x, (0.0, 1.0), LINEAR)
    ratio = (HORN_RADIUS**2 + linear * linear - ARM_LENGTH**2) / (2 * HORN_RADIUS * linear)
    return _between(F.asin(clip(ratio, -1.0, 1.0)), ANGULAR)


def gripper_from_angular(x: Column, inverse: bool = False) -> Column:
    """A share of the angular range as a share of the joint's range, or back."""
    source, target = (JOINT, ANGULAR) if inverse else (ANGULAR, JOINT)
    return _between(_between(x, (0.0, 1.0), source), target)


def to_model_joints(state: Column) -> Column:
    """Joints with their signs flipped, the grippers' as angles."""
    flip = F.array(*[F.lit(float(s)) for s in FLIPPED_JOINTS])
    return F.transform(state, lambda x, i: F.when(i.isin(*GRIPPER_DIMS), gripper_to_angular(x)).otherwise(x * F.get(flip, i)))


def from_model_joints(action: Column, inverse: bool = False) -> Column:
    """The way back for actions; inverse undoes it."""
    flip = F.array(*[F.lit(float(s)) for s in FLIPPED_JOINTS])
    return F.transform(action, lambda x, i: F.when(i.isin(*GRIPPER_DIMS), gripper_from_angular(x, inverse)).otherwise(x * F.get(flip, i)))
