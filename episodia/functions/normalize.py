"""Normalization of single dimensions by statistics (survey rows N1-N20). Null stays null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import clip


def limits_scale(low: Column, high: Column, out_low: float = -1.0, out_high: float = 1.0, eps: float = 1e-4) -> tuple[Column, Column]:
    """(scale, offset) that send [low, high] to [out_low, out_high]; a range under eps gets scale 1 and its middle."""
    flat = (high - low) < eps
    scale = F.when(flat, 1.0).otherwise(F.lit(out_high - out_low) / F.when(flat, 1.0).otherwise(high - low))
    return scale, F.when(flat, F.lit((out_low + out_high) / 2) - low).otherwise(F.lit(out_low) - scale * low)


def limits_without_offset(low: Column, high: Column, out_abs: float = 1.0, eps: float = 1e-4) -> Column:
    """The scale that sends the largest absolute value to out_abs."""
    most = F.greatest(F.abs(low), F.abs(high))
    return F.when(most < eps, 1.0).otherwise(F.lit(out_abs) / F.when(most < eps, 1.0).otherwise(most))


def gaussian_scale(mean: Column, std: Column, eps: float = 1e-4) -> tuple[Column, Column]:
    """(scale, offset) of (x - mean) / std; a std under eps counts as 1."""
    scale = F.when(std < eps, 1.0).otherwise(1.0 / F.when(std < eps, 1.0).otherwise(std))
    return scale, -mean * scale


def apply_scale(x: Column, scale: Column, offset: Column) -> Column:
    """N4."""
    return x * scale + offset


def invert_scale(y: Column, scale: Column, offset: Column) -> Column:
    """N4, inverse."""
    return (y - offset) / scale


def normal(x: Column, mean: Column, std: Column, masked: Column | bool = True, eps: float = 1e-8) -> Column:
    """Standard score where masked, else x itself."""
    return F.when(F.lit(masked), (x - mean) / (std + eps)).otherwise(x)


def bounds(x: Column, low: Column, high: Column, masked: Column | bool = True, eps: float = 1e-8) -> Column:
    """To [-1, 1], clipped, where masked; a constant dimension becomes 0 whether masked or not."""
    inside = clip(2 * (x - low) / (high - low + eps) - 1, -1.0, 1.0)
    return F.when(low == high, 0.0).otherwise(F.when(F.lit(masked), inside).otherwise(x))


def quantile_range(x: Column, q01: Column, q99: Column, eps: float = 1e-6) -> Column:
    """To about [-1, 1], not clipped."""
    return (x - q01) / (q99 - q01 + eps) * 2 - 1


def quantile_range_inverse(y: Column, q01: Column, q99: Column, eps: float = 1e-6) -> Column:
    return (y + 1) / 2 * (q99 - q01 + eps) + q01


def delta_actions(actions: Column, state: Column, mask: list[bool], absolute: bool = False) -> Column:
    """Subtract (absolute: add) the state from every action where the mask, over the leading dimensions, says so."""
    m = F.array(*[F.lit(b) for b in mask])

    def one(action: Column) -> Column:
        return F.transform(action, lambda x, i: F.when(F.coalesce(F.get(m, i), F.lit(False)), x + F.get(state, i) if absolute else x - F.get(state, i)).otherwise(x))

    return F.transform(actions, one)


def make_bool_mask(*dims: int) -> list[bool]:
    """make_bool_mask(2, -2, 2) is True, True, False, False, True, True."""
    return [d > 0 for d in dims for _ in range(abs(d))]


def pad_to(a: Column, size: int) -> Column:
    """Zeros behind a up to `size` elements; longer arrays stay."""
    return F.concat(a, F.array_repeat(F.lit(0.0), F.greatest(F.lit(size) - F.size(a), F.lit(0))))


def scatter_slots(values: Column, slots: list[int], size: int) -> Column:
    """Values into their slots of a vector of `size`, zeros elsewhere; the later of two values of a slot counts."""
    of = {s: i for i, s in enumerate(slots)}
    return F.array(*[F.coalesce(F.get(values, F.lit(of[k])), F.lit(0.0)) if k in of else F.lit(0.0) for k in range(size)])


def invert_gripper(x: Column) -> Column:
    """N16."""
    return 1 - x


def quantize_normal(x: Column) -> Column:
    """To whole numbers from -127 to 127, half to even; NaN and infinity are errors."""
    bad = F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(bad, F.raise_error(F.lit("normal is not finite")).cast("double")).otherwise(F.bround(clip(x, -1.0, 1.0) * 127, 0)).cast("tinyint")


def depth_to_mm(depth: Column, frame_max: Column) -> Column:
    """Metres to whole millimetres, truncated and clipped to 16 bits; a frame with values over 20 is in millimetres."""
    return clip(F.when(frame_max > 20, depth).otherwise(depth * 1000), 0.0, 65535.0).cast("int")


def action_token(x: Column, vocabulary: int = 32000, bins: int = 256) -> Column:
    """Vocabulary minus the number of the `bins` even edges of [-1, 1] that are not above the clipped x."""
    inside = clip(x, -1.0, 1.0)
    return F.lit(vocabulary) - F.when(inside >= 1.0, bins).otherwise(edges_below(inside, -1.0, 2.0 / (bins - 1), bins))


def edges_below(x: Column, low: float, step: float, size: int, slack: float = 0.0) -> Column:
    """How many of the edges low + i * step, i below size, are not above x (plus slack).

    The place comes from a division, which may be off by one where x lies at an edge; the two edges next to it decide.
    """
    guess = F.floor((x + slack - low) / step)
    edge = lambda i: i * F.lit(step) + low
    count = guess + F.when(edge(guess + 1) <= x + slack, 2).when(edge(guess) <= x + slack, 1).otherwise(0)
    return F.greatest(F.least(count, F.lit(size)), F.lit(0)).cast("int")


def action_of_token(token: Column, vocabulary: int = 32000, bins: int = 256) -> Column:
    """N20, decoded: the centre of the token's bin."""
    at = F.greatest(F.least(F.lit(vocabulary) - token - 1, F.lit(bins - 2)), F.lit(0))
    return (at + 0.5) * F.lit(2.0 / (bins - 1)) - 1.0


def mean_std_inverse(y: Column, mean: Column, std: Column, eps: float = 1e-6) -> Column:
    """The inverse of the standard score; dimensions without statistics count as mean 0 and deviation 1."""
    return y * (F.coalesce(std, F.lit(1.0)) + eps) + F.coalesce(mean, F.lit(0.0))


def min_max(x: Column, low: Column, high: Column, margin: float = 1e-4) -> Column:
    """To [-1, 1] by bounds that are `margin` wider than the data."""
    return (x - (low - margin)) / ((high + margin) - (low - margin)) * 2 - 1


def noise_scale(std: Column, snr: float) -> Column:
    """The deviation of noise that leaves a signal-to-noise ratio of `snr` decibels."""
    return std / F.lit((10.0 ** (snr / 10.0)) ** 0.5)


def image_scale() -> tuple[Column, Column]:
    """(scale, offset) from [0, 1] to [-1, 1]."""
    return F.lit(2.0), F.lit(-1.0)


def identity_scale() -> tuple[Column, Column]:
    """N5."""
    return F.lit(1.0), F.lit(0.0)


def action_scale(dim: Column, low: Column, high: Column, arms: int = 1, arm_dims: int = 10) -> tuple[Column, Column]:
    """(scale, offset) of an action of one or two arms: the three dimensions of a position by their limits (range 1e-7), rotation and gripper as they are."""
    scale, offset = limits_scale(low, high, eps=1e-7)
    is_position = (dim % arm_dims < 3) & (dim < arms * arm_dims)
    return F.when(is_position, scale).otherwise(1.0), F.when(is_position, offset).otherwise(0.0)


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """N29."""
    return (x - mean) / std


def zscore_inverse(y: Column, mean: Column, std: Column) -> Column:
    """N29."""
    return y * std + mean


def evaluation_bounds(x: Column, low: Column, high: Column, masked: Column, eps: float = 1e-8) -> Column:
    """As bounds(), but the clip hits unmasked dimensions too and constants are not zeroed."""
    return clip(F.when(masked, 2 * (x - low) / (high - low + eps) - 1).otherwise(x), -1.0, 1.0)


def signed_gripper(x: Column, binarize: bool = False, flip: bool = False) -> Column:
    """From [0, 1] to [-1, 1]; binarized to its sign, of which 0 has none; flipped."""
    y = 2 * x - 1
    y = F.signum(y) if binarize else y
    return -y if flip else y


def is_zero_action(action: Column, zero: Column, eps: float = 1e-5) -> Column:
    """No component of the normalized action is more than eps from what zero normalizes to."""
    return F.forall(F.zip_with(action, zero, lambda a, z: F.abs(a - z)), lambda d: d <= eps)


def first_dims(action: Column, k: int) -> Column:
    """P22."""
    return F.slice(action, 1, k)
