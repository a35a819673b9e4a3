"""Images as flat arrays of numbers (survey row G20, without codecs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _taps(place: Column, size: int, to: int) -> tuple[Column, Column, Column]:
    """Of an output place the two input places next to its centre, and the weight of the second."""
    centre = (place + F.lit(0.5)) * F.lit(size / to) - F.lit(0.5)
    inside = F.greatest(F.least(centre, F.lit(float(size - 1))), F.lit(0.0))
    low = F.floor(inside).cast("int")
    return low, F.least(low + 1, F.lit(size - 1)), inside - low


def resize(pixels: Column, height: int, width: int, to_height: int, to_width: int) -> Column:
    """A row-major image of height x width by linear interpolation between the pixels' centres; beyond the outer centres the edge counts."""

    def pixel(place: Column) -> Column:
        (top, bottom, down), (left, right, across) = _taps(F.floor(place / to_width).cast("int"), height, to_height), _taps(place % to_width, width, to_width)
        at = lambda y, x: F.get(pixels, y * width + x).cast("double")
        upper = at(top, left) * (1 - across) + at(top, right) * across
        lower = at(bottom, left) * (1 - across) + at(bottom, right) * across
        return upper * (1 - down) + lower * down

    return F.transform(F.sequence(F.lit(0), F.lit(to_height * to_width - 1)), pixel)


def padded_size(height: int, width: int, to_height: int, to_width: int) -> tuple[int, int]:
    """The size of the largest image of the same proportions that fits."""
    ratio = max(width / to_width, height / to_height)
    return int(height / ratio), int(width / ratio)


def resize_with_pad(pixels: Column, height: int, width: int, to_height: int, to_width: int, fill: float = 0.0) -> Column:
    """Resized to fit without a change of proportions, in the middle of an image of the wanted size; the odd line of padding is below and to the right."""
    own_height, own_width = padded_size(height, width, to_height, to_width)
    top, left = (to_height - own_height) // 2, (to_width - own_width) // 2
    small = resize(pixels, height, width, own_height, own_width)

    def pixel(small: Column) -> Column:
        def at(place: Column) -> Column:
            y, x = F.floor(place / to_width).cast("int") - top, place % to_width - left
            inside = (y >= 0) & (y < own_height) & (x >= 0) & (x < own_width)
            return F.when(inside, F.get(small, F.when(inside, y * own_width + x))).otherwise(F.lit(fill))

        return F.transform(F.sequence(F.lit(0), F.lit(to_height * to_width - 1)), at)

    return F.get(F.transform(F.array(small), pixel), F.lit(0))  # small is computed once


def crop(pixels: Column, height: int, width: int, top: int, left: int, to_height: int, to_width: int) -> Column:
    """A part of an image."""
    if top < 0 or left < 0 or top + to_height > height or left + to_width > width:
        raise ValueError("the part lies beyond the image")
    return F.transform(F.sequence(F.lit(0), F.lit(to_height * to_width - 1)), lambda i: F.get(pixels, (F.floor(i / to_width).cast("int") + top) * width + i % to_width + left))


def center_crop(pixels: Column, height: int, width: int, share: float) -> Column:
    """The middle of an image, `share` of its area, brought back to the image's size."""
    own_height, own_width = (max(1, round(n * share**0.5)) for n in (height, width))
    middle = crop(pixels, height, width, (height - own_height) // 2, (width - own_width) // 2, own_height, own_width)
    return F.get(F.transform(F.array(middle), lambda part: resize(part, own_height, own_width, height, width)), F.lit(0))
