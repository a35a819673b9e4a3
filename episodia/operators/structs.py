"""Nested columns: maps by type, merges, padding, reshaping (survey rows U5, TU1-TU8, X18)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.text import padding_of

Change = Callable[[Column], Column]


def map_leaves(c: Column, kind: DataType, by_type: Mapping[str, Change]) -> Column:
    """TU1, TU8: c with every leaf changed by the function for its type's name; leaves of other types stay."""
    if isinstance(kind, StructType):
        inner = F.struct(*[map_leaves(c.getField(f.name), f.dataType, by_type).alias(f.name) for f in kind])
        return F.when(c.isNotNull(), inner)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: map_leaves(x, kind.elementType, by_type))
    if isinstance(kind, MapType):
        return F.transform_values(c, lambda _, v: map_leaves(v, kind.valueType, by_type))
    change = by_type.get(kind.simpleString())
    return c if change is None else change(c)


def map_columns(df: DataFrame, by_type: Mapping[str, Change]) -> DataFrame:
    """TU1 for all columns of a table."""
    return df.select(*[map_leaves(F.col(f"`{f.name}`"), f.dataType, by_type).alias(f.name) for f in df.schema])


def as_padding(df: DataFrame) -> DataFrame:
    """Every leaf replaced by its type's padding."""
    kinds = {k: (lambda _, k=k: padding_of(k)) for k in ("string", "double", "float", "int", "bigint", "smallint", "tinyint", "boolean")}
    return map_columns(df, kinds)


def merge_structs(a: Column, kind_a: StructType, b: Column, kind_b: StructType) -> Column:
    """The fields of both, nested structs merged in turn; elsewhere the right one wins, unless it is null."""
    fields = []
    for name in dict.fromkeys([*kind_a.names, *kind_b.names]):
        if name in kind_a.names and name in kind_b.names:
            x, y = kind_a[name].dataType, kind_b[name].dataType
            both = isinstance(x, StructType) and isinstance(y, StructType)
            merged = merge_structs(a.getField(name), x, b.getField(name), y) if both else F.coalesce(b.getField(name), a.getField(name))
        else:
            merged = (a if name in kind_a.names else b).getField(name)
        fields.append(merged.alias(name))
    return F.struct(*fields)


def merge_maps(*maps: Column) -> Column:
    """U5 for maps: of equal keys the last counts."""
    return reduce(lambda a, b: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b), maps)


def gather(sequence: Column, index: Column) -> Column:
    """TU2: the element at index, from 0; null beyond the ends."""
    return F.get(sequence, index.cast("int"))


def pad_sequence(sequence: Column, front: int = 0, back: int = 0, fill: Column | None = None) -> Column:
    """TU3: with `front` and `back` more elements: copies of the end, or fill."""
    begin = F.get(sequence, F.lit(0)) if fill is None else fill
    end = F.get(sequence, F.size(sequence) - 1) if fill is None else fill
    return F.concat(F.array_repeat(begin, front), sequence, F.array_repeat(end, back))


def reduce_sequence(sequence: Column, how: str) -> Column:
    """TU4: sum, max, mean or flatten."""
    total = F.aggregate(sequence, F.lit(0.0), lambda s, x: s + x) if how in ("sum", "mean") else None
    ways = {"sum": lambda: total, "mean": lambda: total / F.when(F.size(sequence) > 0, F.size(sequence)), "max": lambda: F.array_max(sequence), "flatten": lambda: F.flatten(sequence)}
    if how not in ways:
        raise ValueError(f"no reduction {how}")
    return ways[how]()


def one_hot(label: Column, classes: int) -> Column:
    """TU5."""
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == label).cast("int"))


def reshape(sequence: Column, width: int) -> Column:
    """TU6: in rows of `width`; the length must be a multiple of it."""
    rows = (F.size(sequence) / width).cast("int")
    cut = F.when(rows > 0, F.transform(F.sequence(F.lit(0), F.greatest(rows - 1, F.lit(0))), lambda i: F.slice(sequence, i * width + 1, width))).otherwise(F.array().cast("array<array<double>>"))
    return F.when(F.size(sequence) % width == 0, cut).otherwise(F.raise_error(F.lit(f"length is no multiple of {width}")).cast("array<array<double>>"))


def expand(c: Column, size: int) -> Column:
    """TU6: `size` copies along a new first dimension."""
    return F.array_repeat(c, size)


def to_columns(df: DataFrame, key: str, *fields: str) -> DataFrame:
    """TU7: rows of a key as one row of lists, in order of the first field."""
    together = F.sort_array(F.collect_list(F.struct(*fields)))
    return df.groupBy(key).agg(together.alias("_rows")).select(key, *[F.col(f"_rows.{f}").alias(f) for f in fields])


def to_rows(df: DataFrame, key: str, *fields: str) -> DataFrame:
    """TU7: the way back."""
    return df.select(key, F.explode(F.arrays_zip(*fields)).alias("_row")).select(key, *[F.col(f"_row.{f}").alias(f) for f in fields])


def split_struct(df: DataFrame, column: str, groups: Mapping[str, list[int]]) -> DataFrame:
    """TU8: an array as several, each of the positions listed for its name; the array goes."""
    return df.select("*", *[F.array(*[F.get(column, F.lit(i)) for i in at]).alias(name) for name, at in groups.items()]).drop(column)
