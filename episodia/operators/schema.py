"""Changes of a table's columns by rule (survey rows P13, X14)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rename_columns(df: DataFrame, patterns: dict[str, str | None]) -> DataFrame:
    """Each column by the first pattern that matches its whole name: renamed, or dropped for None. Clashes are errors."""
    names: dict[str, str] = {}
    for old in df.columns:
        rule = next((p for p in patterns if re.fullmatch(p, old)), None)
        new = old if rule is None else patterns[rule] and re.sub(rule, patterns[rule], old)
        if new in names.values():
            raise ValueError(f"two columns would be called {new}")
        if new is not None:
            names[old] = new
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def flatten_structs(df: DataFrame, separator: str = "/") -> DataFrame:
    """One column for each leaf of nested structs, named by its path."""

    def leaves(schema: StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        return [leaf for f in schema for leaf in (leaves(f.dataType, (*path, f.name)) if isinstance(f.dataType, StructType) else [(*path, f.name)])]

    return df.select(*[F.col(".".join(f"`{p}`" for p in leaf)).alias(separator.join(leaf)) for leaf in leaves(df.schema, ())])
