"""Wide and long shapes, all with the value list given, so no extra job finds it."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by_class(
    df: DataFrame,
    keys: Sequence[str],
    class_column: str,
    value: str,
    classes: Mapping[str, str],
    nullable: Collection[str] = (),
) -> DataFrame:
    """One column per class with the sum of `value`; an absent class is 0, or NULL if in `nullable`.

    Conditional sums in a single aggregate: one shuffle, with partial sums made
    before it.
    """
    sums = []
    for name, column in classes.items():
        total = F.sum(F.when(F.col(class_column) == name, F.col(value)))
        sums.append((total if name in nullable else F.coalesce(total, F.lit(0.0))).alias(column))
    return df.groupBy(*keys).agg(*sums)


def cells_to_columns(
    df: DataFrame,
    keys: Sequence[str],
    name_column: str,
    value: Column,
    names: Mapping[str, str],
    order: Sequence[str] = (),
) -> DataFrame:
    """One column per name holding its non-NULL value.

    With several values in a cell the smallest by `order`, then the smallest
    value, is taken: a choice that does not depend on row order.
    """
    cells = df.withColumn("_cell", value)
    rank = F.struct(*order, "_cell")
    picks = [
        F.min_by(
            "_cell", F.when((F.col(name_column) == name) & F.col("_cell").isNotNull(), rank)
        ).alias(column)
        for name, column in names.items()
    ]
    return cells.groupBy(*keys).agg(*picks)


def to_long(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per key and column."""
    return df.unpivot(list(keys), list(columns), name, value)


def project_known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of `columns` that exist, in the order given."""
    return df.select(*[c for c in columns if c in df.columns])


def with_missing_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns that do not exist, with their default."""
    return df.withColumns({c: default for c, default in defaults.items() if c not in df.columns})


def keys_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[c for c in df.columns if c not in keys])


def harmonised(df: DataFrame, aliases: Mapping[str, Sequence[str]], types: Mapping[str, str]) -> DataFrame:
    """Standard columns from whichever alias the table has; NULL where it has none."""
    columns = []
    for name, options in aliases.items():
        present = [F.col(o) for o in options if o in df.columns]
        value = F.coalesce(*present) if present else F.lit(None)
        columns.append(value.cast(types[name]).alias(name))
    return df.select(*columns)
