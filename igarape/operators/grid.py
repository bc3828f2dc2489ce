"""Key grids, coverage and missing keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_domain(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct non-NULL values of a column over several tables.

    Each table is made distinct before the union, so only a handful of rows per
    task reaches the shuffle.
    """
    parts = [f.select(column).filter(F.col(column).isNotNull()).distinct() for f in frames]
    return reduce(DataFrame.union, parts).distinct()


def key_grid(dimension: DataFrame, domain: DataFrame | Sequence, column: str, kind: str | None = None) -> DataFrame:
    """Every dimension row with every value of the domain, a one-column table or a list of values of type `kind`.

    The domain (years) is short; it travels as one array value that each
    dimension row explodes, so there is no join.
    """
    if isinstance(domain, DataFrame):
        values = domain.agg(F.sort_array(F.collect_set(column))).scalar()
    else:
        values = F.array(*[F.lit(v) for v in sorted(domain)]).cast(f"array<{kind}>")
    return dimension.select("*", F.explode(values).alias(column))


def missing_keys(expected: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected rows whose key was not observed."""
    return expected.join(observed.select(*keys), list(keys), "left_anti")


def coverage(df: DataFrame, dimension: DataFrame, by: str, key: str) -> DataFrame:
    """Distinct keys with data per `by`, the number expected, and their ratio."""
    expected = dimension.agg(F.count_distinct(key)).scalar()
    counted = df.groupBy(by).agg(F.count_distinct(key).alias("municipios_com_dado"))
    return counted.select(
        by,
        "municipios_com_dado",
        expected.alias("municipios_esperados"),
        (F.col("municipios_com_dado") / expected).alias("percentual_cobertura"),
    )
