"""Correlations and distribution statistics that survive constant columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.functions.text import as_column


def correlation(left: Column | str, right: Column | str) -> Column:
    """Pearson correlation over rows with both values; NULL for a constant side.

    Written from covariance and deviations because corr raises on a constant
    column when ANSI arithmetic is on.
    """
    x, y = as_column(left).cast("double"), as_column(right).cast("double")
    x_pair, y_pair = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(
        F.covar_pop(x_pair, y_pair), F.stddev_pop(x_pair) * F.stddev_pop(y_pair)
    )


def correlations_with(
    df: DataFrame, target: str, columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """Correlation of each column with the target in long form: one aggregate, one row per column."""
    present = [c for c in columns if c in df.columns]
    row = df.agg(*[correlation(c, target).alias(c) for c in present])
    return row.unpivot([], present, name, value)


def by_absolute(column: str) -> list[Column]:
    """Sort order: largest absolute value first, NULL last."""
    return [F.abs(F.col(column)).desc_nulls_last()]
