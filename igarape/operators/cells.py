"""Searches in long cell tables and in lines of text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lines_after(df: DataFrame, keys: Sequence[str], text: str, skip: int) -> DataFrame:
    """(keys, line_no, line) for the lines after the first `skip`; numbers start at 0."""
    lines = df.select(*keys, F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
    return lines.filter(F.col("line_no") >= skip)


def first_matching_row(
    cells: DataFrame, keys: Sequence[str], row: str, tests: Sequence[Column], into: str
) -> DataFrame:
    """(keys, into): the first row in which every test holds for some cell."""
    flags = {f"_test_{i}": F.bool_or(t) for i, t in enumerate(tests)}
    rows = cells.groupBy(*keys, row).agg(*[f.alias(n) for n, f in flags.items()])
    for name in flags:
        rows = rows.filter(F.col(name))
    return rows.groupBy(*keys).agg(F.min(row).alias(into))


def column_per_role(
    names: DataFrame, keys: Sequence[str], position: str, places: Mapping[str, Column]
) -> DataFrame:
    """(keys, role, position): the column serving each role.

    `places` gives, per role, the rank of a column's label among the role's
    labels, 0 or NULL if it does not fit; the lowest rank wins, then the first
    column. A column may serve several roles.
    """
    candidates = F.array(
        *[F.struct(F.lit(r).alias("role"), p.cast("long").alias("place")) for r, p in places.items()]
    )
    hits = names.select(*keys, position, F.inline(candidates)).filter(F.col("place") > 0)
    best = F.min_by(position, F.struct("place", position)).alias(position)
    return hits.groupBy(*keys, "role").agg(best)
