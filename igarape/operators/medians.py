"""Exact medians of groups of any size by radix selection.

A double has an order-preserving integer image of 64 bits. A pass counts, for all groups and columns
at once, the values by the next 16 bits of their image, before and after the shuffle, and finds the
cells that hold the two middle ranks; the next pass looks at these cells only. A cell with at most two
values, or equal ones, gives the value itself, so most medians take two passes and none more than four.
No task holds more of a group than 65,536 cells, and nothing but a count comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.session import cut_lineage_observed

_DIGIT = 16
# Cells with at least this share of the rows still looked at are joined by a broadcast: there are no more of them.
_HOT = 1024


def order_image(value: Column | str) -> Column:
    """A long that orders doubles as they compare, worked out without rounding; -0.0 counts as 0.0, NaN is the largest."""
    x = F.col(value) if isinstance(value, str) else value
    size = F.abs(x)

    def two(exponent: Column) -> Column:
        return F.pow(F.lit(2.0), exponent)

    guess = F.floor(F.log2(size)).cast("double")  # off by one at most
    exponent = guess + F.when(two(guess) > size, -1).when(two(guess + 1) <= size, 1).otherwise(0)
    fraction = (size / two(exponent) - 1) * F.lit(float(1 << 52))
    normal = F.shiftleft((exponent + 1023).cast("long"), 52) + fraction.cast("long")
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    image = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(F.isnan(x), F.lit((2047 << 52) + 1))
        .when(size == F.lit(float("inf")), F.lit(2047 << 52))
        .when(size < F.lit(2.0**-1022), tiny)
        .otherwise(normal)
    )
    return F.when(x < 0, -image).otherwise(image)


def _located(cells: DataFrame, group: Sequence[str], first: bool) -> DataFrame:
    """(group, _cell, _rank, _n, _low, _high): the cell of each wanted rank, and the rank within it."""
    keys = list(group) if first else [*group, "_r1", "_r2", F.shiftright("_cell", _DIGIT).alias("_prefix")]
    cell = F.struct("_cell", "_n", "_low", "_high")
    held = cells.groupBy(*keys).agg(F.sort_array(F.collect_list(cell)).alias("_cells"), F.sum("_n").alias("_total"))
    if first:
        ranks = F.array(F.expr("(_total + 1) div 2"), F.expr("_total div 2 + 1"))
    else:
        ranks = F.filter(F.array("_r1", "_r2"), lambda r: r.isNotNull())
    wanted = held.select(*group, "_cells", F.explode(ranks).alias("_rank"))
    # Goes through the cells in order; `left` is the rank among those not yet passed.
    begin = "named_struct('left', _rank, 'cell', CAST(NULL AS STRUCT<_cell: BIGINT, _n: BIGINT, _low: DOUBLE, _high: DOUBLE>))"
    step = "IF(s.cell IS NOT NULL, s, IF(s.left <= c._n, named_struct('left', s.left, 'cell', c), named_struct('left', s.left - c._n, 'cell', s.cell)))"
    found = wanted.select(*group, F.expr(f"aggregate(_cells, {begin}, (s, c) -> {step})").alias("_at"))
    return found.select(*group, F.col("_at.left").alias("_rank"), "_at.cell.*")


def _matched(values: DataFrame, state: DataFrame, group: Sequence[str], shift: int, hot: bool, rest: bool) -> DataFrame:
    """Values in a cell of `state`, with the ranks wanted there. Hot cells come by a broadcast of at most `_HOT` rows."""

    def joined(rows: DataFrame, cells: DataFrame, how: str) -> DataFrame:
        same = F.shiftright("_image", shift) == F.col("_of")
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
        named = cells.select(*[F.col(g).alias(f"_of_{g}") for g in group], F.col("_cell").alias("_of"), "_r1", "_r2")
        return rows.join(F.broadcast(named) if cells is few else named, same, how)

    few, many = state.filter("_hot"), state.filter("NOT _hot")
    columns = [*group, "_r1", "_r2", "_value", "_image"]
    parts = []
    if hot:
        parts.append(joined(values, few, "inner").select(*columns))
    if rest:
        others = joined(values, few, "left_anti") if hot else values
        parts.append(joined(others, many, "inner").select(*columns))
    return reduce(DataFrame.unionAll, parts)


def exact_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, columns): interpolated medians, NULLs ignored; without keys, one row.

    Groups without any value are left out. Reads `df` once a pass, so it should be a written table.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value")) for c in columns])
    values = df.select(*keys, F.inline(cells)).filter(F.col("_value").isNotNull()).withColumn("_image", order_image("_value"))
    group = [*keys, "_column"]
    resolved = (F.col("_n") <= 2) | F.col("_low").eqNullSafe(F.col("_high"))
    found, rows, own = [], values, []
    for shift in range(64 - _DIGIT, -1, -_DIGIT):
        counted = rows.groupBy(*group, *own, F.shiftright("_image", shift).alias("_cell")).agg(
            F.count("*").alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
        )
        located = _located(counted, group, first=not own).withColumn("_done", resolved)
        written, seen = cut_lineage_observed(located, "medians", open=F.sum(F.when(~F.col("_done"), F.col("_n"))), some=F.count_if("_done"))
        if seen["some"]:
            found.append(written.filter("_done").select(*group, F.when(F.col("_rank") == 1, F.col("_low")).otherwise(F.col("_high")).alias("_middle")))
        if not seen["open"]:
            break
        state = written.filter("NOT _done").groupBy(*group, "_cell").agg(
            F.min("_rank").alias("_r1"),
            F.when(F.count("*") > 1, F.max("_rank")).alias("_r2"),
            (F.max("_n").cast("decimal(38,0)") * _HOT >= F.lit(seen["open"]).cast("decimal(38,0)")).alias("_hot"),
        )
        state, cold = cut_lineage_observed(state, "medians", hot=F.count_if("_hot"), rest=F.count_if(~F.col("_hot")))
        own = ["_r1", "_r2"]
        rows = _matched(values, state, group, shift, cold["hot"] > 0, cold["rest"] > 0)
    middles = reduce(DataFrame.unionAll, found) if found else values.select(*group, F.col("_value").alias("_middle")).limit(0)
    medians = middles.groupBy(*group).agg((F.sum("_middle") / 2).alias("_median"))
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_column") == c, F.col("_median"))).alias(c) for c in columns]
    )


def whole_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Interpolated medians of whole columns, NULLs ignored; None for a column without values."""
    if not columns:
        return {}
    found = exact_medians(df, [], columns).first()
    return {c: found[c] for c in columns}
