"""Best rows, counters and other order-dependent results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from igarape.session import cut_lineage

# Rows of one key that a single task may number, if the order column is unique.
_BLOCK = 1 << 20


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that comes first in `order`.

    An aggregate, not a window: every task keeps one candidate per key before the
    shuffle, so a key with many rows costs no more than others. Each `order`
    expression sorts ascending; negate a number to prefer the largest.
    """
    rest = [c for c in df.columns if c not in keys]
    # Structs compare field by field, NULL first; the flag puts NULL last.
    fields = [F.struct(o.isNull(), o) for o in order]
    best = F.min_by(F.struct(*rest), F.struct(*fields)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def with_place(df: DataFrame, order: Sequence[Column], into: str) -> DataFrame:
    """Number the rows from 0 in the given order, which should be unique. Runs `df` at once.

    Rows are range-partitioned and sorted, and written with their place within the
    partition; the sizes of the partitions before it, one number each, complete it.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = cut_lineage(ordered.withColumn(into, F.monotonically_increasing_id()), "ordered")
    part, inside = F.shiftright(into, 33), F.col(into).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = written.groupBy(part.alias("part")).count().collect()
    before, total = {}, 0
    for number, size in sorted((row["part"], row["count"]) for row in sizes):
        before[number] = total
        total += size
    shift = F.try_element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), part) if before else F.lit(0)
    return written.withColumn(into, (inside + shift).cast("long"))


def occurrence_number(
    df: DataFrame, keys: Sequence[str], order: str, into: str, block: int = _BLOCK
) -> DataFrame:
    """0 for the first row of a key by `order`, 1 for the second, and so on.

    `order` is a unique whole number. A key's rows are cut into blocks of the
    order column; rows are numbered within a block and shifted by the sizes of
    the blocks before it. A block holds at most `block` rows, however frequent
    its key is.
    """
    cut = df.withColumn("_block", F.floor(F.col(order) / block))
    sizes = cut.groupBy(*keys, "_block").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = sizes.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_block").alias("_shift_block"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"),
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    numbered = cut.withColumn("_inside", F.row_number().over(inside) - 1)
    same = F.col("_block") == F.col("_shift_block")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return numbered.join(shifts, same).select(
        *df.columns, (F.col("_inside") + F.col("_shift")).cast("long").alias(into)
    )


def previous_by_key(column: str, keys: Sequence[str], order: str) -> Column:
    """Value of the key's row before; for tables with one row per key and order value."""
    return F.lag(column, 1).over(Window.partitionBy(*keys).orderBy(order))
