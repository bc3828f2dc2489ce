"""Scaling by whole-table statistics, read as one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.functions.numeric import repair_scale
from igarape.operators.medians import whole_medians
from igarape.session import cut_lineage_observed

# A spread up to this size counts as constant.
_CONSTANT = 1e-8


def with_minmax(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    """Add (x - min) / (max - min) per column under prefix + name; a constant column gives 0.

    NULLs take the column's median first. `df` is written once, and the write
    finds the limits and the columns with NULLs; medians are only worked out for those.
    """
    df, row = cut_lineage_observed(
        df,
        "scaled",
        **{f"low_{c}": F.min(F.col(c).cast("double")) for c in columns},
        **{f"high_{c}": F.max(F.col(c).cast("double")) for c in columns},
        **{f"gaps_{c}": F.count_if(F.col(c).isNull()) for c in columns},
    )
    gaps = [c for c in columns if row[f"gaps_{c}"] and row[f"low_{c}"] is not None]
    medians = whole_medians(df, gaps) if gaps else {}
    scaled = {}
    for c in columns:
        low, high = row[f"low_{c}"], row[f"high_{c}"]
        if low is None:
            scaled[prefix + c] = F.lit(None).cast("double")
        elif abs(high - low) <= _CONSTANT:
            scaled[prefix + c] = F.lit(0.0)
        else:
            value = F.coalesce(c, F.lit(medians[c])) if c in gaps else F.col(c)
            scaled[prefix + c] = (value - F.lit(low)) / F.lit(high - low)
    return df.withColumns(scaled)


def minmax_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: name, smallest and largest value, NULLs ignored."""
    stats = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"low_{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"high_{c}") for c in columns],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("coluna"),
                F.col(f"low_{c}").alias("minimo"),
                F.col(f"high_{c}").alias("maximo"),
            )
            for c in columns
        ]
    )
    return stats.select(F.inline(rows))


def repair_columns(df: DataFrame, columns: Sequence[str], limit: float) -> DataFrame:
    """Divide values above the limit by 100 in those of `columns` that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: repair_scale(c, limit) for c in present})
