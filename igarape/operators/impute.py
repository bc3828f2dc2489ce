"""Median imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.operators.medians import exact_medians, whole_medians
from igarape.session import cut_lineage_observed


def _builtin_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.median(c).alias(c) for c in columns])


def fill_group_then_global_median(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], key_grain: bool = True
) -> DataFrame:
    """Fill NULLs by the median of the group, then by the median of the filled column.

    All columns share one aggregate per step. The group medians form a small
    table that is joined back. The table filled by group is written once; the
    write tells which columns still have NULLs, and their global medians are one
    row, learnt from it without gathering the values.

    key_grain: the table has one row per key and period (municipality x year), so
    a group is short and the built-in median may hold it. Otherwise the medians
    are found without gathering a group.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    medians_of = _builtin_medians if key_grain else exact_medians
    medians = medians_of(df, keys, present).withColumnsRenamed({c: f"_median_{c}" for c in present})
    filled = (
        df.join(medians, list(keys), "left")
        .withColumns({c: F.coalesce(c, f"_median_{c}") for c in present})
        .select(*df.columns)
    )
    gaps = {f"gaps_{c}": F.count_if(F.col(c).isNull()) for c in present}
    written, seen = cut_lineage_observed(filled, "filled", **gaps)
    kinds = dict(df.dtypes)
    overall = whole_medians(written, [c for c in present if seen[f"gaps_{c}"]])
    known = {c: F.lit(value).cast(kinds[c]) for c, value in overall.items() if value is not None}
    return written.withColumns({c: F.coalesce(c, value) for c, value in known.items()})
