"""Parquet tables and CSV exports, one target at a time. Jobs with several targets use `Replacement` itself."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.sinks.replace import Replacement, read_target

__all__ = [
    "export_csv",
    "generation_time",
    "read_target",
    "replace_table",
    "replace_touched_partitions",
    "replace_with_csv_twin",
    "stamped",
    "with_csv_twin",
]


def replace_touched_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace only the partitions present in `df`; all others stay."""
    with Replacement(df.sparkSession) as targets:
        targets.partitions(df, path, keys)


def replace_table(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Replace the whole target."""
    with Replacement(df.sparkSession) as targets:
        targets.table(df, path, keys)


def export_csv(df: DataFrame, path: str, order: Sequence[str] = (), may_be_empty: bool = False) -> None:
    """CSV folder with headers; a small table ends up in one file by adaptive coalescing.

    With `order`, file after file is sorted by these columns.
    """
    with Replacement(df.sparkSession) as targets:
        targets.csv(df, path, order, may_be_empty)


def with_csv_twin(
    targets: Replacement, df: DataFrame, parquet_path: str, csv_path: str, order: Sequence[str] = (), unique: Sequence[str] = (), what: str = ""
) -> DataFrame:
    """Parquet and, from the rows written, its CSV twin, so `df` is computed once.

    Files are read back in any order, so the twin is sorted anew.
    """
    written = targets.table(df, parquet_path, order=order, unique=unique, what=what)
    targets.csv(written, csv_path, order)
    return written


def replace_with_csv_twin(
    df: DataFrame, parquet_path: str, csv_path: str, order: Sequence[str] = ()
) -> DataFrame:
    """A table and its CSV twin, replaced together."""
    with Replacement(df.sparkSession) as targets:
        with_csv_twin(targets, df, parquet_path, csv_path, order)
    return read_target(df.sparkSession, parquet_path)


def generation_time() -> str:
    """The present UTC time as ISO text; taken once and shared by all tables of a run."""
    return datetime.now(timezone.utc).isoformat()


def stamped(df: DataFrame, generated_at: str) -> DataFrame:
    return df.withColumn("gerado_em", F.lit(generated_at))
