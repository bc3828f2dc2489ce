"""Lookups against the municipality dimension and other small tables.

No join here carries a broadcast hint: Spark broadcasts a side whose size it
knows to be under spark.sql.autoBroadcastJoinThreshold (the dimension always is)
and otherwise shuffles, with adaptive execution splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.functions.text import digits_only, zero_fill
from igarape.operators.hot_join import join_unsummed
from igarape.session import cut_lineage_observed, lasting_path
from igarape.sinks.replace import Replacement
from igarape.sources.delimited import SOURCE_FILE


def either_key(dimension: DataFrame) -> DataFrame:
    """Two rows per municipality, one per accepted key: the 7-digit code and its first 6 digits."""
    keys = F.array("cod_mun", F.left("cod_mun", F.lit(6)))
    return dimension.select(F.explode(keys).alias("lookup_code"), "*")


def with_canonical_code(
    df: DataFrame, dimension: DataFrame, code: str, into: str = "cod_mun", keep_unmatched: bool = False
) -> DataFrame:
    """Replace a dirty code by the dimension's 7-digit code.

    Tried in order: all digits, the first 7, the first 6, the digits zero-filled
    to 7. Since every key has 6 or 7 digits, this is one look-up by 7-digit key
    and one by 6-digit key. Rows without a match are dropped unless kept as NULL.
    """
    digits = digits_only(F.trim(F.col(code).cast("string")))
    long_key = F.nullif(zero_fill(F.left(digits, F.lit(7)), 7), F.lit("0000000"))
    short_key = F.when(F.length(digits) >= 6, F.left(digits, F.lit(6)))
    by_long = dimension.select(F.col("cod_mun").alias("_long"))
    by_short = dimension.groupBy(F.left("cod_mun", F.lit(6)).alias("_short_key")).agg(
        F.max("cod_mun").alias("_short")
    )
    keyed = df.withColumns(
        {"_long_key": long_key, "_short_key": short_key, "_six": F.length(digits) == 6}
    )
    found = keyed.join(by_long, F.col("_long_key") == F.col("_long"), "left").join(
        by_short, "_short_key", "left"
    )
    canonical = F.when(F.col("_six"), F.coalesce("_short", "_long")).otherwise(
        F.coalesce("_long", "_short")
    )
    names = [c for c in df.columns if c not in (code, into)]
    result = found.select(canonical.alias(into), *names)
    return result if keep_unmatched else result.filter(F.col(into).isNotNull())


def lookup_or_own(
    df: DataFrame, table: DataFrame, keys: Sequence[str], column: str, found: str
) -> DataFrame:
    """Left look-up of `found`; where there is none, `column` keeps its own value."""
    joined = df.join(table.select(*keys, F.col(found).alias("_found")), list(keys), "left")
    return joined.withColumn(column, F.coalesce("_found", column)).drop("_found")


def fallback_columns(
    df: DataFrame, second: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Fill NULLs of `columns` from the same columns of `second`, matched by key."""
    shared = [c for c in columns if c in second.columns]
    other = second.select(*keys, *[F.col(c).alias(f"_second_{c}") for c in shared])
    joined = df.join(other, list(keys), "left")
    filled = {
        c: F.coalesce(c, f"_second_{c}") if c in df.columns else F.col(f"_second_{c}")
        for c in shared
    }
    return joined.withColumns(filled).drop(*[f"_second_{c}" for c in shared])


def require_all_found(df: DataFrame, dimension: DataFrame, key: str, report: str | None = None) -> None:
    """Raise if `df` has codes that the dimension lacks; they are all in the table `report`, which stays.

    It has a row per code with the number of rows and, where `df` tells it, the first source file.
    Without `report` the table lies in the shared folder, beside the one that goes with the application.
    The message names the folder and the first codes.
    """
    source = [F.min(SOURCE_FILE).alias(SOURCE_FILE)] if SOURCE_FILE in df.columns else []
    codes = df.groupBy(key).agg(F.count("*").alias("rows"), *source)
    missing, seen = cut_lineage_observed(
        codes.join(dimension.select(key), key, "left_anti"), "codes-without-municipality", n=F.count(F.lit(1))
    )
    if seen["n"]:
        path = report or lasting_path(df.sparkSession, "codes-without-municipality")
        with Replacement(df.sparkSession) as targets:
            targets.table(missing, path, order=[key])
        first = ", ".join(str(row[0]) for row in missing.orderBy(key).limit(20).collect())
        raise ValueError(f"{seen['n']} codes without a municipality, all in {path}: {first}")


def fan_out(df: DataFrame, bridge: DataFrame, key: str) -> DataFrame:
    """Repeat each row for every target of its key; keys without a target drop out."""
    return df.join(bridge, key)


def keep_members(df: DataFrame, members: DataFrame, on: str | list[str] | Column) -> DataFrame:
    """Rows whose key occurs in `members`."""
    return df.join(members, on, "left_semi")


def keep_members_unsummed(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """The same for rows that are many and of which one key may have a large share."""
    return join_unsummed(df, members.select(key), key, "left_semi")
