"""Joins of unaggregated rows to a look-up, when one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys with at least this share of the rows count as hot; there are no more of them than this.
_HOT = 1024
# Counters of the sketch: a key with a share above a few times its inverse is surely among them.
_TRACKED = 1 << 16


def hot_keys(df: DataFrame, key: Column | str, share: int = _HOT, tracked: int = _TRACKED) -> list:
    """Values of a key that hold at least 1 / `share` of the rows, found by a sketch of bounded size; none is missed.

    Some with a little less may be among them, but at most 2 * `share` values come back.
    """
    named = df.select((F.col(key) if isinstance(key, str) else key).alias("_key")).filter(F.col("_key").isNotNull())
    row = named.agg(
        F.expr(f"approx_top_k(_key, {2 * share}, {max(tracked, 4 * share)})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    return sorted(item["item"] for item in row["top"] or [] if item["count"] * share >= row["n"])


def join_unsummed(df: DataFrame, table: DataFrame, key: str, how: str = "inner", share: int = _HOT) -> DataFrame:
    """`df` joined ('inner', 'left' or 'left_semi') to `table`, which has one row per `key`.

    Rows with a hot key meet the few rows of `table` with such keys by a broadcast, at most 2 * `share`
    of them; all others are joined as Spark sees fit, and no key among them has a larger share. Nothing
    is left to adaptive execution. Rows without a key are kept apart in a left join.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"no such join here: {how}")
    spark, kind = df.sparkSession, df.schema[key].dataType
    found = hot_keys(df, key, share)
    known = df.filter(F.col(key).isNotNull())
    parts = [known]
    if found:
        values = F.broadcast(spark.createDataFrame([(x,) for x in found], T.StructType([T.StructField(key, kind)])))
        few = F.broadcast(table.join(values, key, "left_semi"))
        parts = [known.join(values, key, "left_semi").join(few, key, how), known.join(values, key, "left_anti")]
    parts[-1] = parts[-1].join(table, key, how)
    if how == "left":
        parts.append(df.filter(F.col(key).isNull()))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result
