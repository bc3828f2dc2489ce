"""Gold features: the full municipality x year grid with all sources joined."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.functions.numeric import guarded_ratio, nan_to_null
from igarape.operators.grid import key_grid
from igarape.operators.reshape import keys_first
from igarape.session import cut_lineage_observed


def joined_on_grid(
    dimension: DataFrame, sources: Sequence[DataFrame], key: str = "cod_mun", period: str = "ano"
) -> DataFrame:
    """Grid of all dimension rows and all periods of any source, with the columns of every source.

    Each source has one row per (key, period); two of them are an error, since
    merging them would make a row that never existed. Instead of a chain of joins
    the sources are stacked and merged by one aggregate, in which max only picks
    the single value. NaN counts as NULL. The result, as small as the grid, is written once, since
    the grid's periods are those that the write has seen.
    """
    numbered = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    figures = [c for c in stacked.columns if c not in (key, period, "_source")]
    floating = {name for name, kind in stacked.dtypes if kind in ("double", "float")}
    rows = [F.count_if(F.col("_source") == i) for i in range(len(sources))]
    merged = stacked.dropna(subset=[key, period]).groupBy(key, period).agg(
        *[F.max(nan_to_null(c) if c in floating else c).alias(c) for c in figures],
        F.array_max(F.array(*rows)).alias("_rows"),
    )
    text = F.concat(F.lit("a source has several rows for "), F.concat_ws(", ", key, period))
    single = merged.filter(F.when(F.col("_rows") > 1, F.raise_error(text).cast("boolean")).otherwise(True)).drop("_rows")
    written, seen = cut_lineage_observed(single, "gold", periods=F.collect_set(period))
    grid = key_grid(dimension, seen["periods"], period, written.schema[period].dataType.simpleString())
    return grid.join(written, [key, period], "left")


def gold_from_sources(dimension: DataFrame, sources: Sequence[DataFrame]) -> DataFrame:
    """One row per municipality and year with four ratios.

    Among them the sources bring populacao, internacoes_total,
    internacoes_hidricas and valor_total.
    """
    places = dimension.select("cod_mun", F.upper("name").alias("municipio"))
    wide = joined_on_grid(places, sources)
    return keys_first(wide, ["cod_mun", "municipio", "ano"]).withColumns(
        {
            "internacoes_total_10k": guarded_ratio("internacoes_total", "populacao", 10000.0),
            "internacoes_hidricas_10k": guarded_ratio("internacoes_hidricas", "populacao", 10000.0),
            "pct_internacoes_hidricas": guarded_ratio("internacoes_hidricas", "internacoes_total", 100.0),
            "valor_medio_internacao": guarded_ratio("valor_total", "internacoes_total"),
        }
    )


def gold_features(
    dimension: DataFrame,
    population: DataFrame,
    service: DataFrame,
    quality: DataFrame,
    climate: DataFrame,
    finance: DataFrame,
    admissions: DataFrame,
) -> DataFrame:
    """The gold table of the six sources, each one row per (cod_mun, ano)."""
    return gold_from_sources(dimension, [population, service, quality, climate, finance, admissions])
