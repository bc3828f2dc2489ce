"""Analysis products built on the gold table: panel, drivers, ranking, return and goals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.constants import (
    CLIPPED_PERCENT_COLUMNS,
    DRIVER_COLUMNS,
    EXPECTED_YEARS,
    FALLBACK_COLUMNS,
    GOALS,
    IMPUTED_COLUMNS,
    PRIORITY_EDGES,
    PRIORITY_LABELS,
    PRIORITY_PANEL_COLUMNS,
    RANKING_COLUMNS,
    SCORE_WEIGHTS,
    TARGET,
)
from igarape.functions.numeric import clip, goal_status, right_closed_label, weighted_sum
from igarape.operators.grid import coverage, missing_keys
from igarape.operators.impute import fill_group_then_global_median
from igarape.operators.lookup import fallback_columns, lookup_or_own
from igarape.operators.ordering import previous_by_key
from igarape.operators.scale import with_minmax
from igarape.operators.statistics import by_absolute, correlation, correlations_with


def coverage_by_year(gold: DataFrame, dimension: DataFrame) -> DataFrame:
    return coverage(gold, dimension, "ano", "cod_mun").orderBy("ano")


def missing_pairs(
    gold: DataFrame, dimension: DataFrame, years: tuple[int, int] = EXPECTED_YEARS
) -> DataFrame:
    """Expected (municipality, year) pairs that the gold table lacks."""
    expected = dimension.select(
        "cod_mun",
        F.upper("name").alias("municipio"),
        F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))).alias("ano"),
    )
    return missing_keys(expected, gold, ["cod_mun", "ano"]).orderBy("ano", "municipio")


def scored(
    df: DataFrame,
    weights: Mapping[str, float] = SCORE_WEIGHTS,
    edges: Sequence[float] = tuple(PRIORITY_EDGES),
    labels: Sequence[str] = tuple(PRIORITY_LABELS),
) -> DataFrame:
    """Weighted score of min-max scaled columns, and its category."""
    scaled = with_minmax(df, list(weights), "_scaled_")
    score = weighted_sum(dict(weights), lambda c: F.col(f"_scaled_{c}"))
    category = right_closed_label("score_priorizacao", list(edges), list(labels))
    return (
        scaled.withColumn("score_priorizacao", score)
        .withColumn("prioridade_categoria", category)
        .drop(*[f"_scaled_{c}" for c in weights])
    )


def analysis_table(
    gold: DataFrame, dimension: DataFrame, service: DataFrame | None = None
) -> DataFrame:
    """Gold with fallbacks, imputation, limits, deficits, lagged rain, score and category."""
    table = gold
    if service is not None:
        table = fallback_columns(table, service, ["cod_mun", "ano"], FALLBACK_COLUMNS)
    names = dimension.select("cod_mun", F.upper("name").alias("nome"))
    named = lookup_or_own(table, names, ["cod_mun"], "municipio", "nome")
    upper = named.withColumn("municipio", F.upper("municipio"))
    filled = fill_group_then_global_median(upper, ["cod_mun"], IMPUTED_COLUMNS)
    limited = filled.withColumns({c: clip(c, 0.0, 100.0) for c in CLIPPED_PERCENT_COLUMNS})
    derived = limited.withColumns(
        {
            "deficit_atendimento": clip(100 - F.col("idx_atend_agua_total"), 0.0, 100.0),
            "deficit_tratamento": clip(100 - F.col("idx_tratamento_esgoto"), 0.0, 100.0),
            "alerta_qualidade": clip(100 - F.col("pct_conformes_global"), 0.0, 100.0),
            "perdas_excesso": clip("idx_perdas_distribuicao", 0.0),
            "chuva_total_mm_lag1": previous_by_key("chuva_total_mm", ["cod_mun"], "ano"),
        }
    )
    return scored(derived)


def driver_correlations(analysis: DataFrame) -> DataFrame:
    """Correlation of each driver with the rate, strongest first."""
    table = correlations_with(analysis, TARGET, DRIVER_COLUMNS, "indicador", "correlacao_com_taxa")
    return table.orderBy(*by_absolute("correlacao_com_taxa"), "indicador")


def lag_correlation(analysis: DataFrame) -> DataFrame:
    return analysis.agg(correlation(TARGET, "chuva_total_mm_lag1").alias("correlacao_chuva_lag1"))


def latest_ranking(analysis: DataFrame) -> DataFrame:
    """Rows of the latest year by score; ties by name."""
    latest = analysis.agg(F.max("ano")).scalar()
    return (
        analysis.filter(F.col("ano") == latest)
        .select(*RANKING_COLUMNS)
        .orderBy(F.desc_nulls_last("score_priorizacao"), "municipio")
    )


def group_return(analysis: DataFrame) -> DataFrame:
    """Mean figures per municipality and the correlation of investment with the rate."""
    return (
        analysis.groupBy("municipio")
        .agg(
            F.avg(TARGET).alias("taxa_media"),
            F.avg("pct_despesa_investimentos_saude").alias("investimento_medio"),
            F.avg("idx_atend_agua_total").alias("cobertura_agua_media"),
            F.avg("idx_tratamento_esgoto").alias("tratamento_esgoto_medio"),
            correlation("pct_despesa_investimentos_saude", TARGET).alias("elasticidade_inv_taxa"),
        )
        .orderBy(F.desc_nulls_last("taxa_media"), "municipio")
    )


def with_goal_status(df: DataFrame, goals: Mapping[str, tuple[str, float]]) -> DataFrame:
    return df.withColumns(
        {f"status_{c}": goal_status(c, kind, goal) for c, (kind, goal) in goals.items()}
    )


def goals_tracker(analysis: DataFrame) -> DataFrame:
    """Totals, means, overall rate and goal status per year."""

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    years = analysis.groupBy("ano").agg(
        total("populacao").alias("populacao_total"),
        total("internacoes_hidricas").alias("internacoes_hidricas_total"),
        total("internacoes_total").alias("internacoes_total"),
        F.avg("idx_atend_agua_total").alias("idx_atend_agua_total_media"),
        F.avg("idx_tratamento_esgoto").alias("idx_tratamento_esgoto_media"),
        F.avg("pct_conformes_global").alias("pct_conformes_global_media"),
        F.avg("pct_despesa_investimentos_saude").alias("pct_despesa_investimentos_media"),
        F.avg("chuva_total_mm").alias("chuva_total_mm_media"),
    )
    rate = F.try_divide("internacoes_hidricas_total", "populacao_total") * 10000
    return with_goal_status(years.withColumn("taxa_hidricas_10k_rmb", rate), GOALS).orderBy("ano")


def priority_panel(analysis: DataFrame) -> DataFrame:
    """The exported panel, newest year and highest score first."""
    return analysis.select(*PRIORITY_PANEL_COLUMNS).orderBy(
        F.desc("ano"), F.desc_nulls_last("score_priorizacao"), "cod_mun"
    )
