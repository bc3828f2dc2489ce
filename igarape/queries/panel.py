"""The analysis products on the nation x year panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.constants import IMPUTED_COLUMNS, PRIORITY_EDGES, PRIORITY_LABELS, PRIORITY_PANEL_COLUMNS, SCORE_WEIGHTS
from igarape.functions.numeric import goal_status, guarded_ratio, right_closed_label
from igarape.operators.impute import fill_group_then_global_median
from igarape.operators.medians import exact_medians
from igarape.operators.scale import repair_columns
from igarape.plans import analysis
from igarape.queries import facts
from igarape.queries.registry import query, rounded, table
from igarape.session import cut_lineage

_GROUP_FILL = ", ".join(f"coalesce(g.{c}, m.{c}) AS {c}" for c in IMPUTED_COLUMNS)
_GLOBAL_FILL = ", ".join(f"coalesce(f.{c}, (SELECT {c} FROM overall)) AS {c}" for c in IMPUTED_COLUMNS)
_MEDIANS = ", ".join(f"median({c}) AS {c}" for c in IMPUTED_COLUMNS)
_PERCENTS = ["idx_atend_agua_total", "idx_tratamento_esgoto", "idx_coleta_esgoto", "pct_conformes_global"]
_CLIPS = ", ".join(
    f"CASE WHEN {c} < 0 THEN 0.0 WHEN {c} > 100 THEN 100.0 ELSE {c} END AS {c}" for c in _PERCENTS
)


def _deficit(column: str, name: str) -> str:
    return f"CASE WHEN 100 - {column} < 0 THEN 0.0 WHEN 100 - {column} > 100 THEN 100.0 ELSE 100 - {column} END AS {name}"


_SCALED = " + ".join(
    f"{w} * (SELECT CASE WHEN max({c}) - min({c}) <= 1e-8 THEN 0.0 ELSE (d.{c} - min({c})) / (max({c}) - min({c})) END FROM derived)"
    for c, w in SCORE_WEIGHTS.items()
)

ANALYSIS_SQL = f"""{facts.PANEL_SQL},
med AS (SELECT cod_mun, {_MEDIANS} FROM gold GROUP BY 1),
grouped AS (SELECT g.* REPLACE ({_GROUP_FILL}) FROM gold g JOIN med m ON g.cod_mun = m.cod_mun),
overall AS (SELECT {_MEDIANS} FROM grouped),
filled AS (SELECT f.* REPLACE ({_GLOBAL_FILL}) FROM grouped f),
clipped AS (SELECT * REPLACE ({_CLIPS}) FROM filled),
derived AS (
  SELECT *, {_deficit('idx_atend_agua_total', 'deficit_atendimento')},
    {_deficit('idx_tratamento_esgoto', 'deficit_tratamento')},
    {_deficit('pct_conformes_global', 'alerta_qualidade')},
    CASE WHEN idx_perdas_distribuicao < 0 THEN 0.0 ELSE idx_perdas_distribuicao END AS perdas_excesso,
    lag(chuva_total_mm) OVER (PARTITION BY cod_mun ORDER BY ano) AS chuva_total_mm_lag1
  FROM clipped),
scores AS (SELECT d.*, {_SCALED} AS score_priorizacao FROM derived d),
ana AS (
  SELECT *, CASE WHEN score_priorizacao <= 0.33 THEN 'Estável' WHEN score_priorizacao <= 0.66 THEN 'Atenção'
    WHEN score_priorizacao IS NOT NULL THEN 'Crítico' END AS prioridade_categoria FROM scores)
"""


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    """The panel as a written table: the analysis reads it several times, the facts only once."""
    return cut_lineage(facts.panel(spark, folder))


def _analysis(spark: SparkSession, folder: str) -> DataFrame:
    return analysis.analysis_table(_panel(spark, folder), facts.nations(spark, folder))


def _rounded_sql(columns: list[str], doubles: list[str], source: str, digits: int = 6) -> str:
    chosen = ", ".join(f"round({c}, {digits}) AS {c}" if c in doubles else c for c in columns)
    return f"SELECT {chosen} FROM {source}"


@query(
    "impute_median",
    f"WITH {ANALYSIS_SQL} {_rounded_sql(['cod_mun', 'ano', *IMPUTED_COLUMNS], IMPUTED_COLUMNS, 'filled')}",
)
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    filled = fill_group_then_global_median(_panel(spark, folder), ["cod_mun"], IMPUTED_COLUMNS)
    return rounded(filled.select("cod_mun", "ano", *IMPUTED_COLUMNS))


_ROW_FILL_SQL = """WITH readings AS (
  SELECT event_id, event_type, CASE WHEN event_type <> 'error' AND value >= 20 THEN value END AS leitura,
         CASE WHEN value < 100 THEN floor(value) END AS faixa FROM events),
med AS (SELECT event_type, median(leitura) AS l, median(faixa) AS f FROM readings GROUP BY 1),
grouped AS (SELECT event_id, coalesce(leitura, l) AS leitura, coalesce(faixa, f) AS faixa FROM readings JOIN med USING (event_type))
"""


@query(
    "impute_median_rows",
    f"""{_ROW_FILL_SQL} SELECT event_id, round(coalesce(leitura, (SELECT median(leitura) FROM grouped)), 6) AS leitura,
      round(coalesce(faixa, (SELECT median(faixa) FROM grouped)), 6) AS faixa FROM grouped""",
)
def impute_median_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same fill on raw rows, where a group has no size limit."""
    value = F.col("value")
    readings = table(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.when((F.col("event_type") != "error") & (value >= 20), value).alias("leitura"),
        F.when(value < 100, F.floor(value).cast("double")).alias("faixa"),
    )
    filled = fill_group_then_global_median(readings, ["event_type"], ["leitura", "faixa"], key_grain=False)
    return rounded(filled.select("event_id", "leitura", "faixa"))


@query(
    "group_medians",
    """SELECT user_id, round(median(value), 6) AS value, round(median(CASE WHEN value < 3 THEN 0 ELSE floor(value / 10) END), 6) AS classe
    FROM events GROUP BY 1""",
)
def group_medians(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    readings = table(spark, folder, "events").select(
        "user_id", "value", F.when(value < 3, 0.0).otherwise(F.floor(value / 10).cast("double")).alias("classe")
    )
    return rounded(exact_medians(readings, ["user_id"], ["value", "classe"]))


_DEFICITS = ["deficit_atendimento", "deficit_tratamento", "alerta_qualidade", "perdas_excesso"]


@query(
    "clip_deficits",
    f"WITH {ANALYSIS_SQL} {_rounded_sql(['cod_mun', 'ano', *_PERCENTS, *_DEFICITS], _PERCENTS + _DEFICITS, 'ana')}",
)
def clip_deficits(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_analysis(spark, folder).select("cod_mun", "ano", *_PERCENTS, *_DEFICITS))


@query(
    "minmax_score",
    f"WITH {ANALYSIS_SQL} SELECT cod_mun, ano, round(score_priorizacao, 6) AS score_priorizacao FROM ana",
)
def minmax_score(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_analysis(spark, folder).select("cod_mun", "ano", "score_priorizacao"))


@query(
    "priority_bins",
    """SELECT p_partkey,
      CASE WHEN p_size / 100 <= 0.33::DOUBLE THEN 'Estável' WHEN p_size / 100 <= 0.66::DOUBLE THEN 'Atenção' ELSE 'Crítico' END
        AS por_centesimo,
      CASE WHEN p_size / 50 <= 0.33::DOUBLE THEN 'Estável' WHEN p_size / 50 <= 0.66::DOUBLE THEN 'Atenção' ELSE 'Crítico' END
        AS por_cinquenta
    FROM part""",
)
def priority_bins(spark: SparkSession, folder: str) -> DataFrame:
    def label(divisor: int):
        return right_closed_label(F.col("p_size") / divisor, PRIORITY_EDGES, PRIORITY_LABELS)

    return table(spark, folder, "part").select(
        "p_partkey", label(100).alias("por_centesimo"), label(50).alias("por_cinquenta")
    )


@query(
    "lag_by_group",
    f"WITH {ANALYSIS_SQL} SELECT cod_mun, ano, chuva_total_mm, chuva_total_mm_lag1 FROM ana",
)
def lag_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return _analysis(spark, folder).select("cod_mun", "ano", "chuva_total_mm", "chuva_total_mm_lag1")


_PANEL_DOUBLES = [
    c for c in PRIORITY_PANEL_COLUMNS
    if c not in ("cod_mun", "municipio", "ano", "internacoes_hidricas", "prioridade_categoria")
]


@query(
    "priority_panel",
    f"WITH {ANALYSIS_SQL} {_rounded_sql(PRIORITY_PANEL_COLUMNS, _PANEL_DOUBLES, 'ana')}",
)
def priority_panel(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(analysis.priority_panel(_analysis(spark, folder)))


_CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{c}' AS indicador, round(CASE WHEN stddev_pop({c}) > 0 THEN corr({c}, internacoes_hidricas_10k) END, 6) "
    "AS correlacao_com_taxa FROM ana"
    for c in [
        "idx_atend_agua_total", "idx_tratamento_esgoto", "idx_coleta_esgoto", "idx_perdas_distribuicao",
        "pct_conformes_global", "chuva_total_mm", "despesa_saude_pc", "pct_despesa_investimentos_saude",
    ]
)


@query("driver_correlations", f"WITH {ANALYSIS_SQL} {_CORRELATIONS}")
def driver_correlations(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(analysis.driver_correlations(_analysis(spark, folder)))


@query(
    "lag_correlation",
    f"""WITH {ANALYSIS_SQL} SELECT round(corr(internacoes_hidricas_10k, chuva_total_mm_lag1), 6) AS correlacao_chuva_lag1
    FROM ana WHERE chuva_total_mm_lag1 IS NOT NULL""",
)
def lag_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(analysis.lag_correlation(_analysis(spark, folder)))


@query(
    "group_return_profile",
    f"""WITH {ANALYSIS_SQL}
    SELECT municipio, round(avg(internacoes_hidricas_10k), 6) AS taxa_media,
      round(avg(pct_despesa_investimentos_saude), 6) AS investimento_medio,
      round(avg(idx_atend_agua_total), 6) AS cobertura_agua_media,
      round(avg(idx_tratamento_esgoto), 6) AS tratamento_esgoto_medio,
      round(CASE WHEN stddev_pop(pct_despesa_investimentos_saude) > 0 AND stddev_pop(internacoes_hidricas_10k) > 0
        THEN corr(pct_despesa_investimentos_saude, internacoes_hidricas_10k) END, 6) AS elasticidade_inv_taxa
    FROM ana GROUP BY 1""",
)
def group_return_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(analysis.group_return(_analysis(spark, folder)))


_RANKING_DOUBLES = [
    "internacoes_hidricas_10k", "idx_atend_agua_total", "idx_tratamento_esgoto", "pct_conformes_global",
    "perdas_excesso", "score_priorizacao",
]


@query(
    "latest_year_ranking",
    f"""WITH {ANALYSIS_SQL}
    {_rounded_sql(['municipio', 'ano', *_RANKING_DOUBLES, 'prioridade_categoria'], _RANKING_DOUBLES, 'ana')}
    WHERE ano = (SELECT max(ano) FROM ana)""",
)
def latest_year_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(analysis.latest_ranking(_analysis(spark, folder)))


@query(
    "goals_tracker",
    f"""WITH {ANALYSIS_SQL},
    years AS (
      SELECT ano, sum(populacao) AS populacao_total,
        CAST(sum(internacoes_hidricas) AS BIGINT) AS internacoes_hidricas_total,
        CAST(sum(internacoes_total) AS BIGINT) AS internacoes_total,
        avg(idx_atend_agua_total) AS idx_atend_agua_total_media,
        avg(idx_tratamento_esgoto) AS idx_tratamento_esgoto_media,
        avg(pct_conformes_global) AS pct_conformes_global_media,
        avg(pct_despesa_investimentos_saude) AS pct_despesa_investimentos_media,
        avg(chuva_total_mm) AS chuva_total_mm_media,
        sum(internacoes_hidricas) / sum(populacao) * 10000 AS taxa_hidricas_10k_rmb
      FROM ana GROUP BY 1)
    SELECT ano, populacao_total, internacoes_hidricas_total, internacoes_total,
      round(idx_atend_agua_total_media, 6) AS idx_atend_agua_total_media,
      round(idx_tratamento_esgoto_media, 6) AS idx_tratamento_esgoto_media,
      round(pct_conformes_global_media, 6) AS pct_conformes_global_media,
      round(pct_despesa_investimentos_media, 6) AS pct_despesa_investimentos_media,
      round(chuva_total_mm_media, 6) AS chuva_total_mm_media,
      round(taxa_hidricas_10k_rmb, 6) AS taxa_hidricas_10k_rmb,
      CASE WHEN taxa_hidricas_10k_rmb IS NULL THEN 'Sem dado' WHEN taxa_hidricas_10k_rmb <= 30 THEN 'OK' ELSE 'Alerta' END
        AS status_taxa_hidricas_10k_rmb,
      CASE WHEN pct_conformes_global_media IS NULL THEN 'Sem dado' WHEN pct_conformes_global_media >= 95 THEN 'OK' ELSE 'Alerta' END
        AS status_pct_conformes_global_media,
      CASE WHEN idx_atend_agua_total_media IS NULL THEN 'Sem dado' WHEN idx_atend_agua_total_media >= 95 THEN 'OK' ELSE 'Alerta' END
        AS status_idx_atend_agua_total_media,
      CASE WHEN idx_tratamento_esgoto_media IS NULL THEN 'Sem dado' WHEN idx_tratamento_esgoto_media >= 80 THEN 'OK' ELSE 'Alerta' END
        AS status_idx_tratamento_esgoto_media
    FROM years""",
)
def goals_tracker(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(analysis.goals_tracker(_analysis(spark, folder)))


@query(
    "goal_statuses",
    """SELECT s_suppkey,
      CASE WHEN s_acctbal < 0 THEN 'Sem dado' WHEN s_acctbal <= 5000 THEN 'OK' ELSE 'Alerta' END AS status_maximo,
      CASE WHEN s_acctbal < 0 THEN 'Sem dado' WHEN s_acctbal >= 5000 THEN 'OK' ELSE 'Alerta' END AS status_minimo
    FROM supplier""",
)
def goal_statuses(spark: SparkSession, folder: str) -> DataFrame:
    known = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal"))
    return table(spark, folder, "supplier").select(
        "s_suppkey",
        goal_status(known, "max", 5000.0).alias("status_maximo"),
        goal_status(known, "min", 5000.0).alias("status_minimo"),
    )


@query(
    "safe_ratios",
    f"""WITH {facts.DIM_SQL}, {facts.ADMISSIONS_SQL}
    SELECT cod_mun, ano,
      round(CASE WHEN internacoes_total > 0 THEN valor_total / internacoes_total END, 6) AS valor_medio,
      round(CASE WHEN internacoes_total > 0 THEN internacoes_hidricas / internacoes_total * 100 END, 6) AS pct_hidricas,
      round(CASE WHEN internacoes_hidricas - 35 > 0 THEN internacoes_total / (internacoes_hidricas - 35) END, 6) AS por_excesso
    FROM adm""",
)
def safe_ratios(spark: SparkSession, folder: str) -> DataFrame:
    ratios = facts.admissions(spark, folder).select(
        "cod_mun",
        "ano",
        guarded_ratio("valor_total", "internacoes_total").alias("valor_medio"),
        guarded_ratio("internacoes_hidricas", "internacoes_total", 100.0).alias("pct_hidricas"),
        guarded_ratio("internacoes_total", F.col("internacoes_hidricas") - 35).alias("por_excesso"),
    )
    return rounded(ratios)


@query(
    "scale_repair",
    """SELECT s_suppkey, round(CASE WHEN s_acctbal > 100 THEN s_acctbal / 100 ELSE s_acctbal END, 6) AS idx_coleta_esgoto,
      round(CASE WHEN s_acctbal > 1000 THEN s_acctbal / 100 ELSE s_acctbal END, 6) AS idx_perdas_lineares FROM supplier""",
)
def scale_repair(spark: SparkSession, folder: str) -> DataFrame:
    figures = table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("idx_coleta_esgoto"), F.col("s_acctbal").alias("idx_perdas_lineares")
    )
    percents = repair_columns(figures, ["idx_coleta_esgoto", "idx_hidrometracao"], 100.0)
    return rounded(repair_columns(percents, ["idx_perdas_lineares"], 1000.0))
