"""The gold table on the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.plans.gold import gold_from_sources
from igarape.queries import facts
from igarape.queries.registry import query, rounded

GOLD_SQL = f"""
WITH {facts.DIM_SQL}, {facts.ADMISSIONS_SQL}, {facts.SUPPLIES_SQL}, {facts.SERVICE_SQL},
years AS (SELECT ano FROM adm UNION SELECT ano FROM sup),
grid AS (SELECT cod_mun, upper(name) AS municipio, ano FROM dim JOIN years ON true)
SELECT g.cod_mun, g.municipio, g.ano, CAST(a.populacao AS DOUBLE) AS populacao,
       round(idx_atend_agua_total, 6) AS idx_atend_agua_total,
       round(idx_coleta_esgoto, 6) AS idx_coleta_esgoto,
       round(idx_tratamento_esgoto, 6) AS idx_tratamento_esgoto,
       round(idx_perdas_distribuicao, 6) AS idx_perdas_distribuicao,
       round(pct_conformes_global, 6) AS pct_conformes_global,
       chuva_total_mm, round(temp_media_c, 6) AS temp_media_c,
       round(despesa_saude_pc, 6) AS despesa_saude_pc,
       round(pct_despesa_investimentos_saude, 6) AS pct_despesa_investimentos_saude,
       internacoes_total, internacoes_hidricas, valor_total, valor_hidricas,
       round(CASE WHEN populacao > 0 THEN internacoes_total / populacao * 10000 END, 6) AS internacoes_total_10k,
       round(CASE WHEN populacao > 0 THEN internacoes_hidricas / populacao * 10000 END, 6) AS internacoes_hidricas_10k,
       round(CASE WHEN internacoes_total > 0 THEN internacoes_hidricas / internacoes_total * 100 END, 6)
         AS pct_internacoes_hidricas,
       round(CASE WHEN internacoes_total > 0 THEN valor_total / internacoes_total END, 6) AS valor_medio_internacao
FROM grid g
LEFT JOIN adm a ON g.cod_mun = a.cod_mun AND g.ano = a.ano
LEFT JOIN srv s ON g.cod_mun = s.cod_mun AND g.ano = s.ano
"""


@query("gold_features", GOLD_SQL)
def gold(spark: SparkSession, folder: str) -> DataFrame:
    """Nation x year grid with population, service, quality, climate, finance and admissions."""
    admissions = facts.admissions(spark, folder).withColumn("populacao", F.col("populacao").cast("double"))
    sources = [admissions, facts.figures(facts.supplies(spark, folder))]
    return rounded(gold_from_sources(facts.nations(spark, folder).drop("nationkey"), sources))
