"""Stand-ins for the layer tables, built from the shared tables.

Nations play the municipalities, orders the admissions, line items the water
samples and service figures. Facts are summed per join key and year before they
are joined, so that a customer or supplier with very many rows is collapsed by
partial aggregation and the joins see one row per key and year.

Money is summed in whole cents: the total is exact and does not depend on task order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.functions.numeric import guarded_ratio
from igarape.functions.text import starts_with_any
from igarape.queries.registry import table

URGENT = ["1-", "2-"]
FIRST_YEAR, LAST_YEAR = 1995, 2001


def hundredths(column: str) -> Column:
    """A number with two decimals as a whole number of hundredths."""
    return F.rint(F.col(column) * 100).cast("long")


def urgent() -> Column:
    return starts_with_any("o_orderpriority", URGENT)


def nation_code() -> Column:
    return (F.lit(1500000) + 10 * F.col("n_nationkey") + F.col("n_regionkey")).cast("string")


def nations(spark: SparkSession, folder: str) -> DataFrame:
    """The dimension: (cod_mun, name, nationkey) with 7-digit codes."""
    return table(spark, folder, "nation").select(
        nation_code().alias("cod_mun"),
        F.col("n_name").alias("name"),
        F.col("n_nationkey").alias("nationkey"),
    )


def orders_by_customer_year(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("ano"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(urgent()).alias("n_urgent"),
            F.sum(hundredths("o_totalprice")).alias("value"),
            F.sum(F.when(urgent(), hundredths("o_totalprice"))).alias("value_urgent"),
        )
    )


def admissions(spark: SparkSession, folder: str) -> DataFrame:
    """(cod_mun, ano): active customers, orders, urgent orders and their values."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    totals = (
        orders_by_customer_year(spark, folder)
        .join(customers, "c_custkey")
        .groupBy(F.col("c_nationkey").alias("nationkey"), "ano")
        .agg(
            F.count("*").alias("populacao"),
            F.sum("n").alias("internacoes_total"),
            F.sum("n_urgent").alias("internacoes_hidricas"),
            (F.sum("value") / 100).alias("valor_total"),
            F.coalesce(F.sum("value_urgent") / 100, F.lit(0.0)).alias("valor_hidricas"),
        )
    )
    return totals.join(nations(spark, folder), "nationkey").drop("nationkey", "name")


def _quantity(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("l_quantity")).otherwise(0.0))


def supplies(spark: SparkSession, folder: str) -> DataFrame:
    """(cod_mun, ano): line-item figures of the suppliers of a nation."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    by_supplier = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("ano"))
        .agg(
            F.count("*").alias("items"),
            F.sum("l_quantity").alias("quantity"),
            _quantity(status == "O").alias("open"),
            _quantity(flag == "A").alias("flag_a"),
            _quantity(flag == "N").alias("flag_n"),
            _quantity(flag == "R").alias("flag_r"),
            F.sum(hundredths("l_discount")).alias("discount"),
            F.sum(hundredths("l_tax")).alias("tax"),
            F.sum(hundredths("l_extendedprice")).alias("price"),
        )
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    sums = [c for c in by_supplier.columns if c not in ("s_suppkey", "ano")]
    totals = (
        by_supplier.join(suppliers, "s_suppkey")
        .groupBy(F.col("s_nationkey").alias("nationkey"), "ano")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    return totals.join(nations(spark, folder), "nationkey").drop("nationkey", "name")


def figures(supplied: DataFrame) -> DataFrame:
    """(cod_mun, ano): service, quality, climate and finance figures of the supplies."""
    total, decided = F.col("quantity"), F.col("flag_a") + F.col("flag_r")
    return supplied.select(
        "cod_mun",
        "ano",
        # Unknown where open items are scarce, so that fills have something to do.
        F.when(F.col("open") * 100 >= total * 48, F.col("open") * 100 / total).alias("idx_atend_agua_total"),
        (F.col("flag_n") * 100 / total).alias("idx_coleta_esgoto"),
        F.when(F.col("flag_r") * 100 < total * 35, F.col("flag_r") * 100 / total).alias("idx_tratamento_esgoto"),
        (F.col("discount") / F.col("items")).alias("idx_perdas_distribuicao"),
        guarded_ratio(F.col("flag_a") * 100, decided).alias("pct_conformes_global"),
        total.alias("chuva_total_mm"),
        (total / F.col("items")).alias("temp_media_c"),
        (F.col("price") / 100 / F.col("items")).alias("despesa_saude_pc"),
        (F.col("tax") / F.col("items")).alias("pct_despesa_investimentos_saude"),
    )


def panel(spark: SparkSession, folder: str, supplied: DataFrame | None = None) -> DataFrame:
    """The gold stand-in: nation and year, with admission rates and supplier figures."""
    if supplied is None:
        supplied = supplies(spark, folder)
    facts = admissions(spark, folder)
    names = nations(spark, folder).select("cod_mun", F.upper("name").alias("municipio"))
    joined = facts.join(names, "cod_mun").join(figures(supplied), ["cod_mun", "ano"], "left")
    return joined.withColumns(
        {
            "populacao": F.col("populacao").cast("double"),
            "internacoes_total_10k": guarded_ratio("internacoes_total", "populacao", 10000.0),
            "internacoes_hidricas_10k": guarded_ratio("internacoes_hidricas", "populacao", 10000.0),
        }
    )


# The same tables in SQL.
DIM_SQL = """
dim AS (
  SELECT CAST(1500000 + 10 * n_nationkey + n_regionkey AS VARCHAR) AS cod_mun,
         n_name AS name, n_nationkey AS nationkey
  FROM nation)
"""

ADMISSIONS_SQL = """
adm AS (
  SELECT d.cod_mun, CAST(year(o_orderdate) AS INTEGER) AS ano,
         count(DISTINCT o_custkey) AS populacao,
         count(*) AS internacoes_total,
         count(*) FILTER (WHERE o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%') AS internacoes_hidricas,
         CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS valor_total,
         coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(15,2)))
           FILTER (WHERE o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%') AS DOUBLE), 0.0) AS valor_hidricas
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN dim d ON c_nationkey = d.nationkey
  GROUP BY 1, 2)
"""

SUPPLIES_SQL = """
sup AS (
  SELECT d.cod_mun, CAST(year(l_shipdate) AS INTEGER) AS ano,
         count(*) AS items, sum(l_quantity) AS quantity,
         coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0) AS open_q,
         coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0) AS flag_a,
         coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'N'), 0) AS flag_n,
         coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0) AS flag_r,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) AS discount,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) AS tax,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS price
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN dim d ON s_nationkey = d.nationkey
  GROUP BY 1, 2)
"""

SERVICE_SQL = """
srv AS (
  SELECT cod_mun, ano,
         CASE WHEN open_q * 100 >= quantity * 48 THEN open_q * 100 / quantity END AS idx_atend_agua_total,
         flag_n * 100 / quantity AS idx_coleta_esgoto,
         CASE WHEN flag_r * 100 < quantity * 35 THEN flag_r * 100 / quantity END AS idx_tratamento_esgoto,
         discount / items AS idx_perdas_distribuicao,
         CASE WHEN flag_a + flag_r > 0 THEN flag_a * 100 / (flag_a + flag_r) END AS pct_conformes_global,
         quantity AS chuva_total_mm, quantity / items AS temp_media_c,
         price / items AS despesa_saude_pc, tax / items AS pct_despesa_investimentos_saude
  FROM sup)
"""

PANEL_SQL = f"""
{DIM_SQL}, {ADMISSIONS_SQL}, {SUPPLIES_SQL}, {SERVICE_SQL},
gold AS (
  SELECT a.cod_mun, upper(d.name) AS municipio, a.ano, CAST(a.populacao AS DOUBLE) AS populacao,
         a.internacoes_total, a.internacoes_hidricas, a.valor_total, a.valor_hidricas,
         s.* EXCLUDE (cod_mun, ano),
         a.internacoes_total / a.populacao * 10000.0 AS internacoes_total_10k,
         a.internacoes_hidricas / a.populacao * 10000.0 AS internacoes_hidricas_10k
  FROM adm a JOIN dim d ON a.cod_mun = d.cod_mun
  LEFT JOIN srv s ON a.cod_mun = s.cod_mun AND a.ano = s.ano)
"""
