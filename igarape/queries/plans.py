"""The plans that the jobs run, on rows of the shared tables in the shape of their inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.functions.numeric import decimal_comma_number
from igarape.operators.hot_join import join_unsummed
from igarape.plans import admissions, finance, population, water_quality
from igarape.queries import facts
from igarape.queries.registry import query, rounded, table


def _orders_with_code(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nationkey"))
    codes = facts.nations(spark, folder).select("nationkey", "cod_mun")
    return join_unsummed(table(spark, folder, "orders"), customers, "o_custkey").join(codes, "nationkey")


@query(
    "admissions_plan",
    f"""WITH {facts.DIM_SQL}
    SELECT d.cod_mun, CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS internacoes_total,
      count(*) FILTER (WHERE o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%') AS internacoes_hidricas,
      CAST(sum(o_orderkey % 10) AS DOUBLE) AS dias_perm_total,
      CAST(coalesce(sum(o_orderkey % 10) FILTER (WHERE o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%'), 0) AS DOUBLE)
        AS dias_perm_hidricas,
      round(CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE), 2) AS valor_total,
      round(CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(15,2)))
        FILTER (WHERE o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%'), 0) AS DOUBLE), 2) AS valor_hidricas
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN dim d ON c_nationkey = d.nationkey GROUP BY 1, 2""",
)
def admissions_plan(spark: SparkSession, folder: str) -> DataFrame:
    silver = admissions_silver_rows(spark, folder)
    return rounded(admissions.admissions_by_year(silver, facts.nations(spark, folder).drop("nationkey")), 2)


def admissions_silver_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Records with six-digit codes and a decimal comma, to monthly totals."""
    diagnosis = (
        F.when(F.col("o_orderpriority").startswith("1-"), "A09.0")
        .when(F.col("o_orderpriority").startswith("2-"), " e86")
        .otherwise("B20")
    )
    price = F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(","))
    raw = _orders_with_code(spark, folder).select(
        F.year("o_orderdate").cast("string").alias("ANO_CMPT"),
        F.month("o_orderdate").cast("string").alias("MES_CMPT"),
        F.left("cod_mun", F.lit(6)).alias("MUNIC_RES"),
        diagnosis.alias("DIAG_PRINC"),
        (F.col("o_orderkey") % 10).cast("string").alias("DIAS_PERM"),
        price.alias("VAL_TOT"),
    )
    dimension = facts.nations(spark, folder).drop("nationkey")
    return admissions.admissions_silver(raw, dimension, number=decimal_comma_number)


@query(
    "percentile_mean",
    f"""WITH {facts.DIM_SQL},
    samples AS (
      SELECT d.cod_mun, CAST(year(l_shipdate) AS INTEGER) AS ano, l_returnflag AS parametro, l_quantity AS total,
        CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END AS good,
        CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS DOUBLE) END AS p95
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN dim d ON s_nationkey = d.nationkey)
    SELECT cod_mun, ano, parametro, sum(total) AS amostras_total, sum(good) AS amostras_conformes,
      sum(total - good) AS amostras_nao_conformes, round(avg(p95), 6) AS percentil_95,
      round(CASE WHEN sum(total) > 0 THEN sum(good) / sum(total) * 100 END, 6) AS pct_conformes_param
    FROM samples GROUP BY 1, 2, 3""",
)
def percentile_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly totals per parameter; groups without a percentile do not count in its mean."""
    silver = percentile_silver(spark, folder)
    return rounded(water_quality.quality_by_parameter(silver, facts.nations(spark, folder).drop("nationkey")))


def percentile_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as groups of samples."""
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nationkey"))
    codes = facts.nations(spark, folder).select("nationkey", "cod_mun")
    items = join_unsummed(table(spark, folder, "lineitem"), suppliers, "l_suppkey").join(codes, "nationkey")
    good = F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0)
    return items.select(
        F.when(F.col("l_linenumber") > 3, F.left("cod_mun", F.lit(6))).otherwise(F.col("cod_mun")).alias("cod_mun"),
        F.year("l_shipdate").alias("ano"),
        F.col("l_returnflag").alias("parametro"),
        F.col("l_quantity").alias("amostras_total"),
        good.alias("amostras_conformes"),
        (F.col("l_quantity") - good).alias("amostras_nao_conformes"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber").cast("double")).alias("percentil_95"),
    )


@query(
    "finance_plan",
    f"""WITH {facts.DIM_SQL},
    cells AS (
      SELECT d.cod_mun, upper(d.name) AS municipio, p_size AS ano, p_partkey % 2 AS part, p_partkey,
        CAST(p_partkey * 7919 % 1009 AS DOUBLE) / 1013 AS ratio
      FROM part JOIN dim d ON p_partkey % 25 = d.nationkey)
    SELECT cod_mun, municipio, CAST(ano AS INTEGER) AS ano,
      round_even(min_by(ratio, p_partkey) FILTER (WHERE part = 0), 2) AS despesa_saude_pc,
      round_even(min_by(ratio, p_partkey) FILTER (WHERE part = 1) * 100, 2) AS pct_despesa_investimentos_saude
    FROM cells GROUP BY 1, 2, 3""",
)
def finance_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Indicator rows whose codes have six or seven digits, to one row per municipality and year."""
    codes = facts.nations(spark, folder).select("nationkey", F.col("cod_mun").alias("code"))
    parts = table(spark, folder, "part").join(codes, F.col("p_partkey") % 25 == F.col("nationkey"))
    rows = parts.select(
        F.when(F.col("p_partkey") % 3 == 0, F.left("code", F.lit(6))).otherwise(F.col("code")).alias("cod_mun"),
        F.col("p_size").alias("ano"),
        F.col("p_partkey").cast("int").alias("periodo"),
        F.when(F.col("p_partkey") % 2 == 0, 2.1).otherwise(2.5).alias("numero_indicador"),
        (F.col("p_partkey") * 7919 % 1009).cast("double").alias("numerador"),
        F.lit(1013.0).alias("denominador"),
    )
    silver = finance.finance_silver(rows, facts.nations(spark, folder).drop("nationkey"))
    return silver.select("cod_mun", "municipio", "ano", "despesa_saude_pc", "pct_despesa_investimentos_saude")


@query(
    "population_plan",
    f"""WITH {facts.DIM_SQL}
    SELECT d.cod_mun, CAST(c_custkey % 9 AS INTEGER) AS ano, CAST(max(c_custkey) AS DOUBLE) AS populacao
    FROM customer JOIN dim d ON c_nationkey = d.nationkey GROUP BY 1, 2""",
)
def population_plan(spark: SparkSession, folder: str) -> DataFrame:
    silver = population.population_silver(population_rows(spark, folder))
    return population.population_by_year(silver, facts.nations(spark, folder).drop("nationkey"))


def population_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as landed estimates, with codes of six and of seven digits."""
    codes = facts.nations(spark, folder).select("nationkey", F.col("cod_mun").alias("code"))
    customers = table(spark, folder, "customer").join(codes, F.col("c_nationkey") == F.col("nationkey"))
    return customers.select(
        F.when(F.col("c_custkey") % 2 == 0, F.left("code", F.lit(6))).otherwise(F.col("code")).alias("cod_mun"),
        F.concat((F.col("c_custkey") % 9).cast("string"), F.lit(".0")).alias("ano"),
        F.col("c_custkey").cast("string").alias("populacao"),
    )


@query(
    "parse_measures",
    """WITH texts AS (
      SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN replace(printf('%.2f', o_totalprice), '.', ',')
        WHEN 1 THEN CAST(o_custkey AS VARCHAR) || 'abc' WHEN 2 THEN CAST(o_custkey AS VARCHAR) || 'e3'
        WHEN 3 THEN '1.' || CAST(o_custkey AS VARCHAR) || ',5' ELSE printf('%.2f', o_totalprice) END AS t FROM orders)
    SELECT o_orderkey, round(CASE WHEN regexp_full_match(replace(t, ',', '.'), '[0-9]+(\\.[0-9]*)?(e[0-9]+)?')
      THEN CAST(replace(t, ',', '.') AS DOUBLE) END, 6) AS medida FROM texts""",
)
def parse_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Measures with a decimal comma; letters and grouped thousands are not repaired."""
    key, price = F.col("o_orderkey") % 5, F.format_string("%.2f", "o_totalprice")
    customer = F.col("o_custkey").cast("string")
    text = (
        F.when(key == 0, F.replace(price, F.lit("."), F.lit(",")))
        .when(key == 1, F.concat(customer, F.lit("abc")))
        .when(key == 2, F.concat(customer, F.lit("e3")))
        .when(key == 3, F.concat(F.lit("1."), customer, F.lit(",5")))
        .otherwise(price)
    )
    return rounded(table(spark, folder, "orders").select("o_orderkey", decimal_comma_number(text).alias("medida")))


@query(
    "member_share",
    f"""WITH {facts.DIM_SQL}
    SELECT count(*) AS registros, count(*) FILTER (WHERE n_regionkey < 3) AS registros_membros,
      round(avg(CASE WHEN n_regionkey < 3 THEN 100.0 ELSE 0 END), 6) AS pct_membros
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def member_share(spark: SparkSession, folder: str) -> DataFrame:
    """Records of member municipalities and their share; codes have six digits or seven."""
    codes = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey", facts.nation_code().alias("code"))
    customers = table(spark, folder, "customer").join(codes, "c_nationkey")
    raw = customers.select(F.when(F.col("c_custkey") % 2 == 0, F.left("code", F.lit(6))).otherwise(F.col("code")).alias("MUNIC_RES"))
    members = codes.filter("n_regionkey < 3").select(F.col("code").alias("cod_mun"))
    return rounded(admissions.member_share(raw, members))
