"""Group aggregates, reshaping, ordering and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.constants import FINANCE_INDICATORS
from igarape.functions.numeric import guarded_ratio, sum_skipping_null
from igarape.operators.ordering import first_row_per_key
from igarape.operators.reshape import cells_to_columns, sum_by_class, to_long
from igarape.operators.scale import minmax_summary
from igarape.plans.climate import station_year
from igarape.plans.water_quality import quality_by_year
from igarape.queries import facts
from igarape.queries.facts import hundredths, urgent
from igarape.queries.registry import query, rounded, table


@query(
    "annual_sums",
    f"""WITH {facts.DIM_SQL}, {facts.ADMISSIONS_SQL}
    SELECT cod_mun, ano, internacoes_total, internacoes_hidricas, valor_total, valor_hidricas FROM adm""",
)
def annual_sums(spark: SparkSession, folder: str) -> DataFrame:
    return facts.admissions(spark, folder).drop("populacao")


@query(
    "monthly_admissions",
    """SELECT c_nationkey AS nationkey, CAST(year(o_orderdate) AS INTEGER) AS ano,
         CAST(month(o_orderdate) AS INTEGER) AS mes, count(*) AS internacoes_total,
         count(*) FILTER (WHERE o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%') AS internacoes_hidricas,
         CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS valor_total,
         coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(15,2)))
           FILTER (WHERE o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%') AS DOUBLE), 0.0) AS valor_hidricas
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
)
def monthly_admissions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders are first summed per customer and month, so that no customer's rows reach one task."""
    by_customer = (
        table(spark, folder, "orders")
        .groupBy(
            F.col("o_custkey").alias("c_custkey"),
            F.year("o_orderdate").alias("ano"),
            F.month("o_orderdate").alias("mes"),
        )
        .agg(
            F.count("*").alias("n"),
            F.count_if(urgent()).alias("n_urgent"),
            F.sum(hundredths("o_totalprice")).alias("value"),
            F.sum(F.when(urgent(), hundredths("o_totalprice"))).alias("value_urgent"),
        )
    )
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    return by_customer.join(customers, "c_custkey").groupBy("nationkey", "ano", "mes").agg(
        F.sum("n").alias("internacoes_total"),
        F.sum("n_urgent").alias("internacoes_hidricas"),
        (F.sum("value") / 100).alias("valor_total"),
        F.coalesce(F.sum("value_urgent") / 100, F.lit(0.0)).alias("valor_hidricas"),
    )


# Line items as water samples: part types play parameters, return flags the classes.
_PARAMETERS = {
    "ECONOMY": "cloro_residual_livre",
    "LARGE": "turbidez",
    "MEDIUM": "ph",
    "PROMO": "coliformes_totais",
    "SMALL": "escherichia_coli",
    "STANDARD": "fluoreto",
}
_SAMPLES_SQL = f"""{facts.DIM_SQL},
smp AS (
  SELECT d.cod_mun, CAST(year(l_shipdate) AS INTEGER) AS ano,
         CASE p_type {' '.join(f"WHEN '{t}' THEN '{p}'" for t, p in _PARAMETERS.items())} END AS parametro,
         l_returnflag AS flag, l_quantity AS q, l_discount AS d95
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN dim d ON s_nationkey = d.nationkey),
par AS (
  SELECT cod_mun, ano, parametro,
         coalesce(sum(q) FILTER (WHERE flag IN ('A', 'R')), 0) AS amostras_total,
         coalesce(sum(q) FILTER (WHERE flag = 'A'), 0) AS amostras_conformes,
         coalesce(sum(q) FILTER (WHERE flag = 'R'), 0) AS amostras_nao_conformes,
         sum(CAST(round(d95 * 100) AS BIGINT)) / count(*) AS percentil_95
  FROM smp GROUP BY 1, 2, 3),
pct AS (
  SELECT *, CASE WHEN amostras_total > 0 THEN amostras_conformes / amostras_total * 100 END AS pct FROM par)
"""


def _by_supplier_and_type(spark: SparkSession, folder: str) -> DataFrame:
    """Line items joined to their part type and summed per supplier, year, type and flag."""
    items = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_suppkey").alias("s_suppkey"),
        F.year("l_shipdate").alias("ano"),
        F.col("l_returnflag").alias("flag"),
        "l_quantity",
        hundredths("l_discount").alias("discount"),
    )
    types = table(spark, folder, "part").select("p_partkey", "p_type")
    parameters = F.create_map(*[F.lit(x) for pair in _PARAMETERS.items() for x in pair])
    return (
        items.join(types, "p_partkey")
        .groupBy("s_suppkey", "ano", F.try_element_at(parameters, F.col("p_type")).alias("parametro"), "flag")
        .agg(F.sum("l_quantity").alias("q"), F.sum("discount").alias("discount"), F.count("*").alias("n"))
    )


def _samples(spark: SparkSession, folder: str) -> DataFrame:
    """(cod_mun, ano, parametro, flag): quantity, discount and row count."""
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nationkey"))
    located = _by_supplier_and_type(spark, folder).join(suppliers, "s_suppkey")
    return located.join(facts.nations(spark, folder), "nationkey")


def _by_parameter(spark: SparkSession, folder: str) -> DataFrame:
    flag, q = F.col("flag"), F.col("q")
    totals = _samples(spark, folder).groupBy("cod_mun", "ano", "parametro").agg(
        F.sum(F.when(flag.isin("A", "R"), q).otherwise(0.0)).alias("amostras_total"),
        F.sum(F.when(flag == "A", q).otherwise(0.0)).alias("amostras_conformes"),
        F.sum(F.when(flag == "R", q).otherwise(0.0)).alias("amostras_nao_conformes"),
        (F.sum("discount") / F.sum("n")).alias("percentil_95"),
    )
    return totals.withColumn(
        "pct_conformes_param", guarded_ratio("amostras_conformes", "amostras_total", 100.0)
    )


@query(
    "quality_two_level",
    f"""WITH {_SAMPLES_SQL}
    SELECT cod_mun, ano, count(*) AS parametros, sum(amostras_total) AS amostras_total,
           sum(amostras_conformes) AS amostras_conformes, round(avg(pct), 6) AS pct_medio_parametros,
           round(CASE WHEN sum(amostras_total) > 0 THEN sum(amostras_conformes) / sum(amostras_total) * 100 END, 6)
             AS pct_conformes_global
    FROM pct GROUP BY 1, 2""",
)
def quality_two_level(spark: SparkSession, folder: str) -> DataFrame:
    totals = _by_parameter(spark, folder).groupBy("cod_mun", "ano").agg(
        F.count("*").alias("parametros"),
        F.sum("amostras_total").alias("amostras_total"),
        F.sum("amostras_conformes").alias("amostras_conformes"),
        F.avg("pct_conformes_param").alias("pct_medio_parametros"),
    )
    overall = guarded_ratio("amostras_conformes", "amostras_total", 100.0)
    return rounded(totals.withColumn("pct_conformes_global", overall))


_WIDE_SQL = ",\n".join(
    [f"round(max(pct) FILTER (WHERE parametro = '{p}'), 6) AS pct_conformes_{p}" for p in
     ["cloro_residual_livre", "turbidez", "ph", "coliformes_totais", "escherichia_coli", "fluoreto", "cor"]]
    + [f"round(max(percentil_95) FILTER (WHERE parametro = '{p}'), 6) AS percentil95_{p}" for p in
       ["turbidez", "cloro_residual_livre", "ph", "fluoreto"]]
)


@query(
    "quality_wide",
    f"""WITH {_SAMPLES_SQL}
    SELECT cod_mun, ano, sum(amostras_total) AS sisagua_amostras_total,
      sum(amostras_conformes) AS sisagua_amostras_conformes,
      sum(amostras_nao_conformes) AS sisagua_amostras_nao_conformes,
      round(CASE WHEN sum(amostras_total) > 0 THEN sum(amostras_conformes) / sum(amostras_total) * 100 END, 6)
        AS pct_conformes_global,
      {_WIDE_SQL}
    FROM pct GROUP BY 1, 2""",
)
def quality_wide(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality_by_year(_by_parameter(spark, folder)))


@query(
    "pivot_classes",
    f"""WITH {_SAMPLES_SQL},
    wide AS (
      SELECT cod_mun, ano, parametro, 0.0 AS total,
        coalesce(sum(q) FILTER (WHERE flag = 'A'), 0.0) AS conforme,
        coalesce(sum(q) FILTER (WHERE flag = 'R'), 0.0) AS nao_conforme,
        coalesce(sum(q) FILTER (WHERE flag = 'N'), 0.0) AS nao_classificado,
        0.0 AS percentil_95
      FROM smp GROUP BY 1, 2, 3)
    SELECT cod_mun, ano, parametro, CAST(conforme AS DOUBLE) AS conforme, CAST(nao_conforme AS DOUBLE) AS nao_conforme,
      CAST(nao_classificado AS DOUBLE) AS nao_classificado, CAST(percentil_95 AS DOUBLE) AS percentil_95,
      CAST(CASE WHEN total > 0 THEN total ELSE conforme + nao_conforme + nao_classificado END AS DOUBLE) AS total,
      round(CASE WHEN conforme + nao_conforme > 0 THEN conforme / (conforme + nao_conforme) * 100 END, 6) AS pct_conformes
    FROM wide""",
)
def pivot_classes(spark: SparkSession, folder: str) -> DataFrame:
    classes = {"T": "total", "A": "conforme", "R": "nao_conforme", "N": "nao_classificado", "P": "percentil_95"}
    wide = sum_by_class(_samples(spark, folder), ["cod_mun", "ano", "parametro"], "flag", "q", classes)
    decided = F.col("conforme") + F.col("nao_conforme")
    total = F.when(F.col("total") > 0, F.col("total")).otherwise(decided + F.col("nao_classificado"))
    return rounded(wide.withColumns({"total": total, "pct_conformes": guarded_ratio("conforme", decided, 100.0)}))


@query(
    "group_null_keys",
    """SELECT coalesce(CASE WHEN p_size >= 10 THEN p_brand END, 'N/A') AS marca, p_type, count(*) AS n,
         CAST(sum(p_size) AS BIGINT) AS tamanho
    FROM part GROUP BY 1, 2""",
)
def group_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.when(F.col("p_size") >= 10, F.col("p_brand"))
    return table(spark, folder, "part").groupBy(F.coalesce(brand, F.lit("N/A")).alias("marca"), "p_type").agg(
        F.count("*").alias("n"), F.sum("p_size").alias("tamanho")
    )


# Flag and status of a line item as a finance indicator code.
_FINANCE_CODES = {"AF": "1.3", "AO": "1.6", "NF": "2.1", "NO": "2.2", "RF": "2.3", "RO": "2.4"}
_RATIO_SQL = ", ".join(
    f"""round_even(max(CASE WHEN codigo = '{key}' THEN numerador / denominador * {FINANCE_INDICATORS[code][1]} END), 2)
      AS {FINANCE_INDICATORS[code][0]}"""
    for key, code in _FINANCE_CODES.items()
)


@query(
    "pivot_ratio_codes",
    f"""WITH sums AS (
      SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, l_returnflag || l_linestatus AS codigo,
        CAST(sum(CAST(round(l_discount * 100) AS BIGINT) * CAST(l_quantity AS BIGINT)) AS DOUBLE) AS numerador,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) * 100 AS denominador
      FROM lineitem GROUP BY 1, 2)
    SELECT ano, {_RATIO_SQL} FROM sums GROUP BY 1""",
)
def pivot_ratio_codes(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("long")
    sums = table(spark, folder, "lineitem").groupBy(
        F.year("l_shipdate").alias("ano"), F.concat("l_returnflag", "l_linestatus").alias("codigo")
    ).agg(
        F.sum(hundredths("l_discount") * quantity).cast("double").alias("numerador"),
        (F.sum(quantity).cast("double") * 100).alias("denominador"),
    )
    scales = F.create_map(
        *[F.lit(x) for key, code in _FINANCE_CODES.items() for x in (key, FINANCE_INDICATORS[code][1])]
    )
    ratio = F.when(F.col("denominador") != 0, F.col("numerador") / F.col("denominador"))
    names = {key: FINANCE_INDICATORS[code][0] for key, code in _FINANCE_CODES.items()}
    wide = cells_to_columns(sums, ["ano"], "codigo", ratio * F.try_element_at(scales, F.col("codigo")), names)
    return wide.withColumns({c: F.bround(c, 2) for c in names.values()})


@query(
    "unpivot_metrics",
    f"""WITH {facts.DIM_SQL}, {facts.ADMISSIONS_SQL}
    SELECT cod_mun, ano, 'internacoes_total' AS indicador, CAST(internacoes_total AS DOUBLE) AS valor FROM adm
    UNION ALL SELECT cod_mun, ano, 'internacoes_hidricas', CAST(internacoes_hidricas AS DOUBLE) FROM adm
    UNION ALL SELECT cod_mun, ano, 'valor_total', valor_total FROM adm""",
)
def unpivot_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = ["internacoes_total", "internacoes_hidricas", "valor_total"]
    wide = facts.admissions(spark, folder).withColumns({m: F.col(m).cast("double") for m in metrics})
    return to_long(wide, ["cod_mun", "ano"], metrics, "indicador", "valor")


@query(
    "max_all_numeric",
    """SELECT p_brand, p_type, max(p_partkey) AS p_partkey, max(p_size) AS p_size, max(p_retailprice) AS p_retailprice
    FROM part GROUP BY 1, 2""",
)
def max_all_numeric(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    numeric = [c for c, t in parts.dtypes if t != "string"]
    return parts.groupBy("p_brand", "p_type").agg(*[F.max(c).alias(c) for c in numeric])


@query(
    "minmax_summary",
    """SELECT 'p_size' AS coluna, CAST(min(p_size) AS DOUBLE) AS minimo, CAST(max(p_size) AS DOUBLE) AS maximo FROM part
    UNION ALL SELECT 'p_retailprice', min(p_retailprice), max(p_retailprice) FROM part
    UNION ALL SELECT 'p_partkey', CAST(min(p_partkey) AS DOUBLE), CAST(max(p_partkey) AS DOUBLE) FROM part""",
)
def part_minmax_summary(spark: SparkSession, folder: str) -> DataFrame:
    return minmax_summary(table(spark, folder, "part"), ["p_size", "p_retailprice", "p_partkey"])


@query(
    "best_row_per_key",
    """WITH item AS (
      SELECT l_suppkey AS s_suppkey, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS a,
             sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS r FROM lineitem GROUP BY 1),
    cand AS (
      SELECT s_nationkey, s_suppkey, s_name, coalesce(CASE WHEN s_acctbal >= 0 THEN s_acctbal END, 0.0)
        + coalesce(a, 0.0) + coalesce(r, 0.0) AS score
      FROM supplier LEFT JOIN item USING (s_suppkey))
    SELECT s_nationkey, s_suppkey, s_name, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY score DESC, s_suppkey) AS rn FROM cand)
    WHERE rn = 1""",
)
def best_row_per_key(spark: SparkSession, folder: str) -> DataFrame:
    sums = table(spark, folder, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("a"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("r"),
    )
    balance = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal"))
    candidates = (
        table(spark, folder, "supplier")
        .join(sums, "s_suppkey", "left")
        .withColumn("saldo", balance)
        .withColumn("score", sum_skipping_null(["saldo", "a", "r"]))
        .select("s_nationkey", "s_suppkey", "s_name", "score")
    )
    return rounded(first_row_per_key(candidates, ["s_nationkey"], [-F.col("score"), F.col("s_suppkey")]))


# Events as hourly station readings; a small value counts as a missing reading.
_READINGS_SQL = """readings AS (
  SELECT {station} AS estacao, CAST(year(ts) AS INTEGER) AS ano, CAST(ts AS DATE) AS dia,
         CASE WHEN value >= 10 THEN value END AS chuva, value AS temp,
         CASE WHEN value < 100 THEN value END AS umid
  FROM events)"""


def _readings(spark: SparkSession, folder: str, station: str) -> DataFrame:
    value = F.col("value")
    return table(spark, folder, "events").select(
        F.col(station).cast("string").alias("estacao"),
        F.year("ts").alias("ano"),
        F.col("ts").alias("timestamp_utc"),
        F.when(value >= 10, value).alias("chuva_mm"),
        value.alias("temp_c"),
        F.when(value < 100, value).alias("umid_rel_pct"),
        (value / 10).alias("vento_vel_ms"),
    )


@query(
    "station_year_climate",
    f"""WITH {_READINGS_SQL.format(station="event_type")},
    days AS (SELECT estacao, ano, dia, max(temp) AS t FROM readings GROUP BY 1, 2, 3)
    SELECT r.estacao, r.ano, round(sum(coalesce(chuva, 0)), 4) AS chuva_total_mm,
      round(avg(coalesce(chuva, 0)), 6) AS chuva_media_mm, round(avg(temp), 6) AS temp_media_c,
      max(temp) AS temp_max_c, min(temp) AS temp_min_c, round(avg(umid), 6) AS umid_rel_media_pct,
      round(avg(temp / 10), 6) AS vento_vel_media_ms,
      (SELECT count(*) FROM days d WHERE d.estacao = r.estacao AND d.ano = r.ano AND d.t >= 250) AS dias_calor_extremo
    FROM readings r GROUP BY 1, 2""",
)
def station_year_climate(spark: SparkSession, folder: str) -> DataFrame:
    years = station_year(_readings(spark, folder, "event_type"), heat_threshold=250.0)
    return rounded(years.withColumn("chuva_total_mm", F.round("chuva_total_mm", 4)))


@query(
    "heat_days",
    f"""WITH {_READINGS_SQL.format(station="CAST(user_id AS VARCHAR)")},
    days AS (SELECT estacao, ano, dia, max(temp) AS t FROM readings GROUP BY 1, 2, 3)
    SELECT estacao, ano, count(*) FILTER (WHERE t >= 150) AS dias_calor_extremo FROM days GROUP BY 1, 2""",
)
def heat_days(spark: SparkSession, folder: str) -> DataFrame:
    years = station_year(_readings(spark, folder, "user_id"), heat_threshold=150.0)
    return years.select("estacao", "ano", "dias_calor_extremo")


@query(
    "sort_multi",
    """SELECT o_orderstatus, o_orderpriority, o_totalprice, o_orderkey FROM orders
    ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey""",
)
def sort_multi(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderkey")
    return orders.orderBy("o_orderstatus", F.desc("o_totalprice"), "o_orderkey")


@query(
    "topk",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def topk(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "union_by_name",
    """SELECT c_custkey AS codigo, c_name AS nome, c_acctbal AS saldo, c_mktsegment AS segmento,
         CAST(NULL AS INTEGER) AS nacao FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
)
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("codigo"), F.col("c_name").alias("nome"),
        F.col("c_acctbal").alias("saldo"), F.col("c_mktsegment").alias("segmento"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_name").alias("nome"), F.col("s_suppkey").alias("codigo"),
        F.col("s_nationkey").alias("nacao"), F.col("s_acctbal").alias("saldo"),
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)
