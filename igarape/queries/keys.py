"""Codes, look-ups, joins and key grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.functions.text import code_run, zero_fill
from igarape.operators.grid import coverage, key_grid, missing_keys, value_domain
from igarape.operators.lookup import fallback_columns, fan_out, lookup_or_own, with_canonical_code
from igarape.plans.service_indicators import repaired_codes
from igarape.queries import facts
from igarape.queries.registry import query, rounded, table
from igarape.session import cut_lineage


@query(
    "lookup_coalesce",
    """SELECT n_nationkey, coalesce(r_name, n_name) AS nome FROM nation
    LEFT JOIN (SELECT * FROM region WHERE r_name LIKE 'A%') ON n_regionkey = r_regionkey""",
)
def lookup_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region").filter(F.col("r_name").startswith("A"))
    named = regions.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nations = table(spark, folder, "nation").withColumnRenamed("n_name", "nome")
    return lookup_or_own(nations, named, ["n_regionkey"], "nome", "r_name").select("n_nationkey", "nome")


# Customer codes in the shapes found in raw files, one shape per market segment.
_RAW_CODE_SQL = """CASE WHEN c_acctbal < 0 THEN ' - '
  WHEN c_mktsegment = 'BUILDING' THEN d.cod_mun
  WHEN c_mktsegment = 'MACHINERY' THEN substr(d.cod_mun, 1, 6)
  WHEN c_mktsegment = 'HOUSEHOLD' THEN d.cod_mun || '99'
  WHEN c_mktsegment = 'FURNITURE' THEN substr(d.cod_mun, 1, 2) || '.' || substr(d.cod_mun, 3, 4) || ' '
  ELSE 'IBGE ' || substr(d.cod_mun, 1, 6) || '-0' END"""


@query(
    "canonical_code_lookup",
    f"""WITH {facts.DIM_SQL},
    raw AS (SELECT c_custkey, regexp_replace({_RAW_CODE_SQL}, '[^0-9]', '', 'g') AS digits
            FROM customer JOIN dim d ON c_nationkey = d.nationkey),
    tried AS (
      SELECT c_custkey, digits,
        (SELECT max(cod_mun) FROM dim WHERE cod_mun = digits OR substr(cod_mun, 1, 6) = digits) AS whole,
        (SELECT max(cod_mun) FROM dim WHERE cod_mun = substr(digits, 1, 7)) AS seven,
        (SELECT max(cod_mun) FROM dim WHERE length(digits) >= 6 AND substr(cod_mun, 1, 6) = substr(digits, 1, 6)) AS six,
        (SELECT max(cod_mun) FROM dim WHERE cod_mun = lpad(digits, 7, '0')) AS padded
      FROM raw)
    SELECT c_custkey, CASE WHEN digits <> '' THEN coalesce(whole, seven, six, padded) END AS cod_mun FROM tried""",
)
def canonical_code_lookup(spark: SparkSession, folder: str) -> DataFrame:
    dimension = facts.nations(spark, folder)
    code, segment = F.col("cod_mun"), F.col("c_mktsegment")
    six = F.left(code, F.lit(6))
    dirty = (
        F.when(F.col("c_acctbal") < 0, " - ")
        .when(segment == "BUILDING", code)
        .when(segment == "MACHINERY", six)
        .when(segment == "HOUSEHOLD", F.concat(code, F.lit("99")))
        .when(segment == "FURNITURE", F.concat(F.substring(code, 1, 2), F.lit("."), F.substring(code, 3, 4), F.lit(" ")))
        .otherwise(F.concat(F.lit("IBGE "), six, F.lit("-0")))
    )
    customers = table(spark, folder, "customer").withColumnRenamed("c_nationkey", "nationkey")
    raw = customers.join(dimension, "nationkey").select("c_custkey", dirty.alias("codigo"))
    return with_canonical_code(raw, dimension.select("cod_mun", "name"), "codigo", keep_unmatched=True)


@query(
    "code_repair",
    f"""WITH {facts.DIM_SQL},
    raw AS (SELECT s_suppkey,
              CASE WHEN s_acctbal >= 2000 THEN replace(lower(d.name), 'a', 'á') ELSE s_name END AS municipio,
              CASE WHEN s_acctbal >= 6000 THEN d.cod_mun || '.0' ELSE substr(d.cod_mun, 1, 6) END AS codigo
            FROM supplier JOIN dim d ON s_nationkey = d.nationkey)
    SELECT s_suppkey, municipio,
      coalesce((SELECT max(cod_mun) FROM dim WHERE upper(name) = upper(strip_accents(municipio))),
               CASE WHEN length(regexp_replace(codigo, '[^0-9]', '', 'g')) = 6
                    THEN '0' || regexp_replace(codigo, '[^0-9]', '', 'g')
                    ELSE substr(regexp_replace(codigo, '[^0-9]', '', 'g'), 1, 7) END) AS cod_mun
    FROM raw""",
)
def code_repair(spark: SparkSession, folder: str) -> DataFrame:
    dimension = facts.nations(spark, folder)
    balance, code = F.col("s_acctbal"), F.col("cod_mun")
    suppliers = table(spark, folder, "supplier").withColumnRenamed("s_nationkey", "nationkey")
    raw = suppliers.join(dimension, "nationkey").select(
        "s_suppkey",
        F.when(balance >= 2000, F.translate(F.lower("name"), "a", "á")).otherwise(F.col("s_name")).alias("municipio"),
        F.when(balance >= 6000, F.concat(code, F.lit(".0"))).otherwise(F.left(code, F.lit(6))).alias("cod_mun"),
    )
    return repaired_codes(raw, dimension).select("s_suppkey", "municipio", "cod_mun")


@query(
    "zfill_codes",
    """SELECT c_custkey, CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3
         THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END AS codigo FROM customer""",
)
def zfill_codes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", zero_fill(F.col("c_custkey").cast("string"), 3).alias("codigo"))


@query(
    "extract_digits",
    "SELECT doc_id, nullif(regexp_extract(text, '(\\d{6,7})', 1), '') AS codigo FROM documents",
)
def extract_digits(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", code_run("text").alias("codigo"))


# Event types stand for stations and regions for the areas they cover; "purchase" covers none.
_AREAS = [("view", 0), ("signup", 1), ("click", 2), ("error", 3), ("view", 4)]


@query(
    "station_fanout",
    """WITH bridge(event_type, r) AS (VALUES ('view', 0), ('signup', 1), ('click', 2), ('error', 3), ('view', 4)),
    days AS (SELECT event_type, CAST(ts AS DATE) AS dia, count(*) AS leituras, max(value) AS maior FROM events GROUP BY 1, 2)
    SELECT n_nationkey, dia, leituras, maior FROM days JOIN bridge USING (event_type) JOIN nation ON n_regionkey = r""",
)
def station_fanout(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "events").groupBy("event_type", F.to_date("ts").alias("dia")).agg(
        F.count("*").alias("leituras"), F.max("value").alias("maior")
    )
    areas = spark.createDataFrame(_AREAS, "event_type string, n_regionkey int")
    bridge = table(spark, folder, "nation").join(areas, "n_regionkey").select("event_type", "n_nationkey")
    return fan_out(days, bridge, "event_type").select("n_nationkey", "dia", "leituras", "maior")


def _order_years(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.year("o_orderdate").alias("ano"))


def _ship_years(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(F.year("l_shipdate").alias("ano"))


@query(
    "year_domain",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders
    UNION SELECT CAST(year(l_shipdate) AS INTEGER) FROM lineitem""",
)
def year_domain(spark: SparkSession, folder: str) -> DataFrame:
    return value_domain([_order_years(spark, folder), _ship_years(spark, folder)], "ano")


@query(
    "grid_cross",
    """SELECT n_nationkey, n_name, ano FROM nation
    JOIN (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders) ON true""",
)
def grid_cross(spark: SparkSession, folder: str) -> DataFrame:
    years = value_domain([_order_years(spark, folder)], "ano")
    return key_grid(table(spark, folder, "nation").select("n_nationkey", "n_name"), years, "ano")


_OBSERVED_SQL = """obs AS (
  SELECT DISTINCT c_nationkey AS n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS ano
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND o_totalprice > 450000)"""


def _observed(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of nation and year with a large, urgent, finished order."""
    chosen = table(spark, folder, "orders").filter(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 450000)
    )
    keys = chosen.select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("ano")).distinct()
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return keys.join(customers, "c_custkey").select("n_nationkey", "ano").distinct()


@query(
    "missing_pairs",
    f"""WITH {_OBSERVED_SQL},
    expected AS (SELECT n_nationkey, n_name, CAST(y AS INTEGER) AS ano FROM nation, range(1995, 2002) AS t(y))
    SELECT n_nationkey, n_name, ano FROM expected e
    WHERE NOT EXISTS (SELECT 1 FROM obs WHERE obs.n_nationkey = e.n_nationkey AND obs.ano = e.ano)""",
)
def missing_pairs(spark: SparkSession, folder: str) -> DataFrame:
    years = F.sequence(F.lit(facts.FIRST_YEAR), F.lit(facts.LAST_YEAR))
    expected = table(spark, folder, "nation").select("n_nationkey", "n_name", F.explode(years).alias("ano"))
    return missing_keys(expected, _observed(spark, folder), ["n_nationkey", "ano"]).select("n_nationkey", "n_name", "ano")


@query(
    "coverage_by_year",
    f"""WITH {_OBSERVED_SQL}
    SELECT ano, count(DISTINCT n_nationkey) AS municipios_com_dado,
      (SELECT count(DISTINCT n_nationkey) FROM nation) AS municipios_esperados,
      round(count(DISTINCT n_nationkey) / (SELECT count(DISTINCT n_nationkey) FROM nation), 6) AS percentual_cobertura
    FROM obs GROUP BY 1""",
)
def coverage_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(coverage(_observed(spark, folder), table(spark, folder, "nation"), "ano", "n_nationkey"))


@query(
    "fallback_coalesce",
    f"""WITH {facts.PANEL_SQL},
    second AS (SELECT cod_mun, ano, open_q * 100 / quantity AS idx_atend_agua_total,
                      flag_r * 100 / quantity AS idx_tratamento_esgoto FROM sup)
    SELECT g.cod_mun, g.ano, round(coalesce(g.idx_atend_agua_total, s.idx_atend_agua_total), 6) AS idx_atend_agua_total,
           round(coalesce(g.idx_tratamento_esgoto, s.idx_tratamento_esgoto), 6) AS idx_tratamento_esgoto
    FROM gold g LEFT JOIN second s ON g.cod_mun = s.cod_mun AND g.ano = s.ano""",
)
def fallback_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["idx_atend_agua_total", "idx_tratamento_esgoto"]
    supplied = cut_lineage(facts.supplies(spark, folder))
    second = supplied.select(
        "cod_mun",
        "ano",
        (F.col("open") * 100 / F.col("quantity")).alias(columns[0]),
        (F.col("flag_r") * 100 / F.col("quantity")).alias(columns[1]),
    )
    filled = fallback_columns(facts.panel(spark, folder, supplied), second, ["cod_mun", "ano"], columns)
    return rounded(filled.select("cod_mun", "ano", *columns))


@query(
    "population_by_key",
    f"""WITH {facts.DIM_SQL}
    SELECT cod_mun, CAST(count(*) AS INTEGER) AS populacao FROM customer JOIN dim ON c_nationkey = nationkey GROUP BY 1""",
)
def population_by_key(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count("*").cast("int").alias("populacao")
    )
    return counts.join(facts.nations(spark, folder), "nationkey").select("cod_mun", "populacao")
