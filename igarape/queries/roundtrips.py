"""Readers and writers of the jobs, on files that they write from the shared tables first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.operators.lookup import require_all_found
from igarape.operators.reshape import project_known
from igarape.plans.admissions import admissions_by_year
from igarape.plans.climate import climate_by_municipality, station_year
from igarape.plans.finance import finance_by_year
from igarape.plans.gold import gold_features
from igarape.plans.population import population_by_year, population_silver
from igarape.plans.service_indicators import service_by_year
from igarape.plans.water_quality import quality_by_parameter, quality_by_year
from igarape.queries import facts
from igarape.queries.facts import hundredths
from igarape.queries.plans import admissions_silver_rows, percentile_silver, population_rows
from igarape.queries.registry import query, rounded, table
from igarape.session import scratch_path
from igarape.sinks.tables import export_csv, read_target, replace_table, replace_touched_partitions, replace_with_csv_twin
from igarape.sources.delimited import read_by_header


@query(
    "replaced_partitions",
    """SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS ano,
      o_custkey + CASE WHEN o_orderstatus = 'O' AND year(o_orderdate) % 2 = 0 THEN 1000000 ELSE 0 END AS c
    FROM orders WHERE NOT (o_orderstatus = 'O' AND year(o_orderdate) % 2 = 0 AND o_orderkey % 2 = 0)""",
)
def replaced_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned table, replaced as a whole and then in those partitions that new rows touch."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("ano"), F.col("o_custkey").alias("c")
    )
    path = scratch_path(spark, "target")
    replace_table(orders.withColumn("c", F.lit(-1).cast("long")), path, ["o_orderstatus", "ano"])
    replace_table(orders, path, ["o_orderstatus", "ano"])
    touched = orders.filter("o_orderstatus = 'O' AND ano % 2 = 0 AND o_orderkey % 2 <> 0").withColumn("c", F.col("c") + 1000000)
    replace_touched_partitions(touched, path, ["o_orderstatus", "ano"])
    return read_target(spark, path).select("o_orderkey", "o_orderstatus", "ano", "c")


@query(
    "csv_twin",
    """SELECT 'parquet' AS kind, p_partkey, p_name, p_size FROM part
    UNION ALL SELECT 'csv', p_partkey, p_name, p_size FROM part""",
)
def csv_twin(spark: SparkSession, folder: str) -> DataFrame:
    """A Parquet table and its CSV twin hold the same rows."""
    path = scratch_path(spark, "twin")
    parts = table(spark, folder, "part").select("p_partkey", F.concat(F.lit('é"; ,'), "p_name").alias("p_name"), "p_size")
    written = replace_with_csv_twin(parts, f"{path}/t.parquet", f"{path}/t.csv", ["p_partkey"])
    wanted = {c: [c] for c in parts.columns}
    read = read_by_header(spark, f"{path}/t.csv", wanted, required=list(wanted)).select(
        F.lit("csv").alias("kind"), F.col("p_partkey").cast("long"), "p_name", F.col("p_size").cast("int")
    )
    both = written.select(F.lit("parquet").alias("kind"), *parts.columns).unionByName(read)
    return both.withColumn("p_name", F.replace("p_name", F.lit('é"; ,')))


@query(
    "headers_by_file",
    """SELECT c_custkey AS codigo, c_name AS nome, CASE WHEN c_nationkey < 12 THEN c_mktsegment END AS segmento FROM customer""",
)
def headers_by_file(spark: SparkSession, folder: str) -> DataFrame:
    """Latin-1 files whose headers name, order and lack columns differently, and one with a header only."""
    path = scratch_path(spark, "headers")
    customers = table(spark, folder, "customer")
    first = customers.filter("c_nationkey < 12").select("c_mktsegment", F.col("c_custkey").alias("Código"), F.col("c_name").alias("nome"))
    second = customers.filter("c_nationkey >= 12").select(F.col("c_name").alias("NOME"), F.lit("x").alias("extra"), F.col("c_custkey").alias("código"))
    for number, rows in enumerate((first, second, second.limit(0))):
        rows.write.options(header=True, sep=";", encoding="ISO-8859-1").csv(f"{path}/{number}")
    wanted = {"codigo": ["Código"], "nome": ["nome"], "segmento": ["c_mktsegment"]}
    found = read_by_header(
        spark, f"{path}/*/*.csv", wanted, ";", "ISO-8859-1", normalise=lambda h: h.strip().lower(), required=["codigo", "nome"]
    )
    return found.select(F.col("codigo").cast("long"), "nome", "segmento")


@query(
    "known_columns",
    "SELECT s_suppkey, s_name, 'supplier' AS fonte, 2024 AS ano FROM supplier",
)
def known_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Those of a list of columns that exist, and constant columns."""
    kept = project_known(table(spark, folder, "supplier"), ["s_suppkey", "s_phone", "s_name", "s_comment"])
    return kept.withColumns({"fonte": F.lit("supplier"), "ano": F.lit(2024)})


@query(
    "unmatched_codes",
    """SELECT CAST(c_nationkey AS VARCHAR) AS cod_mun, count(*) AS n FROM customer
    WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2) GROUP BY 1""",
)
def unmatched_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The table that a strict look-up leaves of the codes it did not find."""
    path = scratch_path(spark, "unmatched")
    rows = table(spark, folder, "customer").select(F.col("c_nationkey").cast("string").alias("cod_mun"))
    known = table(spark, folder, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").cast("string").alias("cod_mun"))
    try:
        require_all_found(rows, known, "cod_mun", path)
    except ValueError as error:
        if path not in str(error):
            raise
    return read_target(spark, path).select("cod_mun", F.col("rows").alias("n"))


_SIX_SQL = f"""WITH {facts.DIM_SQL},
pop AS (SELECT d.cod_mun, CAST(c_custkey % 9 AS INTEGER) AS ano, CAST(max(c_custkey) AS DOUBLE) AS populacao
  FROM customer JOIN dim d ON c_nationkey = d.nationkey GROUP BY 1, 2),
srv AS (SELECT d.cod_mun, CAST(p_size % 9 AS INTEGER) AS ano, max_by(p_retailprice, p_partkey) AS idx_atend_agua_total
  FROM part JOIN dim d ON p_partkey % 25 = d.nationkey WHERE p_size < 40 GROUP BY 1, 2),
fin AS (SELECT cod_mun, CAST(nationkey % 9 AS INTEGER) AS ano, CAST(nationkey AS DOUBLE) / 2 AS despesa_saude_pc FROM dim),
cli AS (SELECT d.cod_mun, CAST(user_id % 9 AS INTEGER) AS ano, round(sum(CAST(round(value * 100) AS BIGINT)) / 100, 6) AS chuva_total_mm
  FROM events JOIN dim d ON user_id % 5 = d.nationkey % 5 AND d.nationkey < 20 GROUP BY 1, 2),
qua AS (SELECT d.cod_mun, CAST(year(l_shipdate) AS INTEGER) AS ano,
    round(CASE WHEN sum(l_quantity) > 0 THEN sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) / sum(l_quantity) * 100 END, 6) AS pct_conformes_global
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN dim d ON s_nationkey = d.nationkey GROUP BY 1, 2),
adm AS (SELECT d.cod_mun, CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS internacoes_total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN dim d ON c_nationkey = d.nationkey GROUP BY 1, 2),
years AS (SELECT ano FROM pop UNION SELECT ano FROM srv UNION SELECT ano FROM fin UNION SELECT ano FROM cli UNION SELECT ano FROM qua UNION SELECT ano FROM adm),
grid AS (SELECT cod_mun, upper(name) AS municipio, ano FROM dim, years)
SELECT cod_mun, municipio, ano, populacao, idx_atend_agua_total, despesa_saude_pc, chuva_total_mm, pct_conformes_global, internacoes_total,
  round(CASE WHEN populacao > 0 THEN internacoes_total / populacao * 10000 END, 6) AS internacoes_total_10k
FROM grid LEFT JOIN pop USING (cod_mun, ano) LEFT JOIN srv USING (cod_mun, ano) LEFT JOIN fin USING (cod_mun, ano)
  LEFT JOIN cli USING (cod_mun, ano) LEFT JOIN qua USING (cod_mun, ano) LEFT JOIN adm USING (cod_mun, ano)"""


@query("gold_six_sources", _SIX_SQL)
def gold_six_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The gold table from all six sources, each through the plan that makes it yearly."""
    places = facts.nations(spark, folder)
    dimension = places.drop("nationkey")
    codes = places.select("nationkey", "cod_mun")
    parts = table(spark, folder, "part").filter("p_size < 40").join(codes, F.col("p_partkey") % 25 == F.col("nationkey"))
    service = parts.groupBy("cod_mun", (F.col("p_size") % 9).alias("ano")).agg(
        F.max_by("p_retailprice", "p_partkey").alias("idx_atend_agua_total")
    )
    finance = codes.select(
        F.left("cod_mun", F.lit(6)).alias("cod_mun"),
        F.lit("x").alias("municipio"),
        (F.col("nationkey") % 9).alias("ano"),
        (F.col("nationkey") / 2).alias("despesa_saude_pc"),
    )
    nothing = F.lit(None).cast("double")
    hourly = table(spark, folder, "events").select(
        (F.col("user_id") % 5).cast("string").alias("estacao"),
        (F.col("user_id") % 9).cast("int").alias("ano"),
        F.col("ts").alias("timestamp_utc"),
        (hundredths("value") / 100).alias("chuva_mm"),
        *[nothing.alias(c) for c in ("temp_c", "umid_rel_pct", "vento_vel_ms")],
    )
    bridge = codes.filter("nationkey < 20").select((F.col("nationkey") % 5).cast("string").alias("estacao"), "cod_mun")
    gold = gold_features(
        dimension,
        population_by_year(population_silver(population_rows(spark, folder)), dimension),
        service_by_year(service.withColumns({c: nothing for c in ("idx_coleta_esgoto", "idx_tratamento_esgoto")}), dimension),
        quality_by_year(quality_by_parameter(percentile_silver(spark, folder), dimension)),
        climate_by_municipality(station_year(hourly), bridge, dimension),
        finance_by_year(finance, dimension),
        admissions_by_year(admissions_silver_rows(spark, folder), dimension),
    )
    return rounded(
        gold.select(
            "cod_mun", "municipio", "ano", "populacao", "idx_atend_agua_total", "despesa_saude_pc", "chuva_total_mm",
            "pct_conformes_global", "internacoes_total", "internacoes_total_10k",
        )
    )


@query(
    "exported_csv",
    """SELECT n_nationkey, n_name, CASE WHEN n_regionkey > 1 THEN n_regionkey END AS n_regionkey, '2024-05-06T07:08:09+00:00' AS gerado_em FROM nation""",
)
def exported_csv(spark: SparkSession, folder: str) -> DataFrame:
    """A stamped export, read back."""
    path = scratch_path(spark, "export")
    nations = table(spark, folder, "nation").withColumn("n_regionkey", F.when(F.col("n_regionkey") > 1, F.col("n_regionkey")))
    export_csv(nations.withColumn("gerado_em", F.lit("2024-05-06T07:08:09+00:00")), path, ["n_nationkey"])
    return spark.read.schema("n_nationkey int, n_name string, n_regionkey int, gerado_em string").option("header", True).csv(path)
