"""What jobs do over several steps: totals kept per file, landed answers, the whole water-quality plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from igarape.operators.accumulate import PartialStates
from igarape.plans import water_quality
from igarape.queries import facts
from igarape.queries.facts import hundredths
from igarape.queries.registry import query, rounded, table
from igarape.session import cut_lineage, scratch_path
from igarape.sources.delimited import SOURCE_FILE
from igarape.sources.payloads import read_payloads


@query(
    "accumulated_totals",
    """SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS n,
      CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total,
      CAST(min(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS low, CAST(max(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS high
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2""",
)
def accumulated_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of three files, one for each order status: put in one by one, one of them twice, another taken out again."""
    orders = table(spark, folder, "orders").select(
        F.concat("o_orderstatus", F.lit(".csv")).alias(SOURCE_FILE),
        "o_orderpriority",
        F.year("o_orderdate").alias("ano"),
        hundredths("o_totalprice").alias("value"),
    )
    states = PartialStates(spark, scratch_path(spark, "states"), ["o_orderpriority", "ano"], {"value": F.col("value")})
    for name in ("F.csv", "P.csv", "O.csv", "F.csv"):
        files = spark.range(1).select(F.lit(name).alias("_file"), F.lit(1).cast("long").alias("_size"), F.lit(1).cast("long").alias("_changed"))
        states.absorb(orders.filter(F.col(SOURCE_FILE) == name), files, SOURCE_FILE)
    states.withdraw(["P.csv"])
    return states.total().select(
        "o_orderpriority",
        "ano",
        F.col("rows").alias("n"),
        F.col("sum_value").alias("total"),
        F.col("low_value").alias("low"),
        F.col("high_value").alias("high"),
    )


@query(
    "payload_elements",
    """SELECT c_nationkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER) AS posicao,
      c_custkey, c_mktsegment FROM customer""",
)
def payload_elements(spark: SparkSession, folder: str) -> DataFrame:
    """Landed arrays, one for each nation, read element by element."""
    item = F.struct("c_custkey", "c_nationkey", F.concat("c_mktsegment", F.lit('",]é')).alias("c_mktsegment"))
    arrays = (
        table(spark, folder, "customer")
        .groupBy(F.col("c_nationkey").alias("nation"))
        .agg(F.to_json(F.sort_array(F.collect_list(item))).alias("value"))
    )
    landed = scratch_path(spark, "landed")
    arrays.repartition("nation").write.partitionBy("nation").text(landed)
    schema = T.ArrayType(T.StructType.fromDDL("c_custkey bigint, c_nationkey int, c_mktsegment string"))
    found = read_payloads(spark, f"{landed}/*/*.txt", schema)
    return found.select("c_nationkey", "posicao", "c_custkey", F.replace("c_mktsegment", F.lit('",]é')).alias("c_mktsegment"))


_FIELDS = {0: "Número de amostras analisadas", 1: "<= 5,0", 2: "> 6,0", 3: "Percentil 95", 4: "outro", 5: "<= 5,0", 6: "> 6,0"}


@query(
    "water_quality_plan",
    f"""WITH {facts.DIM_SQL},
    items AS (
      SELECT CASE WHEN month(l_shipdate) > 6 THEN left(d.cod_mun, 6) ELSE d.cod_mun END AS cod_mun, d.name, CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes, l_returnflag AS place,
        l_linenumber % 7 AS field, CAST(l_quantity AS BIGINT) AS q
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN dim d ON s_nationkey = d.nationkey WHERE l_orderkey % 11 <> 3),
    summed AS (
      SELECT cod_mun, name AS municipio_alvo, ano, mes, place AS ponto_monitoramento,
        coalesce(sum(q) FILTER (WHERE field = 0), 0) AS total, coalesce(sum(q) FILTER (WHERE field IN (1, 5)), 0) AS good,
        coalesce(sum(q) FILTER (WHERE field IN (2, 6)), 0) AS bad, coalesce(sum(q) FILTER (WHERE field = 4), 0) AS other,
        sum(q) FILTER (WHERE field = 3) AS p95
      FROM items GROUP BY ALL)
    SELECT cod_mun, municipio_alvo, ano, mes, ponto_monitoramento,
      CAST(CASE WHEN total > 0 THEN total ELSE good + bad + other END AS DOUBLE) AS amostras_total,
      CAST(good AS DOUBLE) AS amostras_conformes, CAST(bad AS DOUBLE) AS amostras_nao_conformes,
      CAST(other AS DOUBLE) AS amostras_sem_classificacao, CAST(p95 AS DOUBLE) AS percentil_95,
      round(CASE WHEN good + bad > 0 THEN good / (good + bad) * 100 END, 6) AS pct_conformes
    FROM summed""",
)
def water_quality_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Raw sample rows, with numbers as text and six- or seven-digit codes, to the silver table."""
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nationkey"))
    codes = facts.nations(spark, folder).select("nationkey", F.col("cod_mun").alias("code"))
    # Summed before the joins, so that no supplier's rows meet in one task.
    quantity = F.sum(F.col("l_quantity").cast("long")).alias("q")
    items = table(spark, folder, "lineitem").groupBy(
        "l_suppkey",
        F.year("l_shipdate").alias("ano"),
        F.month("l_shipdate").alias("mes"),
        "l_returnflag",
        (F.col("l_linenumber") % 7).alias("field"),
        (F.col("l_orderkey") % 11 == 3).alias("away"),
    ).agg(quantity)
    fields = F.create_map(*[F.lit(x) for pair in _FIELDS.items() for x in pair])
    nothing = F.lit(None).cast("string")
    raw = items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(codes, "nationkey").select(
        F.when(F.col("away"), "AM").otherwise(" PA ").alias("uf"),
        F.when(F.col("mes") > 6, F.left("code", F.lit(6))).otherwise(F.col("code")).alias("codigo"),
        F.lit("x").alias("municipio_sisagua"),
        F.concat(F.col("ano").cast("string"), F.lit(".0")).alias("ano_ref"),
        F.col("mes").cast("string").alias("mes_ref"),
        F.lit("Turbidez (uT)").alias("parametro_texto"),
        fields[F.col("field")].alias("campo"),
        F.concat(F.col("q").cast("string"), F.lit(",0")).alias("valor_texto"),
        F.col("l_returnflag").alias("ponto_monitoramento"),
        *[nothing.alias(c) for c in water_quality.GROUP_COLUMNS[10:-1]],
        F.lit("controle.csv").alias(SOURCE_FILE),
    )
    samples = water_quality.classified_samples(raw, facts.nations(spark, folder).drop("nationkey"))
    silver = water_quality.water_quality_silver(cut_lineage(samples, "samples"))
    return rounded(
        silver.select(
            "cod_mun", "municipio_alvo", "ano", "mes", "ponto_monitoramento", "amostras_total", "amostras_conformes",
            "amostras_nao_conformes", "amostras_sem_classificacao", "percentil_95", "pct_conformes",
        )
    )
