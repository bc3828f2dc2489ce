"""Text, number and date rules over whole texts and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.constants import PARAMETER_ALIASES
from igarape.functions.classify import sample_class
from igarape.functions.dates import hour_text, station_timestamp
from igarape.functions.numeric import (
    decimal_comma,
    decimal_comma_strict,
    numbers_in_text,
    to_number,
    to_whole,
)
from igarape.functions.text import (
    alias_or_self,
    clean_label,
    compact_slug,
    indicator_code,
    label_slug,
    operator_slug,
    repair_mojibake,
    strip_accents,
    to_ascii,
)
from igarape.queries.registry import query, table


@query(
    "strip_accents",
    r"""SELECT doc_id, lang, md5(strip_accents(text)) AS sem_acentos,
         md5(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')) AS ascii FROM documents""",
)
def accents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", "lang", F.md5(strip_accents("text")).alias("sem_acentos"), F.md5(to_ascii("text")).alias("ascii")
    )


@query("mojibake_repair", "SELECT doc_id, md5(text) AS reparado, md5(text) AS mantido FROM documents")
def mojibake(spark: SparkSession, folder: str) -> DataFrame:
    """Texts read with the wrong encoding come back, and good texts stay as they are."""
    garbled = F.decode(F.encode("text", "utf-8"), "iso-8859-1")
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(repair_mojibake(garbled)).alias("reparado"), F.md5(repair_mojibake("text")).alias("mantido")
    )


_LABEL_SQL = "p_name || ' (' || p_type || ') >= ' || p_size || '% / ' || p_brand || ' <' || (p_size + 1)"


def _label():
    size = F.col("p_size").cast("string")
    return F.concat(
        "p_name", F.lit(" ("), "p_type", F.lit(") >= "), size, F.lit("% / "), "p_brand", F.lit(" <"),
        (F.col("p_size") + 1).cast("string"),
    )


@query(
    "slugify_ops",
    f"""SELECT p_partkey, trim(regexp_replace(lower(replace(replace(replace({_LABEL_SQL},
      '>=', ' gte '), '%', ' pct '), '<', ' lt ')), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part""",
)
def slugify_ops(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select("p_partkey", operator_slug(_label()).alias("slug"))


@query(
    "slugify_label",
    """SELECT doc_id,
         md5(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', '_', 'g'), '_')) AS slug,
         md5(trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')),
           '[^a-z0-9_ ]', '', 'g'), ' +', '_', 'g'), '_')) AS slug_compacto
    FROM documents""",
)
def slugify_label(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(label_slug("text")).alias("slug"), F.md5(compact_slug("text")).alias("slug_compacto")
    )


@query(
    "text_case_trim",
    """SELECT doc_id, md5(upper(text)) AS maiusculas, md5(lower(text)) AS minusculas,
         md5(trim(replace(' -' || text || '- ', chr(10), ' '), ' -')) AS rotulo
    FROM (SELECT doc_id, replace(text, 'ß', 'ss') AS text FROM documents)""",
)
def text_case_trim(spark: SparkSession, folder: str) -> DataFrame:
    # "ß" upper-cases to "SS" in one engine and stays in the other, so it is spelled out first.
    text = F.replace("text", F.lit("ß"), F.lit("ss"))
    return table(spark, folder, "documents").select(
        "doc_id",
        F.md5(F.upper(text)).alias("maiusculas"),
        F.md5(F.lower(text)).alias("minusculas"),
        F.md5(clean_label(F.concat(F.lit(" -"), text, F.lit("- ")))).alias("rotulo"),
    )


# Part types under the parameter names found in raw files; unknown ones keep their slug.
_NAMES = {"ECONOMY": "Cloro residual livre (mg/L)", "LARGE": "Turbidez (uT)", "MEDIUM": "pH", "PROMO": "Cor (uH)"}


@query(
    "alias_map_default",
    """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'cloro_residual_livre' WHEN 'LARGE' THEN 'turbidez'
         WHEN 'MEDIUM' THEN 'ph' WHEN 'PROMO' THEN 'cor' ELSE lower(p_type) END AS parametro FROM part""",
)
def alias_map_default(spark: SparkSession, folder: str) -> DataFrame:
    name = alias_or_self("p_type", _NAMES)
    return table(spark, folder, "part").select(
        "p_partkey", alias_or_self(operator_slug(name), PARAMETER_ALIASES).alias("parametro")
    )


@query(
    "numbers_in_text",
    r"""WITH found AS (
      SELECT doc_id, list_transform(regexp_extract_all(text, '\d+(?:[.,]\d+)?'),
               lambda x: CAST(replace(replace(x, '.', ''), ',', '.') AS DOUBLE)) AS numeros FROM documents)
    SELECT doc_id, CAST(len(numeros) AS INTEGER) AS quantos, list_min(numeros) AS menor, list_max(numeros) AS maior,
           numeros[1] AS primeiro, numeros[2] AS segundo FROM found""",
)
def numbers(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "documents").select("doc_id", numbers_in_text("text").alias("numeros"))
    return found.select(
        "doc_id",
        F.size("numeros").alias("quantos"),
        F.array_min("numeros").alias("menor"),
        F.array_max("numeros").alias("maior"),
        F.get("numeros", F.lit(0)).alias("primeiro"),
        F.get("numeros", F.lit(1)).alias("segundo"),
    )


@query(
    "indicator_code",
    """SELECT p_partkey, CASE WHEN p_size - (p_size // 10) * 10 = 0 THEN CAST(p_size // 10 AS VARCHAR)
         ELSE CAST(p_size // 10 AS VARCHAR) || '.' || CAST(p_size - (p_size // 10) * 10 AS VARCHAR) END AS codigo
    FROM part""",
)
def indicator_codes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select("p_partkey", indicator_code(F.col("p_size") / 10).alias("codigo"))


# Samples made from line items: the line number picks the parameter, flag and quantity make the label.
_SAMPLE_SQL = """smp AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS flag, CAST(l_quantity AS INTEGER) AS q,
    CASE l_linenumber WHEN 1 THEN 'turbidez' WHEN 2 THEN 'ph' WHEN 3 THEN 'cloro_residual_livre'
      WHEN 4 THEN 'coliformes_totais' WHEN 5 THEN 'cor' WHEN 6 THEN 'fluoreto' ELSE 'nitrato' END AS parametro
  FROM lineitem),
lab AS (
  SELECT *, CASE
    WHEN l_suppkey < 3 THEN 'Número de amostras analisadas'
    WHEN l_suppkey < 6 THEN 'Percentil 95'
    WHEN parametro = 'coliformes_totais' THEN CASE flag WHEN 'A' THEN 'Ausência' WHEN 'R' THEN 'Presença' ELSE 'outro' END
    WHEN parametro = 'cloro_residual_livre' THEN CASE flag WHEN 'A' THEN '>= 0,2 mg/L e <= 2,0 mg/L' WHEN 'R' THEN '> 5,0' ELSE '< 0,1' END
    WHEN flag = 'A' THEN '≤ ' || q || ',5'
    WHEN flag = 'R' THEN '> ' || q || ',5'
    ELSE '>= ' || q || ',0 e <= ' || (q + 3) || ',0' END AS campo
  FROM smp)"""


@query(
    "classify_rules",
    f"""WITH {_SAMPLE_SQL}
    SELECT parametro, campo, classificacao, count(*) AS n FROM (
      SELECT parametro, campo, CASE
        WHEN campo = 'Número de amostras analisadas' THEN 'total'
        WHEN campo = 'Percentil 95' THEN 'percentil_95'
        WHEN campo = 'Ausência' THEN 'conforme'
        WHEN campo = 'Presença' THEN 'nao_conforme'
        WHEN parametro = 'cloro_residual_livre' THEN CASE flag WHEN 'A' THEN 'conforme' WHEN 'R' THEN 'nao_conforme'
          ELSE 'nao_classificado' END
        WHEN parametro IN ('turbidez', 'cor', 'fluoreto') THEN CASE
          WHEN flag = 'A' AND q + 0.5 <= CASE parametro WHEN 'turbidez' THEN 5 WHEN 'cor' THEN 15 ELSE 1.5 END THEN 'conforme'
          WHEN flag = 'R' AND q + 0.5 > CASE parametro WHEN 'turbidez' THEN 5 WHEN 'cor' THEN 15 ELSE 1.5 END THEN 'nao_conforme'
          WHEN flag = 'N' AND q + 3 <= CASE parametro WHEN 'turbidez' THEN 5 WHEN 'cor' THEN 15 ELSE 1.5 END THEN 'conforme'
          ELSE 'nao_classificado' END
        WHEN parametro = 'ph' THEN CASE
          WHEN flag = 'N' AND q >= 6 AND q + 3 <= 9.5 THEN 'conforme'
          WHEN flag IN ('A', 'N') AND q + CASE flag WHEN 'A' THEN 0.5 ELSE 3 END < 6 THEN 'nao_conforme'
          WHEN flag = 'R' AND q + 0.5 > 9.5 THEN 'nao_conforme'
          WHEN flag = 'N' AND q > 9.5 THEN 'nao_conforme'
          ELSE 'nao_classificado' END
        ELSE 'nao_classificado' END AS classificacao
      FROM lab)
    GROUP BY 1, 2, 3""",
)
def classify_rules(spark: SparkSession, folder: str) -> DataFrame:
    flag, line, q = F.col("l_returnflag"), F.col("l_linenumber"), F.col("l_quantity").cast("int")
    parameter = (
        F.when(line == 1, "turbidez").when(line == 2, "ph").when(line == 3, "cloro_residual_livre")
        .when(line == 4, "coliformes_totais").when(line == 5, "cor").when(line == 6, "fluoreto").otherwise("nitrato")
    )
    presence = F.when(flag == "A", "Ausência").when(flag == "R", "Presença").otherwise("outro")
    chlorine = F.when(flag == "A", ">= 0,2 mg/L e <= 2,0 mg/L").when(flag == "R", "> 5,0").otherwise("< 0,1")
    half = F.concat(q.cast("string"), F.lit(",5"))
    label = (
        F.when(F.col("l_suppkey") < 3, "Número de amostras analisadas")
        .when(F.col("l_suppkey") < 6, "Percentil 95")
        .when(line == 4, presence)
        .when(line == 3, chlorine)
        .when(flag == "A", F.concat(F.lit("≤ "), half))
        .when(flag == "R", F.concat(F.lit("> "), half))
        .otherwise(F.concat(F.lit(">= "), q.cast("string"), F.lit(",0 e <= "), (q + 3).cast("string"), F.lit(",0")))
    )
    samples = table(spark, folder, "lineitem").select(parameter.alias("parametro"), label.alias("campo"))
    # Labels repeat a lot: count them first, then classify each distinct one once.
    counted = samples.groupBy("parametro", "campo").agg(F.count("*").alias("n"))
    return counted.withColumn("classificacao", sample_class("parametro", "campo"))


# Balances as Brazilian text: thousands by dots, a decimal comma.
_CENTS = "CAST(round(abs(s_acctbal) * 100) AS BIGINT)"
_BRAZILIAN_SQL = f"""CASE WHEN s_acctbal < 0 THEN '-' ELSE '' END
  || CASE WHEN {_CENTS} >= 100000 THEN CAST({_CENTS} // 100000 AS VARCHAR) || '.'
       || lpad(CAST(({_CENTS} // 100) - ({_CENTS} // 100000) * 1000 AS VARCHAR), 3, '0')
     ELSE CAST({_CENTS} // 100 AS VARCHAR) END
  || ',' || lpad(CAST({_CENTS} - ({_CENTS} // 100) * 100 AS VARCHAR), 2, '0')"""


def _brazilian():
    """1234.5 as "1.234,50"."""
    return F.translate(F.format_number("s_acctbal", 2), ",.", ".,")


@query(
    "parse_decimal_comma",
    f"""SELECT s_suppkey, 'R$ ' || {_BRAZILIAN_SQL} AS texto, s_acctbal AS valor,
         CASE WHEN s_acctbal >= 1000 THEN s_acctbal END AS com_ponto, CAST(NULL AS DOUBLE) AS vazio FROM supplier""",
)
def parse_decimal_comma(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(F.lit("R$ "), _brazilian())
    plain = F.when(F.col("s_acctbal") >= 1000, F.format_string("%.2f", "s_acctbal"))
    return table(spark, folder, "supplier").select(
        "s_suppkey",
        text.alias("texto"),
        decimal_comma(text).alias("valor"),
        decimal_comma(plain).alias("com_ponto"),
        decimal_comma(F.lit(" - ")).alias("vazio"),
    )


@query(
    "parse_decimal_strict",
    f"""SELECT s_suppkey, s_acctbal AS valor, CAST({_CENTS} * sign(s_acctbal) AS DOUBLE) AS com_ponto,
         CAST(NULL AS DOUBLE) AS vazio FROM supplier""",
)
def parse_decimal_strict(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        "s_suppkey",
        decimal_comma_strict(F.concat(F.lit(" "), _brazilian())).alias("valor"),
        decimal_comma_strict(F.format_string("%.2f", "s_acctbal")).alias("com_ponto"),
        decimal_comma_strict(F.lit("Sem Informacao")).alias("vazio"),
    )


@query(
    "coerce_numeric",
    """SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS valor,
         CAST(CASE WHEN s_acctbal >= 0 THEN trunc(s_acctbal) END AS INTEGER) AS inteiro FROM supplier""",
)
def coerce_numeric(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("s_acctbal") < 0, "sem dado").otherwise(F.format_string(" %.2f ", "s_acctbal"))
    return table(spark, folder, "supplier").select(
        "s_suppkey", to_number(text).alias("valor"), to_whole(text).alias("inteiro")
    )


@query(
    "parse_two_formats",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('hour', ts) END AS instante,
      CASE WHEN event_type <> 'error' THEN CAST(year(ts) AS INTEGER) END AS ano,
      CASE WHEN event_type <> 'error' THEN CAST(month(ts) AS INTEGER) END AS mes FROM events""",
)
def parse_two_formats(spark: SparkSession, folder: str) -> DataFrame:
    slashed = F.col("event_type").isin("view", "click")
    date = (
        F.when(F.col("event_type") == "error", "sem data")
        .when(slashed, F.date_format("ts", "yyyy/MM/dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    hour = F.when(slashed, F.date_format("ts", "HH00 'UTC'")).otherwise(F.date_format("ts", "HH:00"))
    parsed = table(spark, folder, "events").select("event_id", station_timestamp(date, hour).alias("instante"))
    return parsed.select("*", F.year("instante").alias("ano"), F.month("instante").alias("mes"))


@query(
    "parse_hour_text",
    """SELECT event_id, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || '00' AS hora, lpad(CAST(hour(ts) AS VARCHAR), 4, '0')
      AS hora_curta FROM events""",
)
def parse_hour_text(spark: SparkSession, folder: str) -> DataFrame:
    long_form = F.when(F.col("event_type") == "view", F.date_format("ts", "HH00 'UTC'")).otherwise(
        F.date_format("ts", "HH:00")
    )
    return table(spark, folder, "events").select(
        "event_id", hour_text(long_form).alias("hora"), hour_text(F.hour("ts")).alias("hora_curta")
    )
