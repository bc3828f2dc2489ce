"""Water quality: sample rows -> classified totals per supply and month -> yearly table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.constants import (
    PARAMETER_ALIASES,
    PERCENTILE_PARAMETERS,
    QUALITY_PARAMETERS,
    WATER_HEADERS,
)
from igarape.functions.classify import CONFORM, NON_CONFORM, PERCENTILE, TOTAL, UNCLASSIFIED, sample_class
from igarape.functions.numeric import decimal_comma_strict, guarded_ratio, nan_to_null, to_whole
from igarape.functions.text import alias_or_self, blank_to_null, operator_slug, padded_code_or_null
from igarape.operators.lookup import either_key, with_canonical_code
from igarape.operators.reshape import sum_by_class
from igarape.sources.delimited import SOURCE_FILE, read_archives, read_by_header

# Rows without these never count, so a file that lacks one would be lost as a whole.
_NEEDED = ["uf", "codigo", "ano_ref", "mes_ref", "parametro_texto", "campo", "valor_texto"]
_OPTIONAL_TEXT = [
    "ponto_monitoramento",
    "forma_abastecimento_tipo",
    "forma_abastecimento_nome",
    "forma_abastecimento_codigo",
    "eta_uta_nome",
    "instituicao_sigla",
    "instituicao_nome",
]
GROUP_COLUMNS = [
    "cod_mun",
    "municipio_alvo",
    "municipio_sisagua",
    "uf",
    "ano",
    "mes",
    "parametro",
    "parametro_original",
    "dataset",
    *_OPTIONAL_TEXT,
    SOURCE_FILE,
]
_CLASS_COLUMNS = {
    TOTAL: "amostras_total",
    CONFORM: "amostras_conformes",
    NON_CONFORM: "amostras_nao_conformes",
    UNCLASSIFIED: "amostras_sem_classificacao",
    PERCENTILE: "percentil_95",
}


def read_water_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Sample rows of all CSV files and ZIP archives of a folder; a file that lacks a needed column is an error."""
    wanted = {c: [h] for c, h in WATER_HEADERS.items()}
    parts = []
    for suffix in ("csv", "zip"):
        glob = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").load(folder)
        if glob.select("path").isEmpty():
            continue
        pattern = f"{folder}/*.{suffix}"
        if suffix == "csv":
            parts.append(read_by_header(spark, pattern, wanted, separator=";", encoding="ISO-8859-1", required=_NEEDED))
        else:
            parts.append(read_archives(spark, pattern, wanted, required=_NEEDED))
    if not parts:
        raise FileNotFoundError(f"no CSV or ZIP file in {folder}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def classified_samples(
    raw: DataFrame, dimension: DataFrame, uf: str = "PA", **classify_options: bool
) -> DataFrame:
    """Parsed rows of the dimension's municipalities with their class; rows that do not parse drop out."""
    names = either_key(dimension).select(
        F.col("lookup_code").alias("cod_mun"), F.col("name").alias("municipio_alvo")
    )
    rows = raw.filter(F.trim("uf") == uf).select(
        padded_code_or_null("codigo").alias("cod_mun"),
        F.coalesce(F.trim("municipio_sisagua"), F.lit("")).alias("municipio_sisagua"),
        F.trim("uf").alias("uf"),
        to_whole("ano_ref").alias("ano"),
        to_whole("mes_ref").alias("mes"),
        blank_to_null("parametro_texto").alias("parametro_original"),
        blank_to_null("campo").alias("campo"),
        decimal_comma_strict("valor_texto").alias("valor"),
        F.when(F.contains(SOURCE_FILE, F.lit("demais")), "demais_parametros")
        .otherwise("parametros_basicos")
        .alias("dataset"),
        *[F.coalesce(blank_to_null(c), F.lit("N/A")).alias(c) for c in _OPTIONAL_TEXT],
        SOURCE_FILE,
    )
    parsed = rows.dropna(subset=["cod_mun", "ano", "mes", "parametro_original", "campo", "valor"])
    parameter = alias_or_self(operator_slug("parametro_original"), PARAMETER_ALIASES)
    named = parsed.join(names, "cod_mun").withColumn("parametro", parameter)
    return named.withColumn("classificacao", sample_class("parametro", "campo", **classify_options))


def water_quality_silver(samples: DataFrame) -> DataFrame:
    """One row per group with a column per class, total fallback and percent conform.

    A group without a percentile has none: as 0 it would lower the yearly mean.
    """
    wide = sum_by_class(samples, GROUP_COLUMNS, "classificacao", "valor", _CLASS_COLUMNS, nullable=[PERCENTILE])
    decided = F.col("amostras_conformes") + F.col("amostras_nao_conformes")
    total = F.when(F.col("amostras_total") > 0, F.col("amostras_total")).otherwise(
        decided + F.col("amostras_sem_classificacao")
    )
    return wide.withColumns(
        {
            "amostras_total": total,
            "pct_conformes": guarded_ratio("amostras_conformes", decided, 100.0),
        }
    )


def quality_by_parameter(silver: DataFrame, dimension: DataFrame) -> DataFrame:
    """Yearly totals and percent conform of the total, per municipality and parameter."""
    counts = ["amostras_total", "amostras_conformes", "amostras_nao_conformes"]
    # Summed by raw code first, so that the look-up joins a few rows and not all of silver.
    by_code = silver.groupBy("cod_mun", "ano", "parametro").agg(
        *[F.sum(nan_to_null(F.col(c).cast("double"))).alias(c) for c in counts],
        F.sum(nan_to_null("percentil_95")).alias("_soma"),
        F.count(nan_to_null("percentil_95")).alias("_n"),
    )
    located = with_canonical_code(by_code, dimension, "cod_mun")
    totals = located.groupBy("cod_mun", "ano", "parametro").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in counts],
        F.try_divide(F.sum("_soma"), F.sum("_n")).alias("percentil_95"),
    )
    return totals.withColumn(
        "pct_conformes_param", guarded_ratio("amostras_conformes", "amostras_total", 100.0)
    )


def quality_by_year(by_parameter: DataFrame) -> DataFrame:
    """Overall totals plus a column per parameter, in one aggregate over the parameter totals."""
    totals = {
        "sisagua_amostras_total": "amostras_total",
        "sisagua_amostras_conformes": "amostras_conformes",
        "sisagua_amostras_nao_conformes": "amostras_nao_conformes",
    }

    def of(parameter: str, value: str) -> Column:
        # One row per (municipality, year, parameter), so max only picks the value.
        return F.max(F.when(F.col("parametro") == parameter, F.col(value)))

    wide = by_parameter.groupBy("cod_mun", "ano").agg(
        *[F.sum(c).alias(n) for n, c in totals.items()],
        *[of(p, "pct_conformes_param").alias(f"pct_conformes_{p}") for p in QUALITY_PARAMETERS],
        *[of(p, "percentil_95").alias(f"percentil95_{p}") for p in PERCENTILE_PARAMETERS],
    )
    overall = guarded_ratio("sisagua_amostras_conformes", "sisagua_amostras_total", 100.0)
    by_column = [c for c in wide.columns if c.startswith(("pct_conformes_", "percentil95_"))]
    return wide.select("cod_mun", "ano", *totals, overall.alias("pct_conformes_global"), *by_column)
