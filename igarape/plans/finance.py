"""Health finance: indicator rows -> one row per municipality and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.constants import FINANCE_INDICATORS
from igarape.functions.numeric import to_number, to_whole
from igarape.functions.text import indicator_code, zero_fill
from igarape.operators.lookup import either_key, require_all_found, with_canonical_code
from igarape.operators.reshape import cells_to_columns
from igarape.schemas import FINANCE_SILVER, conform
from igarape.sources.delimited import SOURCE_FILE, read_by_header

_COLUMNS = ["cod_mun", "ano", "periodo", "numero_indicador", "numerador", "denominador"]


def read_finance_indicators(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    rows = read_by_header(spark, paths, {c: [c] for c in _COLUMNS}, required=_COLUMNS)
    return rows.select(
        "cod_mun",
        to_whole("ano").alias("ano"),
        to_whole("periodo").alias("periodo"),
        *[to_number(c).alias(c) for c in _COLUMNS[3:]],
        SOURCE_FILE,
    )


def finance_silver(indicators: DataFrame, dimension: DataFrame, report: str | None = None) -> DataFrame:
    """Scaled ratios by indicator, two decimals; a code without a municipality is an error, see `require_all_found`.

    Rows of a municipality count together, whether its code has six or seven digits.
    """
    listed = indicators.withColumns(
        {
            "lookup_code": zero_fill(F.col("cod_mun").cast("string"), 6),
            "codigo": indicator_code("numero_indicador"),
        }
    ).filter(F.col("codigo").isin(list(FINANCE_INDICATORS)))
    keys = either_key(dimension).select("lookup_code", F.col("cod_mun").alias("cod_mun_7"), F.upper("name").alias("municipio"))
    require_all_found(listed, keys, "lookup_code", report)
    coded = listed.join(keys, "lookup_code").withColumn("cod_mun", F.col("cod_mun_7"))
    scale = F.create_map(
        *[F.lit(x) for code, (_, factor) in FINANCE_INDICATORS.items() for x in (code, factor)]
    )
    ratio = F.when(F.col("denominador") != 0, F.col("numerador") / F.col("denominador"))
    columns = {code: column for code, (column, _) in FINANCE_INDICATORS.items()}
    wide = cells_to_columns(
        coded,
        ["cod_mun", "municipio", "ano"],
        "codigo",
        ratio * F.try_element_at(scale, F.col("codigo")),
        columns,
        order=["periodo"],
    )
    rounded = wide.withColumns({c: F.bround(c, 2) for c in columns.values()})
    return conform(rounded, FINANCE_SILVER)


def finance_by_year(silver: DataFrame, dimension: DataFrame) -> DataFrame:
    return with_canonical_code(silver.drop("municipio"), dimension, "cod_mun")
