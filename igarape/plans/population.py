"""Population: yearly estimates per municipality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.functions.numeric import to_whole
from igarape.operators.lookup import with_canonical_code
from igarape.schemas import POPULATION_SILVER, conform
from igarape.sources.delimited import read_by_header

# Silver column -> landed column.
_HEADERS = {"cod_mun": ["municipio_codigo"], "ano": ["ano"], "populacao": ["valor"]}


def read_population(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows of all yearly files; files that are empty or hold only a header add none."""
    rows = read_by_header(spark, paths, _HEADERS, required=list(_HEADERS))
    if rows.isEmpty():
        raise ValueError(f"no population rows in {paths}")
    return rows


def population_silver(rows: DataFrame) -> DataFrame:
    return conform(rows.select(*[to_whole(c).alias(c) for c in _HEADERS]), POPULATION_SILVER)


def population_by_year(silver: DataFrame, dimension: DataFrame) -> DataFrame:
    """One row per municipality and year; of a code written in six and in seven digits, the larger figure."""
    located = with_canonical_code(silver, dimension, "cod_mun")
    return located.groupBy("cod_mun", "ano").agg(F.max(F.col("populacao").cast("double")).alias("populacao"))
