"""The municipality dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.functions.text import zero_fill
from igarape.schemas import MUNICIPALITIES


def read_municipalities(spark: SparkSession, path: str) -> DataFrame:
    """name, ibge_code, uf, is_rmb with the code kept as text."""
    return spark.read.schema(MUNICIPALITIES).option("header", True).csv(path)


def municipality_dimension(table: DataFrame, members_only: bool = True) -> DataFrame:
    """(cod_mun, name) with 7-digit codes; the admissions job takes all rows, not only members."""
    rows = table.filter(F.col("is_rmb") == 1) if members_only else table
    code = zero_fill(F.trim("ibge_code"), 7)
    return rows.select(code.alias("cod_mun"), F.col("name")).dropDuplicates(["cod_mun"])
