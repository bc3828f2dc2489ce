"""Service indicators: spreadsheet cells -> one provider row per municipality and year -> repaired table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.constants import (
    GOLD_SERVICE_COLUMNS,
    PERCENT_REPAIR_COLUMNS,
    PERCENT_REPAIR_LIMIT,
    PHYSICAL_REPAIR_COLUMNS,
    PHYSICAL_REPAIR_LIMIT,
    PROVIDER_SCORE_COLUMNS,
    SERVICE_INDICATORS,
)
from igarape.functions.numeric import decimal_comma, sum_skipping_null, to_number
from igarape.functions.text import code_run, digits_only, upper_ascii
from igarape.operators.lookup import with_canonical_code
from igarape.operators.ordering import first_row_per_key
from igarape.operators.reshape import keys_first, project_known
from igarape.operators.scale import repair_columns
from igarape.sources.sheets import sheet_records


def extracted_indicators(cells: DataFrame, dimension: DataFrame, uf: str = "PA") -> DataFrame:
    """Largest value of every indicator per workbook, sheet, year, code and municipality name.

    The year is the first 20xx in the workbook's path.
    """
    records = sheet_records(cells)
    in_state = ~F.col("has_uf") | (upper_ascii("uf") == uf)
    members = dimension.select(upper_ascii("name").alias("_name"))
    listed = records.filter(in_state).join(
        members, upper_ascii("municipio") == F.col("_name"), "left_semi"
    )
    typed = listed.select(
        "file",
        "sheet",
        F.regexp_extract("file", r"(20\d{2})", 1).try_cast("int").alias("ano"),
        F.regexp_extract("file", r"([^/]+?)(\.[^./]*)?$", 1).alias("fonte_planilha"),
        code_run("cod_mun").alias("cod_mun"),
        "municipio",
        *[decimal_comma(c).alias(c) for c in SERVICE_INDICATORS],
    ).filter(F.col("cod_mun").isNotNull())
    return typed.groupBy("file", "sheet", "fonte_planilha", "ano", "cod_mun", "municipio").agg(
        *[F.max(c).alias(c) for c in SERVICE_INDICATORS]
    )


def one_provider_per_municipality(extracted: DataFrame) -> DataFrame:
    """Per year and code: first municipality name, then the highest score; ties by workbook and sheet."""
    score = sum_skipping_null(PROVIDER_SCORE_COLUMNS)
    best = first_row_per_key(
        extracted,
        ["ano", "cod_mun"],
        [F.col("municipio"), -score, F.col("file"), F.col("sheet")],
    )
    return best.select("cod_mun", "municipio", "ano", "fonte_planilha", *SERVICE_INDICATORS)


def repaired_codes(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Code by municipality name, compared without accents; else six digits get a leading 0, longer codes keep seven."""
    digits = F.nullif(digits_only(F.trim(F.col("cod_mun").cast("string"))), F.lit(""))
    by_digits = F.when(F.length(digits) == 6, F.concat(F.lit("0"), digits)).otherwise(
        F.left(digits, F.lit(7))
    )
    # Two municipalities never share a folded name within the dimension; max keeps the key unique anyway.
    names = dimension.groupBy(upper_ascii("name").alias("_name")).agg(F.max("cod_mun").alias("_code"))
    named = df.join(names, upper_ascii(F.trim("municipio")) == F.col("_name"), "left")
    return named.withColumn("cod_mun", F.coalesce(F.col("_code"), by_digits)).drop("_name", "_code")


def repaired_indicators(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Second version of the table: repaired codes and scales."""
    coded = repaired_codes(df, dimension)
    known = [c for c in PERCENT_REPAIR_COLUMNS + PHYSICAL_REPAIR_COLUMNS if c in coded.columns]
    numeric = coded.withColumns({c: to_number(c) for c in known})
    percents = repair_columns(numeric, PERCENT_REPAIR_COLUMNS, PERCENT_REPAIR_LIMIT)
    scaled = repair_columns(percents, PHYSICAL_REPAIR_COLUMNS, PHYSICAL_REPAIR_LIMIT)
    return keys_first(scaled, ["cod_mun", "municipio", "ano"])


def service_by_year(repaired: DataFrame, dimension: DataFrame) -> DataFrame:
    """One row per municipality and year: codes of six and of seven digits are one, the fuller row stays."""
    located = with_canonical_code(repaired, dimension, "cod_mun")
    score = sum_skipping_null([c for c in PROVIDER_SCORE_COLUMNS if c in located.columns])
    known = project_known(located.withColumn("_score", score), ["cod_mun", "ano", *GOLD_SERVICE_COLUMNS, "_score"])
    figures = [F.col(c) for c in known.columns if c not in ("cod_mun", "ano", "_score")]
    return first_row_per_key(known, ["cod_mun", "ano"], [-F.col("_score"), *figures]).drop("_score")
