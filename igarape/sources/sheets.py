"""Spreadsheets as a cell table (file, sheet, row, col, text) turned into named columns.

Everything about a sheet's layout (header row, code row, column names, roles) is
worked out on a few rows per sheet; the data cells meet those small tables in
joins by sheet, and are reassembled into records by one aggregate per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from igarape.constants import (
    SERVICE_INDICATORS,
    SHEET_CODE_LABELS,
    SHEET_CODE_PATTERN,
    SHEET_CODE_SEARCH_ROWS,
    SHEET_HEADER_SEARCH_ROWS,
    SHEET_KEY_ALIASES,
)
from igarape.functions.text import clean_label, contains_any, label_slug, repair_mojibake
from igarape.operators.cells import column_per_role, first_matching_row

SHEET = ["file", "sheet"]


def repaired_cells(cells: DataFrame) -> DataFrame:
    text = F.trim(repair_mojibake("text"))
    return cells.filter(F.col("text").isNotNull()).withColumn("text", text)


def header_rows(cells: DataFrame) -> DataFrame:
    """(file, sheet, header_row): first row with a municipality title and a code title."""
    top = cells.filter(F.col("row") < SHEET_HEADER_SEARCH_ROWS).withColumn("slug", label_slug("text"))
    tests = [F.contains("slug", F.lit("municipio")), F.col("slug").isin(SHEET_CODE_LABELS)]
    return first_matching_row(top, SHEET, "row", tests, "header_row")


def sheet_layout(cells: DataFrame) -> DataFrame:
    """(file, sheet, header_row, code_row, data_row); code_row is NULL where there is none."""
    headers = header_rows(cells)
    # The header lies in the first rows, and the codes a few rows below it.
    last = SHEET_HEADER_SEARCH_ROWS + SHEET_CODE_SEARCH_ROWS
    near = cells.filter(F.col("row") < last).join(headers, SHEET)
    coded = near.filter(
        (F.col("row") > F.col("header_row"))
        & (F.col("row") <= F.col("header_row") + SHEET_CODE_SEARCH_ROWS)
        & label_slug("text").rlike(SHEET_CODE_PATTERN)
    )
    codes = coded.groupBy(*SHEET).agg(F.min("row").alias("code_row"))
    return headers.join(codes, SHEET, "left").withColumn(
        "data_row", F.coalesce("code_row", "header_row") + 1
    )


def column_names(cells: DataFrame, layout: DataFrame) -> DataFrame:
    """(file, sheet, col, name, slug): title, else code, else position; repeats are numbered."""
    last = SHEET_HEADER_SEARCH_ROWS + SHEET_CODE_SEARCH_ROWS
    columns = cells.select(*SHEET, "col").distinct()
    titles = cells.filter(F.col("row") < last).join(layout, SHEET)

    def text_of(row: str) -> Column:
        return F.max(F.when(F.col("row") == F.col(row), clean_label("text")))

    found = titles.groupBy(*SHEET, "col").agg(
        F.nullif(text_of("header_row"), F.lit("")).alias("title"),
        F.nullif(text_of("code_row"), F.lit("")).alias("code"),
    )
    position = F.concat(F.lit("col_"), F.col("col").cast("string"))
    named = (
        columns.join(layout.select(*SHEET), SHEET, "left_semi")
        .join(found, [*SHEET, "col"], "left")
        .withColumn("name", F.coalesce("title", "code", position))
    )
    # A sheet has a limited number of columns, so this window is small.
    repeat = F.row_number().over(Window.partitionBy(*SHEET, label_slug("name")).orderBy("col")) - 1
    numbered = named.withColumn("repeat", repeat).withColumn(
        "name",
        F.when(F.col("repeat") > 0, F.concat_ws("_", "name", F.col("repeat").cast("string"))).otherwise(
            F.col("name")
        ),
    )
    return numbered.select(*SHEET, "col", "name", label_slug("name").alias("slug"))


def column_roles(names: DataFrame) -> DataFrame:
    """(file, sheet, role, col): key columns by preferred alias, indicators by title fragment."""
    aliases = {
        role: F.array_position(F.array(*[F.lit(a) for a in labels]), F.col("slug"))
        for role, labels in SHEET_KEY_ALIASES.items()
    }
    fragments = {
        role: contains_any("slug", parts).cast("int") for role, parts in SERVICE_INDICATORS.items()
    }
    return column_per_role(names, SHEET, "col", {**aliases, **fragments})


def sheet_records(cells: DataFrame) -> DataFrame:
    """One record per data row: file, sheet, row, the key columns and every indicator as text.

    Sheets without a header, or without both a code and a name column, give none.
    """
    fixed = repaired_cells(cells)
    layout = sheet_layout(fixed)
    roles = column_roles(column_names(fixed, layout))
    keyed = roles.groupBy(*SHEET).agg(
        F.count_if(F.col("role").isin("cod_mun", "municipio")).alias("keys"),
        F.bool_or(F.col("role") == "uf").alias("has_uf"),
    )
    usable = keyed.filter("keys = 2").join(layout.select(*SHEET, "data_row"), SHEET)
    data = (
        fixed.join(roles, [*SHEET, "col"])
        .join(usable, SHEET)
        .filter(F.col("row") >= F.col("data_row"))
    )
    picks = [
        F.max(F.when(F.col("role") == role, F.col("text"))).alias(role)
        for role in [*SHEET_KEY_ALIASES, *SERVICE_INDICATORS]
    ]
    return data.groupBy(*SHEET, "row", "has_uf").agg(*picks)
