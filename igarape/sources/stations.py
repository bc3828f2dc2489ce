"""Hourly station files: preamble, varying headers, decimal comma, missing marks."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.constants import STATION_HEADERS, STATION_MISSING, STATION_PREAMBLE_LINES
from igarape.sources.delimited import SOURCE_FILE, read_by_header

_STATION = r"_(A\d{3})_"


def header_text(header: str) -> str:
    """Header without accents and symbols, in lower case.

    Applied to the accepted names as well, so a name written with a symbol still
    matches.
    """
    plain = unicodedata.normalize("NFKD", header).encode("ascii", "ignore").decode("ascii")
    return plain.lower().strip()


def _is_dated(date: Column) -> Column:
    return date.rlike(r"^\d{4}[-/]\d{2}[-/]\d{2}$")


def read_stations(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Standard columns as text with missing marks as NULL, plus the station code.

    Files whose name has no station code are skipped.
    """
    rows = read_by_header(
        spark,
        paths,
        STATION_HEADERS,
        separator=";",
        encoding="ISO-8859-1",
        skip_lines=STATION_PREAMBLE_LINES,
        normalise=header_text,
        is_data=("data", _is_dated),
        required=["data"],
    )
    station = F.regexp_extract(SOURCE_FILE, _STATION, 1)
    values = {
        c: F.when(~F.trim(c).isin(STATION_MISSING), F.trim(c)) for c in STATION_HEADERS
    }
    return rows.withColumns({"estacao": station, **values}).filter(station != "").drop(SOURCE_FILE)
