"""Landed API payloads: JSON arrays, one per file.

A file is read as a stream by one task, element by element, and is never held whole; files are
spread over tasks.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from igarape.constants import FINANCE_INDICATORS, SUBFUNCTION_COLUMNS
from igarape.schemas import FINANCE_PAYLOAD, POPULATION_FIELDS, RESOURCE_PAYLOAD
from igarape.sources.files import list_files, open_path

# Landed file names carry the request: <municipality>_<year>_<period>.json
_REQUEST = r"(\d{6,7})_(\d{4})_(\d+)\.json$"
_CHUNK = 1 << 20
_ELEMENTS = 4096


def array_elements(read, chunk: int = _CHUNK) -> Iterator[tuple[str | None, str | None]]:
    """(element, None) of the JSON array that `read(bytes)` delivers, each as text; (None, rest) where it breaks off.

    Holds one element and one chunk. A byte order mark and white space around elements are skipped.
    """
    decoder, text = json.JSONDecoder(), codecs.getincrementaldecoder("utf-8-sig")("replace")
    held, at, opened, after, ended = "", 0, False, False, False

    def more() -> bool:
        nonlocal held, at, ended
        if ended:
            return False
        got = read(chunk)
        ended = not got
        held, at = held[at:] + text.decode(got, ended), 0
        return True

    while True:
        while at < len(held) and held[at] in " \t\r\n":
            at += 1
        if at == len(held):
            if more():
                continue
            if opened:
                yield None, ""
            return
        sign = held[at]
        if not opened:
            if sign != "[":
                yield None, held[at : at + 200]
                return
            opened, at = True, at + 1
        elif sign == "]":
            return
        elif sign == "," and after:
            after, at = False, at + 1
        elif after:
            yield None, held[at : at + 200]
            return
        else:
            try:
                _, end = decoder.raw_decode(held, at)
                # A number may go on: after its last digit, point or exponent.
                open_ = sign in "-0123456789" and end + 2 >= len(held) and held[end : end + 1] in (".", "e", "E")
                whole = ended or (end < len(held) and not open_)
            except ValueError:
                whole = False
                if ended:
                    yield None, held[at : at + 200]
                    return
            if whole:
                yield held[at:end], None
                at, after = end, True
            else:
                more()


def read_payloads(spark: SparkSession, paths: str | list[str], schema: T.ArrayType, corrupt: str | None = None) -> DataFrame:
    """(file, position, item fields...) for every array element.

    An array that breaks off, or a file that is none, is an error naming the file; with `corrupt`,
    it is a row whose column of that name holds what could not be read.
    """

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_path(path) as raw:
                    name, position, rows = path.rsplit("/", 1)[-1], 0, []
                    for element, rest in array_elements(raw.read):
                        rows.append((name, position, element, rest))
                        position += 1
                        if len(rows) == _ELEMENTS:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    files = list_files(spark, paths).select("path").repartition(spark.sparkContext.defaultParallelism * 4, "path")
    found = files.mapInArrow(elements, "arquivo string, posicao int, element string, rest string")
    item = F.from_json("element", schema.elementType)
    if corrupt:
        return found.select("arquivo", "posicao", item.alias("item"), F.col("rest").alias(corrupt)).select("arquivo", "posicao", "item.*", corrupt)
    broken = F.raise_error(F.concat(F.lit("not a whole JSON array: "), F.col("arquivo"))).cast(schema.elementType)
    return found.select("arquivo", "posicao", F.when(F.col("rest").isNotNull(), broken).otherwise(item).alias("item")).select(
        "arquivo", "posicao", "item.*"
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"arquivo": pa.string(), "posicao": pa.int32(), "element": pa.string(), "rest": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], list(kinds))


def _request_part(group: int) -> Column:
    return F.regexp_extract("arquivo", _REQUEST, group).try_cast("int")


def _with_request(items: DataFrame) -> DataFrame:
    return items.withColumns(
        {"cod_mun": _request_part(1), "ano": _request_part(2), "periodo": _request_part(3)}
    )


def finance_indicators(
    spark: SparkSession, paths: str | list[str], codes: Sequence[str] = tuple(FINANCE_INDICATORS)
) -> DataFrame:
    items = _with_request(read_payloads(spark, paths, FINANCE_PAYLOAD))
    return items.filter(F.col("numero_indicador").isin(list(codes))).select(
        "cod_mun",
        "ano",
        "periodo",
        "numero_indicador",
        "ds_indicador",
        "numerador",
        "denominador",
        F.col("indicador_calculado").alias("valor"),
    )


def finance_subfunctions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The kept columns; those a payload lacks are NULL, because the schema names them all."""
    item = T.StructType([T.StructField(c, T.StringType()) for c in SUBFUNCTION_COLUMNS])
    items = _with_request(read_payloads(spark, paths, T.ArrayType(item)))
    return items.select("cod_mun", "ano", "periodo", *SUBFUNCTION_COLUMNS)


def population_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Population payload; its first element repeats the column titles and is skipped."""
    item = T.StructType([T.StructField(f, T.StringType()) for f in POPULATION_FIELDS])
    items = read_payloads(spark, paths, T.ArrayType(item)).filter(F.col("posicao") > 0)
    return items.select(*[F.col(f).alias(c) for f, c in POPULATION_FIELDS.items()])


def wanted_resources(
    spark: SparkSession, paths: str | list[str], formats: Sequence[str] = ("CSV", "ZIP", "JSON", "XML")
) -> DataFrame:
    """Resources of an allowed format that have an address."""
    items = read_payloads(spark, paths, RESOURCE_PAYLOAD)
    allowed = [f.strip().upper() for f in formats]
    return items.filter(
        F.upper("format").isin(allowed) & (F.length(F.coalesce("url", F.lit(""))) > 0)
    ).select("arquivo", F.upper("format").alias("format"), "url")
