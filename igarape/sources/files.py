"""File listing and header reading; what is found of each file stays in a table."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from igarape.session import cut_lineage


def open_path(path: str):
    """Open a file of any file system pyarrow knows (local, HDFS, object stores)."""
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        path = "file:///" + rest.lstrip("/")
    elif scheme in ("s3a", "s3n"):
        path = "s3:" + rest
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def list_files(spark: SparkSession, paths: str | list[str], changed: bool = False) -> DataFrame:
    """Paths and sizes of the files matching the globs, if asked with their times of change; the contents are not read."""
    listing = spark.read.format("binaryFile").load(paths)
    return listing.select("path", "length", *(["modificationTime"] if changed else []))


def first_lines(spark: SparkSession, paths: str | list[str], skip: int, encoding: str) -> DataFrame:
    """(path, header), written: the line after `skip` lines of each file that is not empty; '' where there is none."""

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = []
            for path in batch["path"]:
                with open_path(path) as raw:
                    text = io.TextIOWrapper(raw, encoding=encoding, errors="replace", newline="")
                    found = [text.readline() for _ in range(skip + 1)][-1]
                lines.append(found.lstrip("\ufeff").rstrip("\r\n"))
            yield pd.DataFrame({"path": batch["path"], "header": lines})

    listing = list_files(spark, paths)
    listing = listing.filter(listing.length > 0).select("path")
    # Reading a first line is short but waits on storage: spread it widely.
    spread = listing.repartition(spark.sparkContext.defaultParallelism * 2)
    found = spread.mapInPandas(headers, "path string, header string")
    return cut_lineage(found, "headers")


def split_header(line: str, separator: str) -> list[str]:
    return next(csv.reader([line], delimiter=separator))


def archive_members(
    spark: SparkSession, paths: str | list[str], suffix: str, separator: str, encoding: str
) -> DataFrame:
    """(path, member, size, header): members of archives with the suffix, their packed sizes and first lines.

    An archive without any is one row without member. Nothing of this comes to the driver.
    """

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                with open_path(path) as raw, zipfile.ZipFile(raw) as archive:
                    found = [m for m in archive.infolist() if m.filename.lower().endswith(suffix)]
                    for member in found:
                        with archive.open(member) as body:
                            rows.append((path, member.filename, member.compress_size, first_record(body, separator, encoding)))
                    if not found:
                        rows.append((path, None, 0, []))
            yield pd.DataFrame(rows, columns=["path", "member", "size", "header"])

    listing = list_files(spark, paths).select("path").repartition(spark.sparkContext.defaultParallelism * 2)
    return listing.mapInPandas(members, "path string, member string, size long, header array<string>")


def first_record(body, separator: str, encoding: str) -> list[str]:
    """The fields of the first line of a binary stream; none if it is empty."""
    text = io.TextIOWrapper(body, encoding=encoding, errors="replace", newline="")
    line = text.readline().lstrip("\ufeff").rstrip("\r\n")
    text.detach()
    return split_header(line, separator) if line else []
