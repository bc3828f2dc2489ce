"""Delimited files read by header name, although headers differ between files.

Files are grouped by where their header puts the wanted columns. Each group is
one Spark CSV scan with its own schema, so files are split over tasks and only
the wanted columns are parsed; the groups are then united by name.
"""

from __future__ import annotations

import codecs
import csv
import warnings
import zipfile
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import csv as csv_reader
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from igarape.session import cut_lineage
from igarape.sources.files import archive_members, first_lines, open_path, split_header

SOURCE_FILE = "fonte_arquivo"
# Files named in a message.
_NAMED = 20


def same_text(header: str) -> str:
    return header.strip()


def _string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _empty(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], _string_schema([*names, SOURCE_FILE]))


def positions(
    header: Sequence[str], wanted: Mapping[str, Sequence[str]], normalise: Callable[[str], str]
) -> dict[str, int]:
    """Position of each wanted column: the first header text among its accepted names."""
    texts = [normalise(h) for h in header]
    found = {}
    for column, names in wanted.items():
        accepted = {normalise(n) for n in names}
        hits = [i for i, text in enumerate(texts) if text in accepted]
        if hits:
            found[column] = hits[0]
    return found


def _lacking(count: int, named: Sequence[str]) -> ValueError:
    return ValueError(f"columns missing in {count} files: {'; '.join(named)}")


def read_by_header(
    spark: SparkSession,
    paths: str | list[str],
    wanted: Mapping[str, Sequence[str]],
    separator: str = ",",
    encoding: str = "UTF-8",
    skip_lines: int = 0,
    normalise: Callable[[str], str] = same_text,
    is_data: tuple[str, Callable[[Column], Column]] | None = None,
    required: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """All-string columns named by `wanted` (name -> accepted headers) plus the source file name.

    A column that a file lacks is NULL there; if it is `required`, that is an
    error naming the files. With `skip_lines`, the preamble and header are told
    from data by `is_data`, a wanted column and its test, since a split of a file
    does not know its line numbers. `multi_line` keeps quoted line breaks within
    a field, as the archive reader does, at the price of one task per file.
    """
    # Headers that put the wanted columns at the same places share a scan. Only different headers come
    # to the driver, and paths only where there are several layouts, for Spark's own scans to list.
    listed = first_lines(spark, paths, skip_lines, encoding)
    layouts, lacking = defaultdict(list), {}
    headers = sorted(r.header for r in listed.select("header").distinct().collect())
    for line in filter(None, headers):
        header = split_header(line, separator)
        found = positions(header, wanted, normalise)
        missing = [c for c in required if c not in found]
        if missing:
            lacking[line] = ", ".join(missing)
        layouts[len(header), tuple(found.items())].append(line)
    if lacking:
        files = listed.filter(F.col("header").isin(list(lacking)))
        named = files.orderBy("path").limit(_NAMED).collect()
        raise _lacking(files.count(), [f"{r.path} ({lacking[r.header]})" for r in named])

    def files_of(lines: Sequence[str]) -> str | list[str]:
        if len(layouts) == 1 and "" not in headers:
            return paths
        return sorted(r.path for r in listed.filter(F.col("header").isin(list(lines))).select("path").collect())

    parts = []
    for (width, found), lines in layouts.items():
        place = dict(found)
        rows = (
            spark.read.schema(_string_schema([f"c{i}" for i in range(width)]))
            .option("sep", separator)
            .option("encoding", encoding)
            .option("header", skip_lines == 0)
            .option("escape", '"')
            .option("multiLine", multi_line)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(files_of(lines))
        )
        if is_data is not None:
            column, test = is_data
            rows = rows.filter(test(F.col(f"c{place[column]}")) if column in place else F.lit(False))
        columns = [
            F.col(f"c{place[c]}").alias(c) if c in place else F.lit(None).cast("string").alias(c)
            for c in wanted
        ]
        parts.append(rows.select(*columns, F.col("_metadata.file_name").alias(SOURCE_FILE)))
    if not parts:
        return _empty(spark, list(wanted))
    return reduce(DataFrame.unionByName, parts)


def read_archives(
    spark: SparkSession,
    paths: str | list[str],
    wanted: Mapping[str, Sequence[str]],
    separator: str = ";",
    encoding: str = "ISO-8859-1",
    normalise: Callable[[str], str] = same_text,
    required: Sequence[str] = (),
    row_bytes: int = 1 << 24,
) -> DataFrame:
    """The same table from CSV members of ZIP archives, with the same error for missing columns.

    One task reads one member, streaming it from storage through Arrow's CSV reader, so neither an
    archive nor a member is held whole; a large archive is spread by member. A line may have up to
    `row_bytes` bytes. Fields that a short line lacks are NULL, and surplus ones are left out.
    Archives without CSV members are named in a warning.
    """
    names = list(wanted)
    found = cut_lineage(archive_members(spark, paths, ".csv", separator, encoding), "members")

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, member, header in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                missing = [c for c in required if c not in positions(header, wanted, normalise)]
                if member is None:
                    rows.append((path, None))
                elif header and missing:
                    rows.append((f"{path}/{member}", ", ".join(missing)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], ["path", "missing"])

    odd = cut_lineage(found.select("path", "member", "header").mapInArrow(lacking, "path string, missing string"), "odd-members")
    for missing, test in ((True, "missing IS NOT NULL"), (False, "missing IS NULL")):
        some = odd.filter(test)
        first = some.orderBy("path").limit(_NAMED).collect()
        if missing and first:
            raise _lacking(some.count(), [f"{r.path} ({r.missing})" for r in first])
        if first:
            warnings.warn(f"{some.count()} archives without CSV members: {'; '.join(r.path for r in first)}", stacklevel=2)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member, header in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                place = positions(header, wanted, normalise)
                with open_path(path) as raw, zipfile.ZipFile(raw) as archive, archive.open(member) as body:
                    yield from member_batches(body, len(header), place, names, path.rsplit("/", 1)[-1], separator, encoding, row_bytes)

    # A fixed number of partitions, because adaptive execution would merge these tiny rows into one task.
    members = found.filter("size(header) > 0").select("path", "member", "header").repartition(
        spark.sparkContext.defaultParallelism * 4, "path", "member"
    )
    return members.mapInArrow(rows, _string_schema([*names, SOURCE_FILE]))


def member_batches(
    body, width: int, place: Mapping[str, int], names: Sequence[str], source: str, separator: str, encoding: str, row_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The columns `names` of a CSV stream whose header has `width` fields, batch by batch."""
    odd: list[str] = []

    def keep(row: csv_reader.InvalidRow) -> str:
        odd.append(row.text)
        return "skip"

    reader = csv_reader.open_csv(
        codecs.EncodedFile(body, "utf-8", encoding, errors="replace"),
        read_options=csv_reader.ReadOptions(block_size=row_bytes, column_names=[str(i) for i in range(width)], skip_rows=1, use_threads=False),
        parse_options=csv_reader.ParseOptions(delimiter=separator, newlines_in_values=True, invalid_row_handler=keep),
        convert_options=csv_reader.ConvertOptions(
            include_columns=[str(i) for i in sorted(set(place.values()))],
            column_types={str(i): pa.string() for i in range(width)},
            strings_can_be_null=False,
            quoted_strings_can_be_null=False,
        ),
    )
    for batch in reader:
        size = batch.num_rows
        empty = pa.nulls(size, pa.string())
        columns = [batch.column(str(place[c])) if c in place else empty for c in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([source] * size, pa.string())], [*names, SOURCE_FILE])
    if odd:  # lines with too few or too many fields
        csv.field_size_limit(row_bytes)
        fields = list(csv.reader(odd, delimiter=separator))
        columns = [pa.array([r[place[c]] if c in place and place[c] < len(r) else None for r in fields], pa.string()) for c in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([source] * len(fields), pa.string())], [*names, SOURCE_FILE])
