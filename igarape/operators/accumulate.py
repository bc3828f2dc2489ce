"""Partial aggregates kept per source file, so that new files are added without reading old ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from igarape.session import file_system
from igarape.sinks.replace import Replacement, read_target, recover
from igarape.sources.files import list_files

_FILE, _SIZE, _CHANGED, _ROWS = "_file", "_size", "_changed", "_rows"


class PartialStates:
    """A table of count, sum, least and largest value of figures per key, partitioned by source file.

    A file is known by its name, size and time of change. A changed file replaces its own states, a
    withdrawn one takes them along, and one that is already in changes nothing. Each file has a row
    without keys, so that one without usable rows is known too. Names must be unique.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], figures: Mapping[str, Column]):
        self._spark, self._path, self._keys, self._figures = spark, path.rstrip("/"), list(keys), dict(figures)

    def absorbed(self) -> DataFrame | None:
        """(name, size, time of change) of the files that are in; None before the first."""
        return self._rows().filter(F.col(_ROWS) == 0).select(_FILE, _SIZE, _CHANGED) if self._exists() else None

    def update(self, paths: str | list[str], read: Callable[[list[str]], DataFrame], source: str) -> tuple[int, int]:
        """Bring the states in line with the files: (number read, number withdrawn).

        `read` gets the paths of new and changed files and returns their rows with the file name in
        `source`. Only these paths come to the driver, as they do for any scan.
        """
        named = F.element_at(F.split("path", "/"), -1).alias(_FILE)
        files = list_files(self._spark, paths, changed=True).select(
            named, "path", F.col("length").alias(_SIZE), F.unix_micros("modificationTime").alias(_CHANGED)
        )
        twice = files.groupBy(_FILE).count().filter("count > 1").limit(5).collect()
        if twice:
            raise ValueError(f"several files are named {', '.join(r[0] for r in twice)}")
        known, gone = self.absorbed(), []
        if known is not None:
            gone = [r[0] for r in known.join(files, _FILE, "left_anti").select(_FILE).collect()]
            fresh = files.join(known, [_FILE, _SIZE, _CHANGED], "left_anti")
        else:
            fresh = files
        new = [r.path for r in fresh.orderBy("path").collect()]
        self._replace(read(new) if new else None, fresh, source, gone)
        return len(new), len(gone)

    def absorb(self, rows: DataFrame, files: DataFrame, source: str) -> None:
        """Put in the rows of some files; `files` are (_file, _size, _changed), also of files without rows."""
        self._replace(rows, files, source, [])

    def withdraw(self, names: Sequence[str]) -> None:
        """Take out the states of files."""
        self._replace(None, None, "", names)

    def _replace(self, rows: DataFrame | None, files: DataFrame | None, source: str, gone: Sequence[str]) -> None:
        with Replacement(self._spark) as targets:
            if gone:
                targets.without(self._path, [f"{_FILE}={self._escaped(name)}" for name in gone])
            if rows is not None:
                targets.partitions(self._states(rows, files, source), self._path, [_FILE])

    def _states(self, rows: DataFrame, files: DataFrame, source: str) -> DataFrame:
        figures = []
        for name, value in self._figures.items():
            kinds = {"count": F.count(value), "sum": F.sum(value), "low": F.min(value), "high": F.max(value)}
            figures += [column.alias(f"{kind}_{name}") for kind, column in kinds.items()]
        known = files.select(_FILE, _SIZE, _CHANGED)
        summed = rows.groupBy(F.col(source).alias(_FILE), *self._keys).agg(F.count(F.lit(1)).alias(_ROWS), *figures)
        marks = known.withColumn(_ROWS, F.lit(0).cast("long"))
        return summed.join(known, _FILE).unionByName(marks, allowMissingColumns=True)

    def _exists(self) -> bool:
        recover(self._spark, self._path)
        system, path = file_system(self._spark, self._path)
        return system.exists(path) and len(system.listStatus(path)) > 0

    def _escaped(self, name: str) -> str:
        """As Spark writes a value in a folder's name."""
        return self._spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)

    def _rows(self) -> DataFrame:
        found = read_target(self._spark, self._path)
        # The name as text, however much it looks like a number.
        fields = [T.StructField(f.name, T.StringType()) if f.name == _FILE else f for f in found.schema]
        return self._spark.read.schema(T.StructType(fields)).parquet(self._path)

    def total(self) -> DataFrame:
        """Per key the number of rows and, of each figure, count_, sum_, low_ and high_ over all files that are in."""
        states = self._rows().filter(F.col(_ROWS) > 0)
        merged = []
        for name in self._figures:
            merged += [
                F.sum(f"count_{name}").alias(f"count_{name}"),
                F.sum(f"sum_{name}").alias(f"sum_{name}"),
                F.min(f"low_{name}").alias(f"low_{name}"),
                F.max(f"high_{name}").alias(f"high_{name}"),
            ]
        return states.groupBy(*self._keys).agg(F.sum(_ROWS).alias("rows"), *merged)
