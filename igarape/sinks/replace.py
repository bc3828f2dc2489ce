"""Replacing targets in two phases.

New rows are written beside their targets, in the same folder under a hidden name, and checked
there: rows, keys and columns, mostly by what the write itself observed. Only when every target of
a job has passed are old targets renamed away and new ones renamed into place. A failed check or
write leaves all targets untouched.

A journal beside the targets lists the renames before the first of them. A job that is killed
between two renames is rolled back by `recover`, which every replacement of the same targets and
every `read_target` call first: the old rows are there again. Deleting the main journal is the point from which
the new rows stand. Two jobs must not replace one target at the same time.

Renames are those of the Hadoop file system; where a store has none, they are copies.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.session import file_system, observed_write

_JOURNAL = "_igarape-swap-"


@dataclass(frozen=True)
class _Move:
    """A rename of `staged` to `target`, whose former rows wait at `kept`; `had`: there were some.

    Without `staged` the target only goes.
    """

    target: str
    staged: str
    kept: str
    had: bool


class _Files:
    """The few file operations needed, on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def exists(self, path: str) -> bool:
        system, place = file_system(self._spark, path)
        return system.exists(place)

    def rename(self, source: str, target: str) -> None:
        system, place = file_system(self._spark, source)
        to = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        system.mkdirs(to.getParent())
        if not system.rename(place, to):
            raise OSError(f"{source} could not be renamed to {target}")

    def delete(self, path: str) -> None:
        system, place = file_system(self._spark, path)
        system.delete(place, True)

    def folders(self, path: str, depth: int) -> Iterator[str]:
        """Paths, below `path`, of the partition folders at this depth."""
        system, place = file_system(self._spark, path)
        for status in system.listStatus(place):
            name = status.getPath().getName()
            if status.isDirectory() and "=" in name:
                if depth == 1:
                    yield name
                else:
                    for below in self.folders(f"{path}/{name}", depth - 1):
                        yield f"{name}/{below}"

    def write(self, path: str, text: str) -> None:
        system, place = file_system(self._spark, path)
        stream = system.create(place, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def journals(self, folder: str) -> Iterator[tuple[str, dict]]:
        system, place = file_system(self._spark, folder)
        if not system.exists(place):
            return
        for status in system.listStatus(place):
            path = status.getPath()
            if path.getName().startswith(_JOURNAL):
                jvm = self._spark.sparkContext._jvm
                stream = system.open(path)
                try:
                    text = jvm.org.apache.commons.io.IOUtils.toString(stream, jvm.java.nio.charset.StandardCharsets.UTF_8)
                finally:
                    stream.close()
                yield path.toString(), json.loads(text)


def _parts(path: str) -> tuple[str, str]:
    folder, _, name = path.rstrip("/").rpartition("/")
    return folder or ".", name


def recover(spark: SparkSession, *targets: str) -> None:
    """Bring targets whose replacement was broken off back to their old rows, and delete what it left."""
    files = _Files(spark)
    for folder in sorted({_parts(t)[0] for t in targets}):
        for path, journal in list(files.journals(folder)):
            if not {t.rstrip("/") for t in targets} & set(journal["targets"]):
                continue
            if files.exists(journal["main"]):
                _roll_back(files, [_Move(**m) for m in journal["moves"]])
                files.delete(journal["main"])
            for asides in journal["asides"]:
                files.delete(asides)
            files.delete(path)


def _roll_back(files: _Files, moves: Sequence[_Move]) -> None:
    for move in reversed(moves):
        if files.exists(move.kept):
            files.delete(move.target)
            files.rename(move.kept, move.target)
        elif not move.had and move.staged and not files.exists(move.staged):
            files.delete(move.target)


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet target, with its old rows if its last replacement was broken off."""
    recover(spark, path)
    return spark.read.parquet(path)


class Replacement:
    """Targets that are replaced together when the block ends without an error.

    with Replacement(spark) as targets:
        rows = targets.table(rows, "silver/t", unique=["id"])
        targets.csv(rows, "silver/t.csv")

    The methods return the rows as written, so that later steps need not compute them again; what
    they return reads the hidden folder and is of no use after the block.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._files, self._id = spark, _Files(spark), uuid.uuid4().hex[:12]
        #: (target, where its new rows are, depth of the partition folders to rename or 0 for the whole).
        self._staged: list[tuple[str, str, int]] = []
        self._gone: list[tuple[str, str]] = []

    def __enter__(self) -> Replacement:
        return self

    def __exit__(self, kind, *_) -> None:
        try:
            if kind is None:
                self._swap()
        finally:
            for folder in self._folders():
                self._files.delete(f"{folder}/_igarape-new-{self._id}")

    def _folders(self) -> list[str]:
        targets = [target for target, _, _ in self._staged] + [path for path, _ in self._gone]
        return sorted({_parts(target)[0] for target in targets})

    def table(
        self,
        df: DataFrame,
        path: str,
        keys: Sequence[str] = (),
        order: Sequence[str] = (),
        unique: Sequence[str] = (),
        what: str = "",
    ) -> DataFrame:
        """Replace a whole Parquet table, partitioned by `keys`."""
        rows = rebalanced(df, keys) if keys else df.orderBy(*order) if order else df
        return self._write(rows, path, keys, unique, what, whole=True)

    def partitions(self, df: DataFrame, path: str, keys: Sequence[str], unique: Sequence[str] = (), what: str = "") -> DataFrame:
        """Replace the partitions that `df` has rows of; all others stay."""
        return self._write(rebalanced(df, keys), path, keys, unique, what, whole=False)

    def without(self, path: str, partitions: Sequence[str]) -> None:
        """Take partitions, given as "key=value", out of a table."""
        recover(self._spark, path)
        self._gone += [(path.rstrip("/"), f"/{p}") for p in partitions]

    def csv(self, df: DataFrame, path: str, order: Sequence[str] = (), may_be_empty: bool = False) -> None:
        """Replace a CSV folder with headers; with `order`, file after file is sorted by these columns.

        A quote within a field is doubled, as the readers here and elsewhere expect.
        """
        staged = self._stage(path, 0)
        rows = df.orderBy(*order) if order else df
        seen = observed_write(rows, lambda x: x.write.options(header=True, escape='"').csv(staged), n=F.count(F.lit(1)))
        if not seen["n"] and not may_be_empty:
            raise ValueError(f"no rows: {path}")

    def _stage(self, path: str, depth: int) -> str:
        recover(self._spark, path)
        folder, name = _parts(path)
        staged = f"{folder}/_igarape-new-{self._id}/{name}"
        self._staged.append((path.rstrip("/"), staged, depth))
        return staged

    def _write(self, df: DataFrame, path: str, keys: Sequence[str], unique: Sequence[str], what: str, whole: bool) -> DataFrame:
        staged = self._stage(path, 0 if whole else len(keys))
        if not whole:
            self._same_columns(df, path)
        checks = {"n": F.count(F.lit(1)), **{f"null_{k}": F.count_if(F.col(k).isNull()) for k in (*keys, *unique)}}

        def write(rows: DataFrame) -> None:
            writer = rows.write.option("compression", "snappy")
            (writer.partitionBy(*keys) if keys else writer).parquet(staged)

        seen = observed_write(df, write, **checks)
        if not seen["n"]:
            raise ValueError(f"no rows: {what or path}")
        lacking = [k for k in (*keys, *unique) if seen[f"null_{k}"]]
        if lacking:
            raise ValueError(f"rows of {path} without {', '.join(lacking)}")
        written = self._spark.read.schema(df.schema).parquet(staged)
        if unique:
            twice = written.groupBy(*unique).count().filter("count > 1").limit(5).collect()
            if twice:
                raise ValueError(f"several rows of {path} for {'; '.join(', '.join(map(str, r[:-1])) for r in twice)}")
        return written.select(*df.columns)

    def _same_columns(self, df: DataFrame, path: str) -> None:
        if self._files.exists(path):
            old = dict(self._spark.read.parquet(path).dtypes)
            new = dict(df.dtypes)
            # Partition columns come back with inferred types, so only their names count.
            other = sorted(c for c in old.keys() | new.keys() if c not in old or c not in new)
            if other:
                raise ValueError(f"columns of {path} and of its new partitions differ: {', '.join(other)}")

    def _swap(self) -> None:
        moves = []
        for target, staged, depth in self._staged:
            folder, name = _parts(target)
            kept = f"{folder}/_igarape-old-{self._id}/{name}"
            for below in [""] if not depth else [f"/{p}" for p in sorted(self._files.folders(staged, depth))]:
                moves.append(_Move(target + below, staged + below, kept + below, self._files.exists(target + below)))
        for target, below in self._gone:
            if self._files.exists(target + below):
                folder, name = _parts(target)
                moves.append(_Move(target + below, "", f"{folder}/_igarape-old-{self._id}/{name}{below}", True))
        if not moves:
            return
        folders = self._folders()
        pointers = [f"{folder}/{_JOURNAL}{self._id}.json" for folder in folders]
        main = f"{folders[0]}/_igarape-main-{self._id}"
        asides = [f"{folder}/_igarape-{age}-{self._id}" for folder in folders for age in ("new", "old")]
        journal = {"main": main, "targets": sorted({t for t, _, _ in self._staged} | {t for t, _ in self._gone}), "asides": asides, "moves": [asdict(m) for m in moves]}
        for pointer in pointers:
            self._files.write(pointer, json.dumps(journal))
        self._files.write(main, self._id)
        try:
            for move in moves:
                self._step(move)
        except Exception:
            _roll_back(self._files, moves)
            self._files.delete(main)
            self._forget(pointers)
            raise
        self._files.delete(main)  # from here on the new rows stand
        self._forget(pointers)

    def _step(self, move: _Move) -> None:
        if move.had:
            self._files.rename(move.target, move.kept)
        if move.staged:
            self._files.rename(move.staged, move.target)

    def _forget(self, pointers: Sequence[str]) -> None:
        for folder in self._folders():
            self._files.delete(f"{folder}/_igarape-old-{self._id}")
        for pointer in pointers:
            self._files.delete(pointer)


def rebalanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gathers a partition's rows into few files, yet splits a partition that is large."""
    return df.hint("rebalance", *[F.col(k) for k in keys])
