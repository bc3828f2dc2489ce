"""Session construction, the shared folder for intermediate tables, and lineage cutting."""

from __future__ import annotations

import atexit
import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app_name: str = "igarape", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` adds or overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def file_system(spark: SparkSession, folder: str):
    """The Hadoop file system of a path, and the path."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _shared_parent(spark: SparkSession) -> str:
    parent = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (parent or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables of this application; it goes when the application ends.

    It lies below ``spark.checkpoint.dir`` (or the context's checkpoint folder). Where neither is
    set it lies below the warehouse, which executors share as well, in every mode.
    """
    folder = f"{_shared_parent(spark)}/_igarape-{spark.sparkContext.applicationId}"
    if folder not in _known:
        system, path = file_system(spark, folder)
        system.mkdirs(path)
        atexit.register(_clear, system, path)
        _known.add(folder)
    return folder


def _clear(system, path) -> None:
    try:
        system.delete(path, True)
    except Py4JError:
        pass  # the JVM has gone before


_known: set[str] = set()


def scratch_path(spark: SparkSession, label: str = "table") -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def lasting_path(spark: SparkSession, label: str) -> str:
    """A new path beside the shared folder, for what must outlive the application."""
    return f"{_shared_parent(spark)}/igarape-{label}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """Tables written to the shared folder within the block go when it ends."""
    _scopes.append([])
    try:
        yield
    finally:
        drop_scratch(spark, *_scopes.pop())


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that no later step reads."""
    for item in paths:
        system, path = file_system(spark, item)
        system.delete(path, True)


def cut_lineage(df: DataFrame, label: str = "table") -> DataFrame:
    """Write `df` to the shared folder and read it back. This runs `df` at once.

    What follows restarts from these files, not from the sources, also after an
    executor is lost. Parquet keeps column pruning and gives joins a known size.
    """
    return cut_lineage_observed(df, label)[0]


def cut_lineage_observed(df: DataFrame, label: str = "table", **figures: Column) -> tuple[DataFrame, dict]:
    """`cut_lineage`, and the aggregates `figures` of the rows, which the write works out on its way."""
    path = scratch_path(df.sparkSession, label)
    seen = observed_write(df, lambda rows: rows.write.parquet(path), **figures)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], **figures: Column) -> dict:
    """Do `write` with `df`; the aggregates `figures` of the rows that went through, without another scan."""
    if not figures:
        write(df)
        return {}
    observation = Observation()
    write(df.observe(observation, *[column.alias(name) for name, column in figures.items()]))
    return observation.get


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which unpickle its functions by name."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(here)))
    # Spark copies the file to each executor; only the driver reads this copy.
    path = os.path.join(context._temp_dir, "igarape.zip")
    with open(path, "wb") as target:
        target.write(packed.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)


_shipped: set[str] = set()
