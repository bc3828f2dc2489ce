"""Small helpers that several operators use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WHITE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, the whole table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` mentions it."""
    return F.transform(F.array(value), body)[0]


def map_arrow(
    df: DataFrame, schema: str | StructType, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]]
) -> DataFrame:
    """Apply to each Arrow batch what `start`, called once in each task, returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            result = function(batch)
            if result is not None and result.num_rows:
                yield result

    return df.mapInArrow(run, schema)


def quantile_cuts(df: DataFrame, column: str, parts: int, error: float) -> list[float]:
    """At most `parts` - 1 ascending values that cut a numeric column into parts of about equal size."""
    if parts < 2:
        return []
    return sorted(set(df.approxQuantile(column, [i / parts for i in range(1, parts)], error)))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def passed_on(docs: DataFrame, text: Column) -> DataFrame:
    """The rows of `docs` with another text, and `n_chars` counted anew where there is one."""
    changed = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(F.coalesce(text, F.lit(""))).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return docs.select(*[changed.get(c, docs[c]) for c in docs.columns])
