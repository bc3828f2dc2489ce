"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first. A batch's line keys are merge-joined
with the runs written so far: a key that no run holds is new and its largest document becomes the
keeper; a key already held only adds its count. The batch's own keys become a sorted run of level
0; `fanout` runs of a level are merged into one of the next. In the end the runs hold, for each
key, the number of documents and the one that keeps it.

Keys are 128-bit hashes. A row counts as a document, also if it repeats another. Null ids count
as smaller than any other; null texts are empty. Lines are never collected beyond one document.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.llm.common import WHITE, let, map_arrow, quantile_cuts, texts
from igarape.session import cut_lineage, drop_scratch, scratch_path

_KEY = ["h1", "h2"]
_BLANK = WHITE.encode()


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANK).lower()  # of bytes: A-Z only


class LineRuns:
    """Runs of (h1, h2, n, keeper, first) in levels; `first` marks the run that saw a key first."""

    schema = "h1 long, h2 long, n long, keeper long, first boolean"

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self._spark, self._fanout = spark, fanout
        self.levels: list[list[str]] = []

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self._spark.createDataFrame([], self.schema)
        return self._spark.read.schema(self.schema).parquet(*paths)

    def _write(self, rows: DataFrame) -> str:
        path = scratch_path(self._spark, "lines-run")
        rows.select("h1", "h2", "n", "keeper", "first").sortWithinPartitions(*_KEY).write.parquet(path)
        return path

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*_KEY).agg(
            F.sum("n").alias("n"), F.max("keeper").alias("keeper"), F.max("first").alias("first")
        )

    def add(self, batch: DataFrame) -> str:
        """Add rows (h1, h2, id), one per document and key; returns the path of the batch's run."""
        own = batch.groupBy(*_KEY).agg(F.count("*").alias("n"), F.max("id").alias("top"))
        paths = [path for level in self.levels for path in level]
        if paths:
            known = self._read(paths).filter("first").select(*_KEY, F.lit(True).alias("known"))
            own = own.join(known.hint("merge"), _KEY, "left")
        else:
            own = own.withColumn("known", F.lit(None).cast("boolean"))
        new = F.col("known").isNull()
        path = self._write(own.withColumn("first", new).withColumn("keeper", F.when(new, F.col("top"))))
        self._keep(path, 0)
        return path

    def _keep(self, path: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        runs = self.levels[level]
        runs.append(path)
        if len(runs) == self._fanout:
            merged = self._write(self._merged(self._read(runs)))
            self.levels[level] = []
            drop_scratch(self._spark, *runs)
            self._keep(merged, level + 1)

    def rows(self) -> DataFrame:
        """One row per key over all runs."""
        return self._merged(self._read([path for level in self.levels for path in level]))


def line_keys(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(id, mark, h1, h2, places): each document's distinct long keys and their line numbers.

    `mark` is a hash of the text; with the id it names a row, up to repeats.
    """
    schema = "id long, mark long, h1 long, h2 long, places array<int>"

    def start():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            ids, marks, first, second, places = [], [], [], [], []
            for key, mark, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2))):
                found: dict[bytes, list[int]] = {}
                for number, line in enumerate(value.split(b"\n")):
                    if len(line) >= min_chars:
                        line = line_key(line)
                        if len(line) >= min_chars and (
                            len(line) >= 4 * min_chars or len(line.decode()) >= min_chars
                        ):
                            found.setdefault(xxhash.xxh3_128_digest(line), []).append(number)
                for digest, where in found.items():
                    ids.append(key)
                    marks.append(mark)
                    first.append(int.from_bytes(digest[:8], "big", signed=True))
                    second.append(int.from_bytes(digest[8:], "big", signed=True))
                    places.append(where)
            long = pa.int64()
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, long), pa.array(marks, long), pa.array(first, long), pa.array(second, long),
                 pa.array(places, pa.list_(pa.int32()))],
                ["id", "mark", "h1", "h2", "places"],
            )

        return one

    return map_arrow(docs.select(F.col(doc_id).cast("long"), _mark(F.col(text)), F.col(text)), schema, start)


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without_repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    into: tuple[str, str, str] = ("kept_text", "n_lines", "n_dropped"),
) -> DataFrame:
    """`docs` with the text that stays, the number of lines and of dropped lines.

    A key of at least `min_chars` code points in at least `min_docs` documents keeps its lines
    only in the largest id holding it. Runs the batches at once.
    """
    spark = docs.sparkSession
    cuts = quantile_cuts(docs.select(F.col(doc_id).cast("long").alias("id")), "id", batches, 0.01)
    above = F.lit(0)
    for value in cuts:
        above = above + F.when(F.col("id") >= F.lit(value), 0).otherwise(1)
    keys = cut_lineage(line_keys(docs, doc_id, text, min_chars).withColumn("batch", above.cast("int")), "line-keys")

    runs = LineRuns(spark)
    for number in range(len(cuts) + 1):
        runs.add(keys.filter(F.col("batch") == number))

    common = runs.rows().filter(F.col("n") >= min_docs).select(*_KEY, "keeper")
    dropped = (
        keys.join(common, _KEY)
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "mark")
        .agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
        .select(F.struct("id", "mark").alias("__row"), F.col("places").alias("__places"))
    )
    row = F.struct(F.col(doc_id).cast("long").alias("id"), _mark(F.col(text)).alias("mark"))
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    joined = docs.withColumn("__key", row).join(dropped, F.col("__key").eqNullSafe(F.col("__row")), "left")
    some = F.col("__places").isNotNull()

    def kept(all_lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("__places"))
        return F.array_join(F.transform(stay, lambda i: F.get(all_lines, i)), "\n")

    return joined.select(
        *[docs[c] for c in docs.columns],
        F.when(some, let(lines, kept)).otherwise(F.coalesce(F.col(text), F.lit(""))).alias(into[0]),
        F.size(lines).cast("long").alias(into[1]),
        F.when(some, F.size("__places")).otherwise(0).cast("long").alias(into[2]),
    )
