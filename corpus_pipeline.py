"""The corpus pipeline over `documents`: five stages, each on all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of `documents`. Rejected documents go, repeated lines go, one document of each group of
near-duplicates stays (the one with the smallest id), secrets are replaced by their kind, and the
rest is packed into sequences. Texts change, so `n_chars` is counted anew. The last stages cannot
be stated in SQL; the tests hold the pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.llm.common import passed_on, read_table
from igarape.llm.line_runs import without_repeated_lines
from igarape.llm.packing import pack, pieces
from igarape.llm.quality_rules import judge
from igarape.llm.secret_scan import scan
from igarape.llm.simhash import one_of_each
from igarape.session import cut_lineage

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return judge(docs, into="__quality").filter("__quality.kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = without_repeated_lines(docs, into=("__kept", "__lines", "__dropped"))
    return passed_on(found, F.col("__kept")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = scan(docs, redact=True, into="__secrets")
    return passed_on(found, F.col("__secrets.clean")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(pieces(docs))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; what passes from one to the next is a written table."""
    docs = read_table(spark, sf_dir, "documents", "*")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
