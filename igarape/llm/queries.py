"""One query for each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.llm import sql
from igarape.llm.common import read_table
from igarape.llm.lattice_sampling import sample
from igarape.llm.line_runs import without_repeated_lines
from igarape.llm.packing import pack, pieces
from igarape.llm.parity_join import near_sets
from igarape.llm.quality_rules import judge
from igarape.llm.registry import QUERIES, SQL, query
from igarape.llm.secret_scan import RULES, scan
from igarape.llm.simhash import near_duplicates
from igarape.llm.source_audit import audit
from igarape.llm.spotsigs import compare_with_edits
from igarape.llm.token_alignment import compare
from igarape.llm.url_filter import judge as judge_urls
from igarape.llm.warc import read_archives, write_archives
from igarape.llm.weak_quality import classify
from igarape.session import scratch_path

__all__ = ["QUERIES", "SQL"]


@query("op3_line_dedup", sql.LINE_DEDUP)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = without_repeated_lines(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op9_quality_rules", sql.QUALITY_RULES)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = judge(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return docs.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in names])


@query("op10_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(read_table(spark, sf_dir, "documents", "doc_id", "text")))


@query("op1_warc", sql.WARC)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    records = read_archives(spark, path)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_secret_scan", sql.SECRETS)
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "secrets.*")
    counts = [F.col("counts")[i].alias(f"n_{RULES[i].kind}") for i in range(len(RULES))]
    return found.select("doc_id", *counts, "base_sha256", "spans")


@query("op4_simhash")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op5_spotsigs")
def spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op7_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages", "page_id", "url")).drop("url")


@query("op6_weak_quality")
def weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_lattice_sampling")
def lattice_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample(read_table(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("key", "doc_id")


@query("op11_source_audit", sql.SOURCE_AUDIT)
def source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents", "lang", "source", "text"))


@query("op12_parity_join")
def parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_sets(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op13_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(read_table(spark, sf_dir, "documents", "doc_id", "text"))
