"""Queries on tables in which one key of every kind holds a third of the rows."""

import shutil

import pytest
from pyspark.sql import functions as F

from igarape.operators.hot_join import hot_keys, join_unsummed
from igarape.queries import QUERIES, SQL
from igarape.queries.registry import TABLES, table
from tests.oracle import connect, differences

SOURCE = "/root/testdata/sf0.001"

# Column that gets a hot value -> the value.
HOT = {
    "orders": {"o_custkey": 3, "o_orderpriority": "'1-URGENT'"},
    "lineitem": {"l_suppkey": 2, "l_partkey": 5},
    "customer": {"c_nationkey": 4},
    "part": {"p_name": "'red plate'", "p_brand": "'Brand#1'"},
    "events": {"event_type": "'view'", "user_id": 7},
}
# Column that tells the rows of a third apart.
ROW = {"orders": "o_orderkey", "lineitem": "l_orderkey", "customer": "c_custkey", "part": "p_partkey", "events": "event_id"}

NAMES = [
    "gold_features", "annual_sums", "monthly_admissions", "quality_two_level", "pivot_classes", "pivot_ratio_codes",
    "best_row_per_key", "dedupe_names_cumcount", "alias_pattern_match", "station_year_climate", "heat_days",
    "station_fanout", "semi_join_dim", "canonical_code_lookup", "coverage_by_year", "max_all_numeric",
    "group_kfold_assign", "group_null_keys", "classify_rules", "priority_panel", "impute_median_rows", "group_medians",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        rows = table(spark, SOURCE, name)
        for column, value in HOT.get(name, {}).items():
            hot = F.expr(f"cast({value} as {dict(rows.dtypes)[column]})")
            rows = rows.withColumn(column, F.when(F.col(ROW[name]) % 3 == 0, hot).otherwise(F.col(column)))
        target = folder / "parts" / name
        rows.coalesce(1).write.parquet(str(target))
        shutil.copy(next(target.glob("*.parquet")), folder / f"{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def duck(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql_under_skew(spark, skewed, duck, name):
    assert differences(QUERIES[name](spark, skewed).toPandas(), duck.sql(SQL[name]).df()) is None


@pytest.mark.parametrize("name", ["semi_join_dim", "percentile_mean", "admissions_plan"])
def test_same_as_sql_without_adaptive_execution(spark, skewed, duck, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert differences(QUERIES[name](spark, skewed).toPandas(), duck.sql(SQL[name]).df()) is None
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_hot_key_is_dealt_over_tasks(spark, how):
    rows = spark.range(0, 60000, 1, 12).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 101 = 5 THEN NULL ELSE id % 5000 END AS k")
    names = spark.range(0, 6000, 2).selectExpr("id + 1 AS k", "concat('n', id) AS name")
    assert hot_keys(rows, "k") == [7] and hot_keys(rows.limit(0), "k") == []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = join_unsummed(rows, names, "k", how)
        tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(tasks) < 0.2 * sum(tasks) and len(tasks) >= 12
        expected = rows.join(names, "k", how)
        assert found.columns == expected.columns
        assert not found.exceptAll(expected).count() and not expected.exceptAll(found).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        join_unsummed(rows, names, "k", "outer")
