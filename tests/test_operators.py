"""Table operators on small tables, compared with brute force where SQL is not the check."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from igarape.operators.grid import coverage, key_grid, missing_keys, value_domain
from igarape.operators.impute import fill_group_then_global_median
from igarape.operators.lookup import (
    either_key,
    fallback_columns,
    fan_out,
    require_all_found,
    with_canonical_code,
)
from igarape.operators.medians import exact_medians, whole_medians
from igarape.operators.ordering import first_row_per_key, occurrence_number, previous_by_key
from igarape.operators.reshape import cells_to_columns, keys_first, project_known, with_missing_columns
from igarape.operators.scale import minmax_summary, with_minmax
from igarape.operators.statistics import correlation, correlations_with


def test_either_key_gives_two_rows(dimension):
    keys = {r.lookup_code: r.cod_mun for r in either_key(dimension).collect()}
    assert keys["150140"] == keys["1501402"] == "1501402"
    assert len(keys) == 16


def test_canonical_code(spark, dimension):
    raw = ["1501402", "150140", "150140299", "1501409", " 15.014-02 ", "1501402.0", "999999", "", None, "402"]
    rows = spark.createDataFrame(list(enumerate(raw)), "i int, c string")
    found = with_canonical_code(rows, dimension, "c", keep_unmatched=True)
    codes = {r.i: r.cod_mun for r in found.collect()}
    assert [codes[i] for i in range(len(raw))] == ["1501402"] * 6 + [None] * 4
    assert with_canonical_code(rows, dimension, "c").count() == 6


def test_short_codes_are_zero_filled(spark):
    dimension = spark.createDataFrame([("0123456",), ("0000402",)], "cod_mun string")
    rows = spark.createDataFrame([(1, "123456"), (2, "402"), (3, "012345")], "i int, c string")
    found = {r.i: r.cod_mun for r in with_canonical_code(rows, dimension, "c").collect()}
    assert found == {1: "0123456", 2: "0000402", 3: "0123456"}


def test_require_all_found(spark, dimension):
    good = spark.createDataFrame([("1501402",)], "cod_mun string")
    require_all_found(good, dimension, "cod_mun")
    with pytest.raises(ValueError, match="77"):
        require_all_found(spark.createDataFrame([("77",)], "cod_mun string"), dimension, "cod_mun")


def test_grid_and_missing(spark, dimension):
    a = spark.createDataFrame([(2018,), (2019,), (None,)], "ano int")
    b = spark.createDataFrame([(2019,), (2021,)], "ano int")
    grid = key_grid(dimension, value_domain([a, b], "ano"), "ano")
    assert grid.count() == 8 * 3
    observed = grid.filter("NOT (cod_mun = '1501402' AND ano = 2021)")
    assert [tuple(r) for r in missing_keys(grid, observed, ["cod_mun", "ano"]).select("cod_mun", "ano").collect()] == [
        ("1501402", 2021)
    ]
    by_year = {r.ano: (r.municipios_com_dado, r.percentual_cobertura) for r in coverage(observed, dimension, "ano", "cod_mun").collect()}
    assert by_year == {2018: (8, 1.0), 2019: (8, 1.0), 2021: (7, 0.875)}


def test_grid_plan_has_no_cartesian_product(spark, dimension):
    years = value_domain([spark.range(3).select(F.col("id").cast("int").alias("ano"))], "ano")
    plan = key_grid(dimension, years, "ano")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_median_fill_order(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("b", 1, 10.0), ("b", 2, None), ("c", 1, None)],
        "k string, i int, x double",
    )
    filled = {(r.k, r.i): r.x for r in fill_group_then_global_median(rows, ["k"], ["x", "absent"]).collect()}
    assert filled[("a", 2)] == 2.0 and filled[("b", 2)] == 10.0
    # The global median is taken after the group fill: of 1, 2, 3, 10, 10.
    assert filled[("c", 1)] == 3.0


@pytest.mark.parametrize("key_grain", [True, False])
def test_median_fill_both_ways(spark, key_grain):
    rows = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, None), ("a", 3, 4.0), ("b", 1, 10.0), ("c", 1, None)], "k string, i int, x double"
    )
    filled = {(r.k, r.i): r.x for r in fill_group_then_global_median(rows, ["k"], ["x"], key_grain).collect()}
    assert filled == {("a", 1): 1.0, ("a", 2): 2.5, ("a", 3): 4.0, ("b", 1): 10.0, ("c", 1): 3.25}


def test_exact_medians(spark):
    rng = random.Random(11)
    rows = [("hot", rng.lognormvariate(0, 3), float(rng.choice([0, 0, 0, 1, 2]))) for _ in range(60001)]
    rows += [("even", float(i), None) for i in range(40000)]
    rows += [("two", 1.0, 5.0), ("two", 2.0, 5.0), ("one", 7.0, None), ("none", None, None), (None, 3.0, 4.0)]
    rng.shuffle(rows)
    frame = pd.DataFrame(rows, columns=["k", "x", "y"])
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(8)
    expected = frame.groupby("k", dropna=False)[["x", "y"]].median()
    found = {r.k: (r.x, r.y) for r in exact_medians(df, ["k"], ["x", "y"]).collect()}
    assert set(found) == {"hot", "even", "two", "one", None}
    for key, (x, y) in found.items():
        row = expected[expected.index.isna()].iloc[0] if key is None else expected.loc[key]
        assert x == row.x and (y == row.y or (y is None and pd.isna(row.y)))
    assert whole_medians(df, ["x", "y"]) == {"x": frame.x.median(), "y": frame.y.median()}
    assert whole_medians(df.filter("false"), ["x"]) == {"x": None}
    whole = exact_medians(df, [], ["x", "y"]).collect()
    assert [tuple(r) for r in whole] == [(frame.x.median(), frame.y.median())]


def test_minmax(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, k double")
    scaled = [(r.s_x, r.s_k) for r in with_minmax(rows, ["x", "k"], "s_").collect()]
    assert scaled == [(0.0, 0.0), (1.0, 0.0), (0.5, 0.0)]  # NULL takes the median
    assert [tuple(r) for r in minmax_summary(rows, ["x"]).collect()] == [("x", 1.0, 3.0)]


def test_first_row_per_key(spark):
    rows = spark.createDataFrame(
        [("k", "b", 9.0, 1), ("k", "a", 1.0, 2), ("k", "a", 5.0, 3), ("k", "a", 5.0, 4), ("m", None, 1.0, 5), ("m", "z", 0.0, 6)],
        "key string, name string, score double, i int",
    )
    best = first_row_per_key(rows, ["key"], [F.col("name"), -F.col("score"), F.col("i")])
    assert {r.key: r.i for r in best.collect()} == {"k": 3, "m": 6}
    assert best.columns == rows.columns


@pytest.mark.parametrize("block", [3, 100])
def test_occurrence_number_with_a_hot_key(spark, block):
    random.seed(7)
    rows = [(i, "hot" if random.random() < 0.4 else random.choice(["a", "b", None])) for i in range(200)]
    expected, seen = {}, {}
    for i, key in rows:
        expected[i] = seen.get(key, 0)
        seen[key] = expected[i] + 1
    random.shuffle(rows)
    numbered = occurrence_number(spark.createDataFrame(rows, "i long, k string"), ["k"], "i", "n", block=block)
    assert {r.i: r.n for r in numbered.collect()} == expected


def test_previous_by_key(spark):
    rows = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 5.0)], "k string, t int, x double")
    lagged = {(r.k, r.t): r.p for r in rows.withColumn("p", previous_by_key("x", ["k"], "t")).collect()}
    assert lagged == {("a", 1): None, ("a", 2): 1.0, ("b", 1): None}


def test_correlation_of_constants_is_null(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, 6.5, 7.0), (4.0, None, 7.0)], "x double, y double, k double")
    row = rows.agg(correlation("x", "k").alias("a"), correlation("x", "y").alias("b")).first()
    expected = rows.toPandas()["x"].corr(rows.toPandas()["y"])
    assert row.a is None and abs(row.b - expected) < 1e-12
    table = {r.nome: r.valor for r in correlations_with(rows, "x", ["k", "y", "absent"], "nome", "valor").collect()}
    assert set(table) == {"k", "y"} and table["k"] is None


def test_cells_to_columns_skips_null(spark):
    rows = spark.createDataFrame([("k", "a", 2, None), ("k", "a", 3, 7.0), ("k", "a", 4, 1.0), ("k", "b", 1, 5.0)], "k string, n string, o int, v double")
    wide = cells_to_columns(rows, ["k"], "n", F.col("v"), {"a": "x", "b": "y", "c": "z"}, order=["o"])
    assert wide.first().asDict() == {"k": "k", "x": 7.0, "y": 5.0, "z": None}


def test_column_helpers(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    assert project_known(rows, ["b", "q"]).columns == ["b"]
    assert keys_first(rows, ["b"]).columns == ["b", "a"]
    added = with_missing_columns(rows, {"a": F.lit(9), "c": F.lit(0.0)})
    assert added.first().asDict() == {"a": 1, "b": 2, "c": 0.0}


def test_fallback_and_fan_out(spark):
    first = spark.createDataFrame([("a", 1, None), ("b", 1, 2.0)], "k string, t int, x double")
    second = spark.createDataFrame([("a", 1, 7.0, 8.0), ("b", 1, 9.0, 8.0)], "k string, t int, x double, y double")
    filled = {r.k: (r.x, r.y) for r in fallback_columns(first, second, ["k", "t"], ["x", "y", "z"]).collect()}
    assert filled == {"a": (7.0, 8.0), "b": (2.0, 8.0)}
    bridge = spark.createDataFrame([("a", "p"), ("a", "q")], "k string, target string")
    assert sorted(r.target for r in fan_out(first, bridge, "k").collect()) == ["p", "q"]


def test_skewed_join_is_split(spark):
    """A key with most rows is split by adaptive execution, with all rows kept."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        facts = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") < 40000, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
        )
        keys = spark.range(0, 60000, 1, 4).select(F.col("id").alias("k"), (F.col("id") + 1).alias("w"))
        joined = facts.join(keys, "k")
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
