"""Exact medians by radix selection."""

import math
import random
import statistics
import struct

import pytest

from igarape.operators import medians
from igarape.operators.medians import exact_medians, order_image, whole_medians


def test_images_keep_the_order_of_doubles(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, math.inf, -math.inf, math.nan]
    for e in range(-1074, 1024, 3):
        values += [2.0**e, -(2.0**e), math.nextafter(2.0**e, 0), math.nextafter(2.0**e, math.inf)]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(4000)]
    values = [v for v in values if v == v] + [math.nan]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", order_image("x").alias("i")).collect()
    for r in rows:
        bits = struct.unpack("<q", struct.pack("<d", r.x))[0]
        if r.x != r.x:
            assert r.i == max(o.i for o in rows)
        else:
            assert r.i == (bits if bits >= 0 else -(bits & (1 << 63) - 1)), r.x


def check(rows, found, keys):
    groups = {}
    for *key, x, y in rows:
        for name, value in (("x", x), ("y", y)):
            if value is not None:
                groups.setdefault(tuple(key), {}).setdefault(name, []).append(value)
    expected = {k: tuple(statistics.median(v[c]) if c in v else None for c in ("x", "y")) for k, v in groups.items()}
    assert {tuple(r[k] for k in keys): (r.x, r.y) for r in found.collect()} == expected


@pytest.mark.parametrize("hot", [1, 3, 1024])
def test_groups_of_all_sizes(spark, monkeypatch, hot):
    monkeypatch.setattr(medians, "_HOT", hot)
    rng = random.Random(3)
    rows = [("hot", 1, 1.0 + rng.randrange(1 << 20) * 2.0**-52, rng.gauss(0, 1e-3)) for _ in range(9001)]
    rows += [(f"g{i}", i % 3, rng.choice([rng.random(), float(rng.randrange(3)), None]), -float(rng.randrange(9))) for i in range(60) for _ in range(i)]
    rows += [("equal", 0, 5.0, None)] * 500 + [(None, None, 7.0, 1e300), (None, None, 8.0, -1e300), ("none", 0, None, None)]
    rows += [("close", 2, math.nextafter(3.0, 4.0), -0.0), ("close", 2, 3.0, 0.0), ("close", 2, 3.0, 2.0), ("close", 2, 2.0, -2.0)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "k string, j int, x double, y double").repartition(6)
    check(rows, exact_medians(table, ["k", "j"], ["x", "y"]), ["k", "j"])
    everything = [(x, y) for _, _, x, y in rows]
    check(everything, exact_medians(table, [], ["x", "y"]), [])


def test_a_group_with_a_third_of_the_rows_needs_all_four_passes(spark):
    rows = spark.range(300_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 20000 END AS k", "1 + (id * 7919 % 100003) * power(2.0D, -52) AS x", "CAST(id AS INT) AS y"
    )
    found = {r.k: (r.x, r.y) for r in exact_medians(rows, ["k"], ["x", "y"]).collect()}
    frame = rows.toPandas().groupby("k")[["x", "y"]].median()
    assert len(found) == len(frame) == 20000
    assert found == {int(k): (x, y) for k, x, y in frame.itertuples()}


def test_whole_columns(spark):
    rows = spark.createDataFrame([(1.0, None, 3), (4.0, None, 5), (math.nan, None, 9)], "a double, b double, c int")
    assert whole_medians(rows, ["a", "b", "c"]) == {"a": 4.0, "b": None, "c": 5.0}
    assert whole_medians(rows.limit(0), ["a"]) == {"a": None} and whole_medians(rows, []) == {}
    infinite = spark.createDataFrame([(math.inf,), (1.0,), (math.inf,)], "a double")
    assert whole_medians(infinite, ["a"]) == {"a": math.inf}


def test_no_window_and_no_rows_on_the_driver(spark):
    rows = spark.range(1000).selectExpr("id % 7 AS k", "id * 1.0D AS x")
    plan = exact_medians(rows, ["k"], ["x"])._jdf.queryExecution().toString()
    assert "Window" not in plan
