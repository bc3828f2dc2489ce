"""Modelling steps against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from igarape.models.estimators import FittedPipeline, fit_pipeline, lasso, linear
from igarape.models.evaluation import group_folds, regression_metrics, temporal_split
from igarape.models.explain import permutation_importance, scenario_impact
from igarape.models.features import feature_names, fit_preprocessing


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    frame = pd.DataFrame(
        {
            "cod_mun": [f"m{i % 9}" for i in range(90)],
            "ano": [2010 + i // 9 for i in range(90)],
            "a": rng.normal(50, 10, 90),
            "b": rng.normal(0, 1, 90),
            "noise": rng.normal(0, 1, 90),
        }
    )
    frame["y"] = 3 + 0.5 * frame.a - 2 * frame.b
    frame.loc[[3, 17], "b"] = None
    return frame


@pytest.fixture(scope="module")
def table(spark, rows):
    clean = rows.astype(object).where(rows.notna(), None)
    return spark.createDataFrame(
        list(clean.itertuples(index=False, name=None)), "cod_mun string, ano int, a double, b double, noise double, y double"
    )


def greedy(sizes, folds):
    loads, chosen = [0] * folds, {}
    for size, name in sorted(((n, k) for k, n in sizes.items()), reverse=True):
        fold = loads.index(min(loads))
        loads[fold] += size
        chosen[name] = fold
    return chosen


@pytest.mark.parametrize("groups", [3, 4, 11])
def test_group_folds(spark, groups):
    rng = random.Random(groups)
    sizes = {f"g{i:02d}": rng.choice([1, 3, 3, 8, 40]) for i in range(groups)}
    df = spark.createDataFrame([(k,) for k, n in sizes.items() for _ in range(n)], "g string")
    assert {r.g: r.fold for r in group_folds(df, "g").collect()} == greedy(sizes, min(4, groups))


def test_preprocessing(rows, table):
    fitted = fit_preprocessing(table, ["a", "b"])
    filled = rows.b.fillna(rows.b.median())
    assert fitted.medians["b"] == pytest.approx(rows.b.median())
    assert fitted.means["b"] == pytest.approx(filled.mean())
    assert fitted.deviations["b"] == pytest.approx(filled.std(ddof=0))


def test_linear_and_lasso(rows, table):
    x = rows[["a", "b"]].fillna(rows[["a", "b"]].median())
    design = np.column_stack([np.ones(len(x)), (x - x.mean()) / x.std(ddof=0)])
    expected = np.linalg.lstsq(design, rows.y, rcond=None)[0]
    fitted = fit_pipeline(table, ["a", "b"], linear(), "y")
    assert fitted.model.intercept == pytest.approx(expected[0])
    assert list(fitted.model.coefficients) == pytest.approx(list(expected[1:]))
    # One feature: the penalty moves the coefficient towards 0 by exactly alpha.
    plain = fit_pipeline(table, ["a"], linear(), "y").model.coefficients[0]
    shrunk = fit_pipeline(table, ["a"], lasso(alpha=0.5), "y").model.coefficients[0]
    assert shrunk == pytest.approx(plain - 0.5, abs=1e-4)


def test_sums_of_folds_give_the_fits_of_their_rows(spark, rows, table):
    """Every training set of a cross-validation, from the sums, against a fit on its rows."""
    from igarape.models.evaluation import moment_fits
    from igarape.models.moments import Lasso, Least, scale_figures

    names, folds = ["a", "b", "noise"], table.withColumn("fold", (F.substring("cod_mun", 2, 1).cast("int") % 4))
    seen = folds.agg(*[c.alias(n) for n, c in scale_figures(names, "y").items()]).first().asDict()
    models = {"l": Least(), "p": Lasso(0.3)}
    fits = moment_fits(folds, names, models, seen, [0, 1, 2, 3], "y")
    for (name, fold), fitted in fits.items():
        other = fit_pipeline(folds.filter(F.col("fold") != fold), names, models[name], "y")
        assert list(fitted.model.coefficients) == pytest.approx(list(other.model.coefficients), abs=1e-9)
        assert fitted.model.intercept == pytest.approx(other.model.intercept)
        assert fitted.preprocessing.deviations == pytest.approx(other.preprocessing.deviations)
        assert fitted.preprocessing.means == pytest.approx(other.preprocessing.means)
        train = rows[rows.cod_mun.str[1:].astype(int) % 4 != fold]
        x = train[names].fillna(train[names].median())
        z = ((x - x.mean()) / x.std(ddof=0)).to_numpy()
        if name == "l":
            design = np.column_stack([np.ones(len(z)), z])
            expected = np.linalg.lstsq(design, train.y, rcond=None)[0][1:]
            assert list(fitted.model.coefficients) == pytest.approx(list(expected))
        else:
            rest = (train.y - fitted.model.intercept).to_numpy() - z @ fitted.model.coefficients
            pull = z.T @ rest / len(z)
            for b, g in zip(fitted.model.coefficients, pull):
                assert abs(g) <= 0.3 + 1e-8 and (b == 0 or g == pytest.approx(0.3 * np.sign(b)))


def test_repeated_and_constant_features(spark):
    rows = spark.range(40).selectExpr("id * 1.0D AS a", "100 - id AS c", "5.0D AS k", "CAST(NULL AS DOUBLE) AS none", "id * 2.0D + 1e6 AS y")
    fitted = fit_pipeline(rows, ["a", "c", "k", "none"], linear(), "y")
    coefficients = list(fitted.model.coefficients)
    assert coefficients[0] == pytest.approx(-coefficients[1]) and coefficients[2:] == [0.0, 0.0]
    found = fitted.predict(rows, "p").selectExpr("max(abs(p - y)) AS gap").first().gap
    assert found < 1e-6
    assert fitted.preprocessing.medians["none"] == 0.0 and fitted.preprocessing.deviations["k"] == 1.0
    with pytest.raises(ValueError):
        fit_pipeline(rows.limit(0), ["a"], linear(), "y")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 4097])
def test_exchange_is_a_bijection_for_each_key(spark, n):
    from igarape.models.exchange import exchanged, round_key

    places = spark.range(n).select("id", F.explode(F.array(*map(F.lit, range(1, 6)))).alias("r"))
    found = places.select("r", "id", exchanged(F.col("id"), n, round_key(42, F.col("r"))).alias("to")).toPandas()
    for _, part in found.groupby("r"):
        assert sorted(part.to) == list(range(n))
    if n >= 97:
        orders = {tuple(part.sort_values("id").to) for _, part in found.groupby("r")}
        assert len(orders) == 5
        assert (found.id == found.to).mean() < 0.1
        assert abs(np.corrcoef(found.id, found.to)[0, 1]) < 0.2


def test_metrics(spark):
    df = spark.createDataFrame([("k", 1.0, 2.0), ("k", 2.0, 2.0), ("k", 4.0, 3.0), ("c", 5.0, 6.0)], "g string, y double, p double")
    found = {r.g: r for r in regression_metrics(df, "y", "p", ["g"]).collect()}
    assert found["k"].mae == pytest.approx(2 / 3) and found["k"].rmse == pytest.approx((2 / 3) ** 0.5)
    assert found["k"].r2 == pytest.approx(1 - 2 / (14 / 3)) and found["c"].r2 is None


def test_temporal_split(table):
    train, test = temporal_split(table, 2019)
    assert (train.count(), test.count()) == (81, 9)
    with pytest.raises(ValueError):
        temporal_split(table, 2030)


def test_features_needed(table):
    assert feature_names(table, ["b", "q", "a"]) == ["b", "a"]
    with pytest.raises(ValueError):
        feature_names(table, ["q"])


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_permutation_importance(spark, table, partitions):
    """Shuffle settings change where rows lie, not the result."""
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    fitted = fit_pipeline(table, ["a", "b", "noise"], linear(), "y")
    found = permutation_importance(fitted, table, ["cod_mun", "ano"], "y", repeats=5)
    values = {r.feature: r.valor for r in found.collect()}
    assert values["a"] > values["b"] > 10 * values["noise"]
    # A random exchange of a column with deviation s moves a linear prediction by about 1.13 * |coefficient| * s.
    assert values["a"] == pytest.approx(1.13 * abs(fitted.model.coefficients[0]), rel=0.35)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    again = permutation_importance(fitted, table, ["cod_mun", "ano"], "y", repeats=5)
    assert {r.feature: r.valor for r in again.collect()} == pytest.approx(values)


def test_permutation_keeps_every_value(spark, table, monkeypatch):
    """Each feature's values are exchanged among rows: none is lost, none repeated."""
    fitted = fit_pipeline(table, ["a", "noise"], linear(), "y")
    seen = []
    predict = FittedPipeline.predict

    def spy(self, df, into):
        seen.append(df)
        return predict(self, df, into)

    monkeypatch.setattr(FittedPipeline, "predict", spy)
    permutation_importance(fitted, table, ["cod_mun", "ano"], "y", repeats=2).collect()
    swapped = seen[0].filter(F.col("swapped_feature") == "a").toPandas()
    original = sorted(table.toPandas().a)
    assert len(swapped) == 180
    assert sorted(swapped.a) == pytest.approx(sorted(original * 2))
    assert sorted(swapped.noise) == pytest.approx(sorted(list(table.toPandas().noise) * 2))


def test_scenarios(table):
    renamed = table.withColumnsRenamed({"a": "idx_a", "b": "outro"})
    fitted = fit_pipeline(renamed, ["idx_a", "outro"], linear(), "y")
    steps = [("idx_a", 60.0), ("outro", 0.5), ("ausente", 1.0)]
    found = {r.feature: r for r in scenario_impact(fitted, renamed, steps).collect()}
    a = table.toPandas().a
    slope = fitted.model.coefficients[0] / fitted.preprocessing.deviations["idx_a"]
    moved = ((a + 60).clip(0, 100) - a) * slope
    assert found["idx_a"].impacto_medio_taxa == pytest.approx(moved.mean())
    assert found["idx_a"].impacto_min_taxa == pytest.approx(moved.min())
    assert set(found) == {"idx_a", "outro"}
