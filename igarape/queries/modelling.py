"""Modelling steps on the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.constants import TARGET
from igarape.functions.numeric import weighted_sum
from igarape.models.estimators import default_models, fit_pipeline, forest, importance_table, lasso, linear
from igarape.models.evaluation import (
    argmin_row,
    cross_validated,
    error_by_group,
    group_folds,
    regression_metrics,
    temporal_split,
    with_errors,
)
from igarape.models.exchange import FACTORS
from igarape.models.explain import impact_summary, permutation_importance, scenario_impact, with_scenarios
from igarape.models.features import feature_names, fit_preprocessing, model_table, standardized
from igarape.queries import facts
from igarape.queries.panel import ANALYSIS_SQL, _analysis
from igarape.queries.registry import query, rounded, table
from igarape.session import cut_lineage
from igarape.sinks.tables import stamped

HOLDOUT = facts.LAST_YEAR
_FEATURES = [
    "idx_atend_agua_total", "idx_tratamento_esgoto", "idx_coleta_esgoto", "pct_conformes_global",
    "idx_perdas_distribuicao", "deficit_atendimento", "deficit_tratamento", "alerta_qualidade", "perdas_excesso",
    "chuva_total_mm", "chuva_total_mm_lag1", "temp_media_c", "despesa_saude_pc", "pct_despesa_investimentos_saude",
    "populacao",
]


def _table(spark: SparkSession, folder: str) -> DataFrame:
    """The modelling table, written once because fits read it many times."""
    return cut_lineage(model_table(_analysis(spark, folder)))


def _rounded_list(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


@query(
    "feature_table",
    f"""WITH {ANALYSIS_SQL} SELECT cod_mun, ano, {_rounded_list([*_FEATURES, TARGET])} FROM ana
    WHERE {TARGET} IS NOT NULL""",
)
def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    rows = model_table(_analysis(spark, folder))
    return rounded(rows.select("cod_mun", "ano", *feature_names(rows), TARGET))


_STANDARD = ["idx_coleta_esgoto", "chuva_total_mm", "despesa_saude_pc"]


@query(
    "standardize",
    f"""WITH {ANALYSIS_SQL}
    SELECT cod_mun, ano, {", ".join(
        f"round((a.{c} - (SELECT avg({c}) FROM ana)) / (SELECT stddev_pop({c}) FROM ana), 6) AS {c}" for c in _STANDARD
    )} FROM ana a""",
)
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    rows = standardized(_analysis(spark, folder).select("cod_mun", "ano", *_STANDARD), _STANDARD)
    return rounded(rows)


_LEARNT = ["idx_atend_agua_total", "chuva_total_mm_lag1", "populacao"]
_LEARNT_SQL = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM ana WHERE ano < {HOLDOUT})) AS {c}" for c in _LEARNT)


@query(
    "median_imputer_fit",
    f"""WITH {ANALYSIS_SQL},
    full_rows AS (SELECT cod_mun, ano, {_LEARNT_SQL} FROM ana)
    SELECT cod_mun, ano, {", ".join(
        f"round((f.{c} - (SELECT avg({c}) FROM full_rows WHERE ano < {HOLDOUT})) / "
        f"(SELECT stddev_pop({c}) FROM full_rows WHERE ano < {HOLDOUT}), 6) AS x_{c}" for c in _LEARNT
    )} FROM full_rows f""",
)
def median_imputer_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Medians and scales learnt before the holdout year, applied to all rows."""
    rows = _table(spark, folder)
    fitted = fit_preprocessing(rows.filter(F.col("ano") < HOLDOUT), _LEARNT)
    return rounded(fitted.columns(rows).select("cod_mun", "ano", *[f"x_{c}" for c in _LEARNT]))


_SINGLE = ["idx_coleta_esgoto", "pct_conformes_global", "temp_media_c"]


@query(
    "ols_single_feature",
    f"WITH {ANALYSIS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(regr_slope({TARGET}, {c}), 6) AS slope, "
        f"round(regr_intercept({TARGET}, {c}), 4) AS intercept FROM ana"
        for c in _SINGLE
    ),
)
def ols_single_feature(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder)
    lines = []
    for c in _SINGLE:
        fitted = fit_pipeline(rows, [c], linear())
        learnt = fitted.preprocessing
        slope = float(fitted.model.coefficients[0]) / learnt.deviations[c]
        lines.append((c, slope, float(fitted.model.intercept) - slope * learnt.means[c]))
    table_ = spark.createDataFrame(lines, "feature string, slope double, intercept double")
    return table_.select("feature", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query(
    "group_kfold_assign",
    """WITH RECURSIVE sizes AS (
      SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1),
    ordered AS (SELECT *, row_number() OVER (ORDER BY n DESC, c_nationkey DESC) AS rn FROM sizes),
    filled AS (
      SELECT CAST(0 AS BIGINT) AS rn, CAST([0, 0, 0, 0] AS BIGINT[]) AS loads, CAST(NULL AS INTEGER) AS c_nationkey,
             CAST(NULL AS BIGINT) AS fold
      UNION ALL
      SELECT o.rn, list_transform(range(1, 5), lambda i: f.loads[i] +
               CASE WHEN i = list_position(f.loads, list_min(f.loads)) THEN o.n ELSE 0 END),
             o.c_nationkey, list_position(f.loads, list_min(f.loads)) - 1
      FROM filled f JOIN ordered o ON o.rn = f.rn + 1)
    SELECT c_nationkey, CAST(fold AS INTEGER) AS fold FROM filled WHERE rn > 0""",
)
def group_kfold_assign(spark: SparkSession, folder: str) -> DataFrame:
    return group_folds(table(spark, folder, "customer"), "c_nationkey")


def _baseline_predictions(rows: DataFrame) -> DataFrame:
    """Mean rate before the holdout year as the prediction for every row."""
    mean = rows.filter(F.col("ano") < HOLDOUT).agg(F.avg(TARGET)).scalar()
    return rows.select("cod_mun", "municipio", "ano", TARGET, mean.alias("previsto"))


_METRICS_SQL = f"""round(avg(abs(p - {TARGET})), 6) AS mae, round(sqrt(avg((p - {TARGET}) * (p - {TARGET}))), 6) AS rmse,
  round(1 - sum((p - {TARGET}) * (p - {TARGET})) / nullif(var_pop({TARGET}) * count(*), 0), 6) AS r2"""


@query(
    "regression_metrics",
    f"""WITH {ANALYSIS_SQL},
    pred AS (SELECT ano, {TARGET}, (SELECT avg({TARGET}) FROM ana WHERE ano < {HOLDOUT}) AS p FROM ana)
    SELECT ano, {_METRICS_SQL} FROM pred GROUP BY 1""",
)
def metrics_by_year(spark: SparkSession, folder: str) -> DataFrame:
    predicted = _baseline_predictions(_analysis(spark, folder))
    return rounded(regression_metrics(predicted, TARGET, "previsto", ["ano"]))


_GROUP_MEANS_SQL = f"""means AS (SELECT cod_mun, avg({TARGET}) AS p FROM ana WHERE ano < {HOLDOUT} GROUP BY 1),
pred AS (SELECT a.cod_mun, a.municipio, a.{TARGET}, m.p FROM ana a JOIN means m ON a.cod_mun = m.cod_mun WHERE ano = {HOLDOUT})"""


def _holdout_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Mean rate of a nation before the holdout year as its prediction for that year."""
    train, test = temporal_split(_table(spark, folder), HOLDOUT)
    means = train.groupBy("cod_mun").agg(F.avg(TARGET).alias("previsto"))
    return test.select("cod_mun", "municipio", TARGET).join(means, "cod_mun")


@query("temporal_holdout_metrics", f"WITH {ANALYSIS_SQL}, {_GROUP_MEANS_SQL} SELECT {_METRICS_SQL} FROM pred")
def temporal_holdout_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(regression_metrics(_holdout_predictions(spark, folder), TARGET, "previsto"))


@query(
    "error_by_group",
    f"""WITH {ANALYSIS_SQL}, {_GROUP_MEANS_SQL}
    SELECT municipio, round(avg(abs(p - {TARGET})), 6) AS mae,
      round(avg(CASE WHEN abs({TARGET}) > 0 THEN abs(p - {TARGET}) / abs({TARGET}) * 100 END), 6) AS ape_pct
    FROM pred GROUP BY 1""",
)
def errors_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    predicted = with_errors(_holdout_predictions(spark, folder), TARGET, "previsto")
    return rounded(error_by_group(predicted, "municipio"))


@query(
    "argmin_by_metric",
    f"""WITH {ANALYSIS_SQL},
    pred AS (SELECT ano, {TARGET}, (SELECT avg({TARGET}) FROM ana WHERE ano < {HOLDOUT}) AS p FROM ana),
    m AS (SELECT ano, avg(abs(p - {TARGET})) AS mae FROM pred GROUP BY 1)
    SELECT ano, round(mae, 6) AS mae FROM m ORDER BY m.mae, ano LIMIT 1""",
)
def argmin_by_metric(spark: SparkSession, folder: str) -> DataFrame:
    metrics = regression_metrics(_baseline_predictions(_analysis(spark, folder)), TARGET, "previsto", ["ano"])
    return rounded(argmin_row(metrics.select("ano", "mae"), "ano", "mae"))


_STEPS = [("idx_atend_agua_total", 5.0), ("pct_conformes_global", 60.0), ("temp_media_c", 0.5)]
_FORMULA = {"idx_atend_agua_total": 0.5, "pct_conformes_global": -0.25, "temp_media_c": 2.0}


@query(
    "scenario_impact",
    f"""WITH {ANALYSIS_SQL},
    now AS (SELECT * FROM ana WHERE ano = {HOLDOUT}),
    moves AS (
      SELECT 'idx_atend_agua_total' AS feature, CAST(5.0 AS DOUBLE) AS delta_aplicado,
        0.5 * (least(greatest(idx_atend_agua_total + 5.0, 0.0), 100.0) - idx_atend_agua_total) AS i FROM now
      UNION ALL SELECT 'pct_conformes_global', 60.0,
        -0.25 * (least(greatest(pct_conformes_global + 60.0, 0.0), 100.0) - pct_conformes_global) FROM now
      UNION ALL SELECT 'temp_media_c', 0.5, 2.0 * 0.5 FROM now)
    SELECT feature, delta_aplicado, round(avg(i), 6) AS impacto_medio_taxa, round(min(i), 6) AS impacto_min_taxa,
           round(max(i), 6) AS impacto_max_taxa FROM moves GROUP BY 1, 2""",
)
def scenario_impact_linear(spark: SparkSession, folder: str) -> DataFrame:
    """What-if steps scored by a fixed linear formula."""
    now = _analysis(spark, folder).filter(F.col("ano") == HOLDOUT).select(*_FORMULA)
    based = now.withColumn("baseline", weighted_sum(_FORMULA))
    varied = with_scenarios(based, list(_FORMULA), _STEPS).withColumn("varied", weighted_sum(_FORMULA))
    return rounded(impact_summary(varied, F.col("varied") - F.col("baseline")))


# Fitted models have no SQL equivalent: the check on these is rows only.


@query("model_pipeline")
def model_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Imputation, scaling and linear regression learnt before the holdout year, predicting it."""
    train, test = temporal_split(_table(spark, folder), HOLDOUT)
    fitted = fit_pipeline(train, feature_names(train), linear())
    return rounded(fitted.predict(test, "previsto").select("cod_mun", "ano", TARGET, "previsto"))


@query("lasso_fit")
def lasso_fit(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder)
    return importance_table(spark, fit_pipeline(rows, feature_names(rows), lasso()))


@query("forest_predictions")
def forest_predictions(spark: SparkSession, folder: str) -> DataFrame:
    train, test = temporal_split(_table(spark, folder), HOLDOUT)
    fitted = fit_pipeline(train, feature_names(train), forest())
    predicted = with_errors(fitted.predict(test, "previsto"), TARGET, "previsto")
    return predicted.select("cod_mun", "municipio", "ano", TARGET, "previsto", "erro_absoluto", "ape_pct")


@query("refit_predict_all")
def refit_predict_all(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder)
    fitted = fit_pipeline(rows, feature_names(rows), forest())
    return fitted.predict(rows, "taxa_prevista").select("cod_mun", "ano", TARGET, "taxa_prevista")


@query("model_importance")
def model_importance(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder)
    return importance_table(spark, fit_pipeline(rows, feature_names(rows), forest()))


@query("permutation_importance")
def permuted(spark: SparkSession, folder: str) -> DataFrame:
    train, test = temporal_split(_table(spark, folder), HOLDOUT)
    fitted = fit_pipeline(train, feature_names(train), linear())
    return permutation_importance(fitted, test, ["cod_mun", "ano"])


@query("cross_validated_metrics")
def cross_validated_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder)
    return cross_validated(rows, feature_names(rows), default_models())


@query("scenario_model")
def scenario_model(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder)
    fitted = fit_pipeline(rows, feature_names(rows), linear())
    return scenario_impact(fitted, rows.filter(F.col("ano") == HOLDOUT))


_ONE = "idx_coleta_esgoto"


@query(
    "model_pipeline_single",
    f"""WITH {ANALYSIS_SQL},
    line AS (SELECT regr_slope({TARGET}, {_ONE}) AS s, regr_intercept({TARGET}, {_ONE}) AS i FROM ana WHERE ano < {HOLDOUT})
    SELECT cod_mun, ano, round(s * {_ONE} + i, 4) AS previsto FROM ana, line WHERE ano = {HOLDOUT} AND {TARGET} IS NOT NULL""",
)
def model_pipeline_single(spark: SparkSession, folder: str) -> DataFrame:
    """The whole pipeline with one feature, where the fitted line has a closed form."""
    train, test = temporal_split(_table(spark, folder), HOLDOUT)
    fitted = fit_pipeline(train, [_ONE], linear())
    return rounded(fitted.predict(test, "previsto").select("cod_mun", "ano", "previsto"), 4)


@query(
    "cross_validated_single",
    f"""WITH RECURSIVE {ANALYSIS_SQL},
    known AS (SELECT cod_mun, {_ONE} AS x, {TARGET} AS t FROM ana WHERE {TARGET} IS NOT NULL),
    sizes AS (SELECT cod_mun, count(*) AS n FROM known GROUP BY 1),
    ordered AS (SELECT *, row_number() OVER (ORDER BY n DESC, cod_mun DESC) AS rn FROM sizes),
    placed AS (
      SELECT CAST(0 AS BIGINT) AS rn, CAST([0, 0, 0, 0] AS BIGINT[]) AS loads, CAST(NULL AS VARCHAR) AS cod_mun,
             CAST(NULL AS BIGINT) AS fold
      UNION ALL
      SELECT o.rn, list_transform(range(1, 5), lambda i: f.loads[i] +
               CASE WHEN i = list_position(f.loads, list_min(f.loads)) THEN o.n ELSE 0 END),
             o.cod_mun, list_position(f.loads, list_min(f.loads)) - 1
      FROM placed f JOIN ordered o ON o.rn = f.rn + 1),
    dealt AS (SELECT k.*, p.fold FROM known k JOIN placed p ON k.cod_mun = p.cod_mun),
    folds AS (SELECT DISTINCT fold AS own FROM dealt),
    fits AS (SELECT own, regr_slope(t, x) AS s, regr_intercept(t, x) AS i FROM folds JOIN dealt ON fold <> own GROUP BY 1),
    per AS (
      SELECT own, avg(abs(s * x + i - t)) AS mae, sqrt(avg((s * x + i - t) * (s * x + i - t))) AS rmse,
        1 - sum((s * x + i - t) * (s * x + i - t)) / (var_pop(t) * count(*)) AS r2
      FROM dealt JOIN fits ON fold = own GROUP BY 1)
    SELECT 'LinearRegression' AS model, round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse, round(avg(r2), 4) AS r2 FROM per""",
)
def cross_validated_single(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-validation by group with one feature."""
    return rounded(cross_validated(_table(spark, folder), [_ONE], {"LinearRegression": linear()}), 4)


@query(
    "linear_normal_equations",
    f"""WITH {ANALYSIS_SQL} SELECT feature, TRUE AS orthogonal FROM (
      {" UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n FROM ana" for c in _FEATURES)}) WHERE n >= 0""",
)
def linear_normal_equations(spark: SparkSession, folder: str) -> DataFrame:
    """The residual of the linear fit with all features is uncorrelated with each feature."""
    return _pulls(spark, folder, linear()).select("feature", (F.abs("pull") < 1e-6).alias("orthogonal"))


@query(
    "lasso_optimality",
    f"""WITH {ANALYSIS_SQL} SELECT feature, TRUE AS within, TRUE AS tight FROM (
      {" UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n FROM ana" for c in _FEATURES)}) WHERE n >= 0""",
)
def lasso_optimality(spark: SparkSession, folder: str) -> DataFrame:
    """No feature pulls more than the penalty, and those with a coefficient pull just as much, with its sign."""
    pull, b, alpha = F.col("pull"), F.col("valor"), F.lit(lasso().alpha)
    return _pulls(spark, folder, lasso()).select(
        "feature",
        (F.abs(pull) <= alpha + 1e-6).alias("within"),
        ((b == 0) | (F.abs(pull - F.signum(b) * alpha) < 1e-6)).alias("tight"),
    )


def _pulls(spark: SparkSession, folder: str, model) -> DataFrame:
    """(feature, valor, pull): coefficients, and mean products of the scaled features with the residual, over the rows."""
    rows = _table(spark, folder)
    features = feature_names(rows)
    fitted = fit_pipeline(rows, features, model)
    rest = F.col(TARGET) - F.col("previsto")
    scored = fitted.preprocessing.columns(fitted.predict(rows, "previsto"))
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.lit(float(b)).alias("valor"), (F.col(f"x_{c}") * rest).alias("product"))
            for c, b in zip(features, fitted.model.coefficients)
        ]
    )
    return scored.select(F.inline(cells)).groupBy("feature", "valor").agg(F.avg("product").alias("pull"))


def _exchange_sql(at: str, key: str) -> str:
    """The bijection of `models.exchange` on a row with a and b, in SQL."""
    sides = [f"({at} // b)", f"({at} % b)"]
    for i, factor in enumerate(FACTORS):
        mixed = f"((({sides[1 - i % 2]} + {key} + {i}) & 2147483647) * {factor})"
        sides[i % 2] = f"(({sides[i % 2]} + ({mixed} >> 16)) % {'ab'[i % 2]})"
    return f"({sides[0]} * b + {sides[1]})"


@query(
    "permutation_single",
    f"""WITH RECURSIVE {ANALYSIS_SQL},
    line AS (SELECT regr_slope({TARGET}, {_ONE}) AS s, regr_intercept({TARGET}, {_ONE}) AS i FROM ana WHERE ano < {HOLDOUT}),
    held AS (
      SELECT row_number() OVER (ORDER BY cod_mun, ano) - 1 AS place, {_ONE} AS x, {TARGET} AS t FROM ana
      WHERE ano = {HOLDOUT} AND {TARGET} IS NOT NULL),
    sizes AS (
      SELECT n, a, (n + a - 1) // a AS b FROM (
        SELECT n, CASE WHEN r * r < n THEN r + 1 ELSE r END AS a FROM (
          SELECT count(*) AS n, CAST(floor(sqrt(count(*))) AS BIGINT) AS r FROM held))),
    walk AS (
      SELECT repeat, place, {_exchange_sql('place', 'k')} AS spot, k, n, a, b
      FROM (SELECT place, r.repeat, (42 * 1000003 + r.repeat * 7919) & 2147483647 AS k, sizes.*
            FROM held, sizes, (SELECT unnest(range(1, 51)) AS repeat) r)
      UNION ALL
      SELECT repeat, place, {_exchange_sql('spot', 'k')}, k, n, a, b FROM walk WHERE spot >= n),
    swapped AS (
      SELECT abs(s * other.x + i - own.t) AS e FROM walk JOIN held own ON own.place = walk.place
      JOIN held other ON other.place = walk.spot, line WHERE walk.spot < n)
    SELECT '{_ONE}' AS feature,
      round(abs((SELECT avg(e) FROM swapped) - (SELECT avg(abs(s * x + i - t)) FROM held, line)), 6) AS valor""",
)
def permutation_single(spark: SparkSession, folder: str) -> DataFrame:
    """Permutation importance with one feature: the same exchange of places in SQL."""
    train, test = temporal_split(_table(spark, folder), HOLDOUT)
    fitted = fit_pipeline(train, [_ONE], linear())
    return rounded(permutation_importance(fitted, test, ["cod_mun", "ano"]))


@query(
    "refit_predict_single",
    f"""WITH {ANALYSIS_SQL},
    line AS (SELECT regr_slope({TARGET}, {_ONE}) AS s, regr_intercept({TARGET}, {_ONE}) AS i FROM ana WHERE {TARGET} IS NOT NULL)
    SELECT cod_mun, ano, round({TARGET}, 6) AS {TARGET}, round(s * {_ONE} + i, 4) AS taxa_prevista FROM ana, line WHERE {TARGET} IS NOT NULL""",
)
def refit_predict_single(spark: SparkSession, folder: str) -> DataFrame:
    """The model with one feature, learnt from all rows and applied to them."""
    rows = _table(spark, folder)
    found = fit_pipeline(rows, [_ONE], linear()).predict(rows, "taxa_prevista")
    return found.select("cod_mun", "ano", F.round(TARGET, 6).alias(TARGET), F.round("taxa_prevista", 4).alias("taxa_prevista"))


@query(
    "importance_single",
    f"""WITH {ANALYSIS_SQL} """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(abs(regr_slope({TARGET}, {c}) * stddev_pop({c})), 6) AS valor FROM ana WHERE {TARGET} IS NOT NULL"
        for c in _SINGLE
    ),
)
def importance_single(spark: SparkSession, folder: str) -> DataFrame:
    """Size of the standardised coefficient of each feature on its own."""
    rows = _table(spark, folder)
    tables = [importance_table(spark, fit_pipeline(rows, [c], linear())) for c in _SINGLE]
    return rounded(tables[0].union(tables[1]).union(tables[2]))


_EXPORTED = "2024-05-06T07:08:09+00:00"


@query(
    "timestamp_export",
    f"""WITH {facts.PANEL_SQL} SELECT cod_mun, ano, round({TARGET}, 6) AS {TARGET}, '{_EXPORTED}' AS gerado_em FROM gold""",
)
def timestamp_export(spark: SparkSession, folder: str) -> DataFrame:
    """An exported table carries the time of its run, given by the job."""
    return stamped(rounded(facts.panel(spark, folder).select("cod_mun", "ano", TARGET)), _EXPORTED)
