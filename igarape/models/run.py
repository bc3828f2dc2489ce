"""The whole modelling job: from the analysis table to the four exported tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.constants import HOLDOUT_YEAR, PERMUTATION_REPEATS, TARGET
from igarape.models.estimators import default_models, fit_pipeline, importance_table
from igarape.models.evaluation import (
    best_model,
    cross_validated,
    error_by_group,
    regression_metrics,
    temporal_split,
    with_errors,
)
from igarape.models.explain import permutation_importance, scenario_impact
from igarape.models.features import feature_names, model_table
from igarape.session import cut_lineage


def run_modelling(
    analysis: DataFrame,
    models: Mapping[str, Estimator] | None = None,
    holdout_year: int = HOLDOUT_YEAR,
    repeats: int = PERMUTATION_REPEATS,
) -> dict[str, DataFrame]:
    """Tables by name: metrics, importances, predictions, scenarios and errors on the holdout year."""
    models = models or default_models()
    spark = analysis.sparkSession
    table = cut_lineage(model_table(analysis))
    features = feature_names(table)

    cv = cross_validated(table, features, models).withColumn("dataset", F.lit("GroupKFold"))
    cv = cut_lineage(cv)
    chosen = best_model(cv)

    train, test = temporal_split(table, holdout_year)
    holdout = fit_pipeline(train, features, models[chosen])
    tested = with_errors(holdout.predict(test, "y_pred"), TARGET, "y_pred")
    held = regression_metrics(tested, TARGET, "y_pred").withColumns(
        {"model": F.lit(chosen), "dataset": F.lit(f"Holdout_{holdout_year}")}
    )

    final = fit_pipeline(table, features, models[chosen])
    predictions = final.predict(table, "taxa_prevista").select(
        "cod_mun",
        "municipio",
        "ano",
        "populacao",
        "prioridade_categoria",
        F.col(TARGET).alias("taxa_observada"),
        "taxa_prevista",
        F.abs(F.col("taxa_prevista") - F.col(TARGET)).alias("erro_absoluto"),
    )
    own = importance_table(spark, final).withColumn("tipo", F.lit("model_importance"))
    permuted = permutation_importance(
        holdout, test, ["cod_mun", "ano"], repeats=repeats
    ).withColumn("tipo", F.lit("permutation_importance"))
    scenarios = scenario_impact(final, analysis.filter(F.col("ano") == holdout_year))

    metric_columns = ["model", "dataset", "mae", "rmse", "r2"]
    return {
        "metrics": cv.select(*metric_columns).unionByName(held.select(*metric_columns)),
        "importances": own.unionByName(permuted).orderBy("tipo", F.desc("valor"), "feature"),
        "predictions": predictions.orderBy("cod_mun", "ano"),
        "scenarios": scenarios,
        "holdout_errors": tested.select("municipio", "ano", TARGET, "y_pred", "erro_absoluto", "ape_pct"),
        "municipality_errors": error_by_group(tested, "municipio"),
    }
