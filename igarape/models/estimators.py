"""Estimators and the fitted preprocessing + model pair."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.base import Estimator, Model
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.constants import FOREST_MIN_LEAF, FOREST_TREES, LASSO_ALPHA, LASSO_ITERATIONS, SEED, TARGET
from igarape.models.features import Preprocessing, fit_preprocessing
from igarape.models.moments import Lasso, Least, LinearModel, moment_matrices, scale_figures, scales_of, solved
from igarape.operators.medians import whole_medians


def linear() -> Least:
    return Least()


def lasso(alpha: float = LASSO_ALPHA, iterations: int = LASSO_ITERATIONS) -> Lasso:
    return Lasso(alpha, iterations)


def forest(
    trees: int = FOREST_TREES, min_leaf: int = FOREST_MIN_LEAF, depth: int = 30, bins: int = 128
) -> Estimator:
    """Regression forest that considers every feature at each split.

    Trees are meant to have no depth limit; 30 is the most that the engine grows,
    and leaves of `min_leaf` rows end them before on tables of up to some 10^9
    rows. Split points are chosen among `bins` quantiles of a feature.
    """
    return RandomForestRegressor(
        featuresCol="features",
        labelCol="label",
        numTrees=trees,
        minInstancesPerNode=min_leaf,
        maxDepth=depth,
        maxBins=bins,
        featureSubsetStrategy="all",
        seed=SEED,
    )


def default_models(trees: int = FOREST_TREES) -> dict[str, Estimator | Least | Lasso]:
    return {"LinearRegression": linear(), "Lasso": lasso(), "RandomForest": forest(trees)}


@dataclass(frozen=True)
class FittedPipeline:
    preprocessing: Preprocessing
    model: Model | LinearModel

    def linear_value(self) -> Column:
        """The prediction of a linear model, as a column expression."""
        return self.model.value([self.preprocessing.scaled(c) for c in self.preprocessing.features])

    def predict(self, df: DataFrame, into: str) -> DataFrame:
        """`df` with the prediction; one pass over the rows."""
        if isinstance(self.model, LinearModel):
            return df.select(*df.columns, self.linear_value().alias(into))
        vectors = self.preprocessing.vectors(df)
        predicted = self.model.transform(vectors)
        return predicted.select(*df.columns, F.col("prediction").alias(into))

    def importances(self) -> list[tuple[str, float]]:
        """Importance per feature: of the trees, or the absolute coefficients."""
        if hasattr(self.model, "featureImportances"):
            values = self.model.featureImportances.toArray()
        else:
            values = abs(self.model.coefficients)
        return [(c, float(v)) for c, v in zip(self.preprocessing.features, values)]


def fit_pipeline(
    train: DataFrame, features: Sequence[str], estimator: Estimator | Least | Lasso, target: str = TARGET
) -> FittedPipeline:
    """Imputation, standardisation and the model; linear models are solved from second moments."""
    if isinstance(estimator, (Least, Lasso)):
        seen = train.agg(*[column.alias(name) for name, column in scale_figures(features, target).items()]).first()
        scales = scales_of(seen.asDict(), features, target)
        matrices = moment_matrices(train, scales, target)
        if not matrices:
            raise ValueError("no rows to learn from")
        medians = {c: value if value is not None else 0.0 for c, value in whole_medians(train, features).items()}
        return FittedPipeline(*solved(matrices[0], scales, medians, estimator))
    preprocessing = fit_preprocessing(train, features)
    rows = preprocessing.vectors(train).select("features", F.col(target).cast("double").alias("label"))
    return FittedPipeline(preprocessing, estimator.fit(rows))


def importance_table(spark, fitted: FittedPipeline) -> DataFrame:
    return spark.createDataFrame(fitted.importances(), "feature string, valor double")
