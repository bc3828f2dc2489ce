"""Feature table and fitted preprocessing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.constants import FEATURE_CANDIDATES, TARGET
from igarape.operators.medians import whole_medians


def feature_names(df: DataFrame, candidates: Sequence[str] = tuple(FEATURE_CANDIDATES)) -> list[str]:
    """Candidates that the table has; none at all is an error."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        raise ValueError("none of the candidate features is in the table")
    return present


def model_table(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows with a known target."""
    return df.dropna(subset=[target])


@dataclass(frozen=True)
class Preprocessing:
    """Median imputation and standardisation learnt from one table.

    The learnt numbers are one row per fit, so they travel as literals and the
    transformation is plain column arithmetic.
    """

    features: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]

    def scaled(self, feature: str) -> Column:
        """A feature imputed, centred and divided by its population deviation."""
        filled = F.coalesce(F.col(feature).cast("double"), F.lit(self.medians[feature]))
        return (filled - F.lit(self.means[feature])) / F.lit(self.deviations[feature])

    def columns(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"x_{c}": self.scaled(c) for c in self.features})

    def vectors(self, df: DataFrame) -> DataFrame:
        names = [f"x_{c}" for c in self.features]
        assembler = VectorAssembler(inputCols=names, outputCol="features")
        return assembler.transform(self.columns(df)).drop(*names)


def fit_preprocessing(train: DataFrame, features: Sequence[str]) -> Preprocessing:
    """Medians, then means and deviations of the imputed columns; a constant column is divided by 1.

    Exact medians, found without gathering a column's values. A column without
    any value takes 0.
    """
    medians = {c: value if value is not None else 0.0 for c, value in whole_medians(train, features).items()}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in features}
    moments = train.agg(
        *[F.avg(x).alias(f"mean_{c}") for c, x in filled.items()],
        *[F.stddev_pop(x).alias(f"dev_{c}") for c, x in filled.items()],
    ).first()
    return Preprocessing(
        features=list(features),
        medians=medians,
        means={c: moments[f"mean_{c}"] for c in features},
        deviations={c: moments[f"dev_{c}"] or 1.0 for c in features},
    )


def standardized(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns centred and divided by the population deviation, statistics as a one-row scalar."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"dev_{c}") for c in columns],
        )
    ).scalar()
    scaled = {}
    for c in columns:
        mean, dev = F.col(f"_stats.mean_{c}"), F.col(f"_stats.dev_{c}")
        scaled[c] = (F.col(c) - mean) / F.when(dev == 0, 1.0).otherwise(dev)
    return df.withColumn("_stats", stats).withColumns(scaled).drop("_stats")
