"""Permutation importance and what-if scenarios, each as one scoring pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.constants import PERCENT_NAME_STARTS, PERMUTATION_REPEATS, SCENARIOS, SEED, TARGET
from igarape.functions.numeric import clip
from igarape.models.estimators import FittedPipeline
from igarape.models.exchange import exchanged, round_key
from igarape.operators.ordering import with_place
from igarape.session import cut_lineage_observed


def permutation_importance(
    fitted: FittedPipeline,
    df: DataFrame,
    keys: Sequence[str],
    target: str = TARGET,
    repeats: int = PERMUTATION_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """(feature, valor): absolute mean rise of MAE when the feature's values are exchanged.

    `keys` identify a row and give it a place, by one range-partitioned sort. In a repeat the row at a
    place receives the values of the row that the repeat's bijection of places names, so every value is
    used once, and no task holds a whole order. Features share the exchange; they are exploded after the
    join, where nothing is shuffled any more, and all of them are scored in one pass.
    """
    features = fitted.preprocessing.features
    base = df.select(*keys, target, *[F.col(c).cast("double").alias(c) for c in features])
    placed = with_place(base, [F.col(k) for k in keys], "place").drop(*keys)
    placed, seen = cut_lineage_observed(placed, "placed", rows=F.count(F.lit(1)))
    dealt = placed.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    partner = exchanged(F.col("place"), seen["rows"], round_key(seed, F.col("repeat")))
    others = placed.select(F.col("place").alias("other_place"), F.struct(*features).alias("other"))
    joined = dealt.withColumn("other_place", partner).join(others, "other_place")
    swapped = joined.withColumn("swapped_feature", F.explode(F.array(*map(F.lit, features)))).withColumns(
        {c: F.when(F.col("swapped_feature") == c, F.col(f"other.{c}")).otherwise(F.col(c)) for c in features}
    )
    scored = fitted.predict(swapped.select("swapped_feature", target, *features), "predicted")
    permuted = scored.groupBy("swapped_feature").agg(
        F.avg(F.abs(F.col("predicted") - F.col(target))).alias("mae")
    )
    plain = fitted.predict(df.select(target, *features), "predicted")
    baseline = plain.agg(F.avg(F.abs(F.col("predicted") - F.col(target)))).scalar()
    return permuted.select(
        F.col("swapped_feature").alias("feature"), F.abs(F.col("mae") - baseline).alias("valor")
    )


def moved(feature: str, delta: Column) -> Column:
    """Feature plus delta; percentages stay within [0, 100]."""
    value = F.col(feature).cast("double") + delta
    return clip(value, 0.0, 100.0) if feature.startswith(tuple(PERCENT_NAME_STARTS)) else value


def with_scenarios(
    df: DataFrame, columns: Sequence[str], scenarios: Sequence[tuple[str, float]]
) -> DataFrame:
    """Every row once per scenario, with the scenario's feature moved; unknown features are left out."""
    known = [(f, d) for f, d in scenarios if f in columns]
    steps = F.array(
        *[F.struct(F.lit(f).alias("scenario"), F.lit(d).alias("delta_aplicado")) for f, d in known]
    )
    repeated = df.select("*", F.inline(steps))
    return repeated.withColumns(
        {
            f: F.when(F.col("scenario") == f, moved(f, F.col("delta_aplicado"))).otherwise(F.col(f))
            for f, _ in known
        }
    )


def impact_summary(df: DataFrame, impact: Column) -> DataFrame:
    return df.groupBy(F.col("scenario").alias("feature"), "delta_aplicado").agg(
        F.avg(impact).alias("impacto_medio_taxa"),
        F.min(impact).alias("impacto_min_taxa"),
        F.max(impact).alias("impacto_max_taxa"),
    )


def scenario_impact(
    fitted: FittedPipeline, df: DataFrame, scenarios: Sequence[tuple[str, float]] = tuple(SCENARIOS)
) -> DataFrame:
    """Mean, least and largest change of the prediction per scenario."""
    features = fitted.preprocessing.features
    based = fitted.predict(df.select(*features), "baseline")
    varied = fitted.predict(with_scenarios(based, features, scenarios), "varied")
    return impact_summary(varied, F.col("varied") - F.col("baseline"))
