"""Folds, metrics, cross-validation and temporal holdout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.constants import HOLDOUT_YEAR, MAX_FOLDS, TARGET
from igarape.functions.numeric import absolute_error, absolute_percentage_error
from igarape.models.estimators import FittedPipeline, fit_pipeline
from igarape.models.moments import Lasso, Least, left_out_medians, moment_matrices, scale_figures, scales_of, solved
from igarape.operators.ordering import with_place
from igarape.session import cut_lineage, cut_lineage_observed


def fold_segments(sizes: Sequence[tuple[int, int]], folds: int) -> list[tuple[int, int, list[int]]]:
    """(size, first rank, folds in turn) of a greedy fill: each group, the largest first, to the lightest fold.

    `sizes` are (size, number of groups) in descending order of size. From its first rank
    on, groups of a size go to the listed folds in turn, until the next segment begins. A
    segment ends when the folds taking turns have grown up to the next lightest one, so
    there are at most as many segments of a size as folds.
    """
    loads = [0] * folds
    segments = []
    for size, count in sizes:
        rank = 0
        while rank < count:
            ranked = sorted(range(folds), key=lambda i: (loads[i], i))
            # Folds that take a turn before the lightest one is due again.
            turn = [i for i in ranked if (loads[i], i) < (loads[ranked[0]] + size, ranked[0])]
            rest = [(loads[i], i) for i in ranked if i not in turn]
            rounds = (count - rank) // len(turn)
            if rest:
                # Whole rounds in which the lightest is still lighter than the next fold.
                gap = rest[0][0] - loads[turn[0]]
                rounds = min(rounds, max(1, -(-gap // size) - 1))
            taken = min(count - rank, max(rounds, 1) * len(turn))
            segments.append((size, rank, turn))
            for place, fold in enumerate(turn):
                loads[fold] += size * (taken // len(turn) + (place < taken % len(turn)))
            rank += taken
    return segments


def group_folds(df: DataFrame, group: str, folds: int = MAX_FOLDS) -> DataFrame:
    """(group, fold): groups from largest to smallest, each to the fold with the fewest rows so far.

    Equal sizes are taken by descending group. The fill is worked out over the
    distinct sizes and their counts, which are few however many groups there are;
    groups are numbered by a range-partitioned sort and read their fold off.
    """
    sizes = cut_lineage(df.groupBy(group).agg(F.count("*").alias("size")), "group-sizes")
    counts = [(row["size"], row["count"]) for row in sizes.groupBy("size").count().collect()]
    counts.sort(reverse=True)
    total = sum(n for _, n in counts)
    if not total:
        return sizes.select(group, F.lit(0).alias("fold"))
    first, before = {}, 0
    for size, n in counts:
        first[size] = before
        before += n
    rows = [
        (size, first[size] + rank, [int(x) for x in turn])
        for size, rank, turn in fold_segments(counts, min(folds, total))
    ]
    ends = [row[1] for row in rows[1:]] + [total]
    spark = df.sparkSession
    segments = spark.createDataFrame(
        [(*row, end) for row, end in zip(rows, ends)], "of_size long, begin long, turn array<int>, end long"
    )
    placed = with_place(sizes, [F.desc("size"), F.desc(group)], "place")
    fits = (F.col("size") == F.col("of_size")) & (F.col("place") >= F.col("begin")) & (F.col("place") < F.col("end"))
    inside = (F.col("place") - F.col("begin")) % F.size("turn")
    return placed.join(segments, fits).select(group, F.get("turn", inside.cast("int")).alias("fold"))


def regression_metrics(df: DataFrame, observed: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R² in one aggregate; R² is NULL when the target does not vary."""
    error = absolute_error(predicted, observed)
    spread = F.var_pop(observed) * F.count(observed)
    return df.groupBy(*by).agg(
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
    )


def moment_fits(
    table: DataFrame, features: Sequence[str], models: Mapping[str, Least | Lasso], seen: Mapping, numbers: Sequence[int], target: str
) -> dict[tuple[str, int], FittedPipeline]:
    """The fit of each linear model without each fold: the sums of all rows less those of the fold."""
    scales = scales_of(seen, features, target)
    matrices = moment_matrices(table, scales, target, "fold")
    total = sum(matrices.values())
    medians = left_out_medians(table, [c for c in features if seen[f"gaps_{c}"]], "fold", numbers)
    return {
        (name, n): FittedPipeline(*solved(total - matrices.get(n, 0.0), scales, medians[n], model))
        for name, model in models.items()
        for n in numbers
    }


def cross_validated(
    df: DataFrame,
    features: Sequence[str],
    models: Mapping[str, Estimator | Least | Lasso],
    group: str = "cod_mun",
    target: str = TARGET,
    folds: int = MAX_FOLDS,
    parallelism: int = 4,
) -> DataFrame:
    """(model, mae, rmse, r2): means over folds of the metrics on left-out groups, least MAE first.

    The table with its folds is written once. Linear models take every training set from sums over
    the folds, in one scan, and are scored together in another; others read the table for each fit.
    """
    dealt = df.join(group_folds(df, group, folds), group)
    table, seen = cut_lineage_observed(dealt, "folds", numbers=F.collect_set("fold"), **scale_figures(features, target))
    numbers = sorted(seen["numbers"])
    from_sums = {name: m for name, m in models.items() if isinstance(m, (Least, Lasso))}
    scored = []
    if from_sums:
        fits = moment_fits(table, features, from_sums, seen, numbers, target)
        values = [
            F.struct(F.lit(name).alias("model"), F.coalesce(*[F.when(F.col("fold") == n, fits[name, n].linear_value()) for n in numbers]).alias("previsto"))
            for name in from_sums
        ]
        scored.append(table.select("fold", target, F.inline(F.array(*values))).select("model", "fold", target, "previsto"))

    def left_out_predictions(name: str, number: int) -> DataFrame:
        fitted = fit_pipeline(table.filter(F.col("fold") != number), features, models[name], target)
        predicted = fitted.predict(table.filter(F.col("fold") == number), "previsto")
        return predicted.select(F.lit(name).alias("model"), "fold", target, "previsto")

    # Fits are independent, so several are submitted at a time; Spark schedules their jobs side by side.
    tasks = [(name, number) for name in models if name not in from_sums for number in numbers]
    session = df.sparkSession
    with ThreadPoolExecutor(parallelism) as pool:
        scored += pool.map(inheritable_thread_target(session)(lambda t: left_out_predictions(*t)), tasks)
    per_fold = regression_metrics(reduce(DataFrame.union, scored), target, "previsto", ["model", "fold"])
    means = per_fold.groupBy("model").agg(*[F.avg(m).alias(m) for m in ("mae", "rmse", "r2")])
    return means.orderBy("mae", "model")


def argmin_row(df: DataFrame, name: str, metric: str) -> DataFrame:
    """The row with the least metric; ties by name. One candidate per task is compared, nothing is sorted."""
    best = F.min_by(F.struct(*df.columns), F.struct(metric, name))
    return df.agg(best.alias("best")).select("best.*")


def best_model(metrics: DataFrame) -> str:
    """Name of the model with the least MAE."""
    return argmin_row(metrics.select("model", "mae"), "model", "mae").first().model


def temporal_split(df: DataFrame, year: int = HOLDOUT_YEAR, period: str = "ano") -> tuple[DataFrame, DataFrame]:
    """Rows before the year, rows of the year; an empty second part is an error."""
    test = df.filter(F.col(period) == year)
    if test.isEmpty():
        raise ValueError(f"no rows for the holdout year {year}")
    return df.filter(F.col(period) < year), test


def with_errors(df: DataFrame, observed: str, predicted: str) -> DataFrame:
    return df.withColumns(
        {
            "erro_absoluto": absolute_error(predicted, observed),
            "ape_pct": absolute_percentage_error(predicted, observed),
        }
    )


def error_by_group(df: DataFrame, group: str) -> DataFrame:
    """Mean error and mean percentage error per group, smallest first."""
    return (
        df.groupBy(group)
        .agg(F.avg("erro_absoluto").alias("mae"), F.avg("ape_pct").alias("ape_pct"))
        .orderBy("mae", group)
    )
