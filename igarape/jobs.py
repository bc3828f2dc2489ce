"""Jobs: read the inputs of a layer, run its plan, write its tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.constants import HOLDOUT_YEAR
from igarape.functions.numeric import decimal_comma_number, to_number
from igarape.models.run import run_modelling
from igarape.operators.scale import minmax_summary
from igarape.plans import (
    admissions,
    analysis,
    climate,
    finance,
    gold,
    population,
    service_indicators,
    water_quality,
)
from igarape.session import intermediate
from igarape.sinks.replace import Replacement, read_target
from igarape.sinks.tables import generation_time, stamped, with_csv_twin
from igarape.sources import payloads
from igarape.sources.delimited import SOURCE_FILE
from igarape.sources.dimension import municipality_dimension, read_municipalities
from igarape.sources.stations import read_stations


def _dimension(spark: SparkSession, path: str, members_only: bool = True) -> DataFrame:
    dimension = municipality_dimension(read_municipalities(spark, path), members_only)
    if dimension.isEmpty():
        raise ValueError(f"no municipalities in {path}")
    return dimension


@contextmanager
def _replacing(spark: SparkSession) -> Iterator[Replacement]:
    """The targets of a job, replaced together at its end; its intermediate tables go then."""
    with intermediate(spark), Replacement(spark) as targets:
        yield targets


def run_admissions(
    spark: SparkSession, csv_dir: str, municipalities: str, out_dir: str, separator: str = ",", states: str | None = None
) -> None:
    """Files separated by semicolons are taken to have a decimal comma.

    With `states`, a folder of totals per file, only new and changed files are read, and files that
    are gone no longer count. The folder must not be used with another list of municipalities.
    """
    paths = f"{csv_dir}/RDPA*.csv"
    with _replacing(spark) as targets:
        dimension = _dimension(spark, municipalities, members_only=False)
        number = decimal_comma_number if separator == ";" else to_number
        if states:
            kept = admissions.admission_states(spark, states)

            def read(new: list[str]) -> DataFrame:
                raw = admissions.read_admissions(spark, new, separator, with_source=True)
                return admissions.located_admissions(raw, dimension, number=number)

            kept.update(paths, read, SOURCE_FILE)
            silver = admissions.silver_of_states(kept)
        else:
            silver = admissions.admissions_silver(admissions.read_admissions(spark, paths, separator), dimension, number=number)
        targets.table(silver, out_dir, ["ano", "mes"], what="no admission matched the municipalities")


def run_water_quality(spark: SparkSession, input_dir: str, municipalities: str, out_dir: str) -> None:
    with _replacing(spark) as targets:
        raw = water_quality.read_water_samples(spark, input_dir)
        samples = water_quality.classified_samples(raw, _dimension(spark, municipalities))
        silver = water_quality.water_quality_silver(samples)
        targets.partitions(silver, out_dir, ["ano", "mes"], what="no sample matched the municipalities")


def run_climate(spark: SparkSession, input_dir: str, out_dir: str) -> None:
    with _replacing(spark) as targets:
        stations = read_stations(spark, f"{input_dir}/*/INMET_N_PA_*.CSV")
        targets.partitions(climate.climate_silver(stations), out_dir, ["estacao", "ano"], what="no station file was usable")


def run_finance(spark: SparkSession, input_path: str, municipalities: str, out: str) -> None:
    """Codes without a municipality are an error; they are all in the table `out` + "_unmatched"."""
    with _replacing(spark) as targets:
        indicators = finance.read_finance_indicators(spark, input_path)
        silver = finance.finance_silver(indicators, _dimension(spark, municipalities), f"{out.rstrip('/')}_unmatched")
        targets.table(silver, out, what="no finance indicator")


def run_population(spark: SparkSession, input_dir: str, out: str) -> None:
    with _replacing(spark) as targets:
        rows = population.read_population(spark, f"{input_dir}/sidra6579_pop_*.csv")
        targets.table(population.population_silver(rows), out, what="no population figure")


def run_service_indicators(
    spark: SparkSession, cells: str, municipalities: str, out_dir: str
) -> None:
    """Three tables: all extracted rows, one provider per municipality, and the repaired version."""
    with _replacing(spark) as targets:
        dimension = _dimension(spark, municipalities)
        extracted = service_indicators.extracted_indicators(read_target(spark, cells), dimension)
        raw = with_csv_twin(targets, extracted, f"{out_dir}/raw.parquet", f"{out_dir}/raw.csv", what="no indicator row")
        chosen = service_indicators.one_provider_per_municipality(raw)
        first = with_csv_twin(targets, chosen, f"{out_dir}/v1.parquet", f"{out_dir}/v1.csv")
        repaired = service_indicators.repaired_indicators(first, dimension)
        second = with_csv_twin(targets, repaired, f"{out_dir}/v2.parquet", f"{out_dir}/v2.csv", ["municipio", "ano"])
        numbers = [name for name, kind in second.dtypes if kind == "double"]
        targets.csv(minmax_summary(second, numbers), f"{out_dir}/v2_ranges.csv", ["coluna"])


def run_gold(
    spark: SparkSession,
    silver_dir: str,
    service: str,
    municipalities: str,
    out_parquet: str,
    out_csv: str,
) -> None:
    """Gold from the silver folders `sih`, `sisagua`, `inmet`, `siops`, `ibge_populacao` and the service table."""
    with _replacing(spark) as targets:
        dimension = _dimension(spark, municipalities)

        def read(path: str) -> DataFrame:
            return read_target(spark, path)

        quality = water_quality.quality_by_parameter(read(f"{silver_dir}/sisagua"), dimension)
        stations = climate.station_year(read(f"{silver_dir}/inmet"))
        table = gold.gold_features(
            dimension,
            population.population_by_year(read(f"{silver_dir}/ibge_populacao"), dimension),
            service_indicators.service_by_year(read(service), dimension),
            water_quality.quality_by_year(quality),
            climate.climate_by_municipality(stations, climate.station_bridge(spark), dimension),
            finance.finance_by_year(read(f"{silver_dir}/siops"), dimension),
            admissions.admissions_by_year(read(f"{silver_dir}/sih"), dimension),
        )
        with_csv_twin(targets, table, out_parquet, out_csv, ["cod_mun", "ano"], unique=["cod_mun", "ano"], what="gold")


def run_analysis(
    spark: SparkSession, gold_path: str, municipalities: str, out_dir: str, service: str | None = None
) -> None:
    """The analysis table for modelling, and the products answering each question, exported with one shared time."""
    with _replacing(spark) as targets:
        dimension = _dimension(spark, municipalities)
        gold_table = read_target(spark, gold_path)
        second = read_target(spark, service) if service else None
        rows = analysis.analysis_table(gold_table, dimension, second)
        table = targets.table(rows, f"{out_dir}/analysis.parquet", unique=["cod_mun", "ano"], what="the gold table is empty")
        products = {
            "coverage_by_year": analysis.coverage_by_year(gold_table, dimension),
            "missing_pairs": analysis.missing_pairs(gold_table, dimension),
            "driver_correlations": analysis.driver_correlations(table),
            "lag_correlation": analysis.lag_correlation(table),
            "latest_ranking": analysis.latest_ranking(table),
            "group_return": analysis.group_return(table),
            "priority_panel": analysis.priority_panel(table),
            "goals_tracker": analysis.goals_tracker(table),
        }
        now = generation_time()
        for name, product in products.items():
            targets.csv(stamped(product, now), f"{out_dir}/{name}.csv", may_be_empty=name == "missing_pairs")


def run_models(
    spark: SparkSession, analysis_path: str, out_dir: str, holdout_year: int = HOLDOUT_YEAR, **options
) -> None:
    """Metrics, importances, predictions, scenarios and holdout errors, exported with one shared time."""
    with _replacing(spark) as targets:
        now = generation_time()
        tables = run_modelling(read_target(spark, analysis_path), holdout_year=holdout_year, **options)
        for name, table in tables.items():
            targets.csv(stamped(table, now), f"{out_dir}/model_{name}.csv")


def run_payloads(spark: SparkSession, kind: str, input_path: str, out: str) -> None:
    """A table of landed answers: `finance`, `subfunctions` or `population`; an array that breaks off is an error."""
    readers = {
        "finance": payloads.finance_indicators,
        "subfunctions": payloads.finance_subfunctions,
        "population": payloads.population_records,
    }
    with _replacing(spark) as targets:
        targets.csv(readers[kind](spark, input_path), out)


def municipality_list(population_path: str, municipalities: str, spark: SparkSession) -> DataFrame:
    """Codes found in the population table with their names, NULL where the dimension lacks them."""
    dimension = _dimension(spark, municipalities, members_only=False)
    codes = read_target(spark, population_path).select(F.col("cod_mun").cast("string").alias("cod_mun")).distinct()
    names = dimension.select("cod_mun", F.upper("name").alias("municipio"))
    return codes.join(names, "cod_mun", "left").orderBy("cod_mun", "municipio")
