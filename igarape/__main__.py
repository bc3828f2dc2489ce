"""Command line: python -m igarape JOB --options (also as the main file of spark-submit)."""

from __future__ import annotations

import argparse

from igarape import jobs
from igarape.session import build_session

_MUNICIPALITIES = "config/municipalities.csv"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="igarape")
    commands = top.add_subparsers(dest="job", required=True)

    def job(name: str, **defaults: str | None) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        for option, default in defaults.items():
            command.add_argument("--" + option.replace("_", "-"), default=default)
        return command

    water = {"input_dir": "data/bronze/sisagua", "municipios": _MUNICIPALITIES, "output_dir": "data/silver/sisagua"}
    job("water-quality", **water)
    admissions = job("admissions", csv_dir="data/bronze/sih/csv", municipios=_MUNICIPALITIES, out_dir="data/silver/sih")
    admissions.add_argument("--separator", default=",")
    admissions.add_argument("--states", help="folder of totals per file: only new and changed files are read")
    admissions.add_argument("--chunksize", help="accepted and ignored: Spark splits files itself")
    job("climate", input_dir="data/bronze/inmet", output_dir="data/silver/inmet")
    job(
        "finance",
        input="data/bronze/siops/*.csv",
        municipios=_MUNICIPALITIES,
        out="data/silver/siops",
    )
    job("population", input_dir="data/bronze/ibge", output_file="data/silver/ibge_populacao")
    job("service-indicators", cells="data/bronze/snis/cells.parquet", municipios=_MUNICIPALITIES, out_dir="data/gold/snis")
    landed = job("payloads", input="data/landing/siops/*.json", out="data/bronze/siops/indicators.csv")
    landed.add_argument("--kind", choices=["finance", "subfunctions", "population"], default="finance")
    job(
        "gold",
        silver_dir="data/silver",
        service="data/gold/snis/v2.parquet",
        municipios=_MUNICIPALITIES,
        out_parquet="data/gold/features.parquet",
        out_csv="data/gold/features.csv",
    )
    job(
        "analysis",
        gold="data/gold/features.parquet",
        service=None,
        municipios=_MUNICIPALITIES,
        out_dir="data/exports",
    )
    models = job("modelling", analysis="data/exports/analysis.parquet", out_dir="data/exports")
    models.add_argument("--holdout-year", type=int, default=2025)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"igarape {args.job}")
    if args.job == "water-quality":
        jobs.run_water_quality(spark, args.input_dir, args.municipios, args.output_dir)
    elif args.job == "admissions":
        jobs.run_admissions(spark, args.csv_dir, args.municipios, args.out_dir, args.separator, args.states)
    elif args.job == "climate":
        jobs.run_climate(spark, args.input_dir, args.output_dir)
    elif args.job == "finance":
        jobs.run_finance(spark, args.input, args.municipios, args.out)
    elif args.job == "population":
        jobs.run_population(spark, args.input_dir, args.output_file)
    elif args.job == "service-indicators":
        jobs.run_service_indicators(spark, args.cells, args.municipios, args.out_dir)
    elif args.job == "payloads":
        jobs.run_payloads(spark, args.kind, args.input, args.out)
    elif args.job == "gold":
        jobs.run_gold(spark, args.silver_dir, args.service, args.municipios, args.out_parquet, args.out_csv)
    elif args.job == "analysis":
        jobs.run_analysis(spark, args.gold, args.municipios, args.out_dir, args.service)
    else:
        jobs.run_models(spark, args.analysis, args.out_dir, args.holdout_year)


if __name__ == "__main__":
    main()
