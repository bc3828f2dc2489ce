"""Hospital admissions: raw records -> monthly totals per municipality -> yearly totals."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.constants import ADMISSION_MEASURES, WATERBORNE_PREFIXES
from igarape.functions.numeric import to_number, to_whole
from igarape.functions.text import diagnosis_code, padded_code, starts_with_any, upper_ascii
from igarape.operators.accumulate import PartialStates
from igarape.operators.lookup import either_key, with_canonical_code
from igarape.schemas import ADMISSIONS_SILVER, conform
from igarape.sources.delimited import SOURCE_FILE, read_by_header

ADMISSION_KEYS = ["cod_mun", "municipio", "ano", "mes"]
_COLUMNS = ["ANO_CMPT", "MES_CMPT", "MUNIC_RES", "DIAG_PRINC", "DIAS_PERM", "VAL_TOT"]


def read_admissions(
    spark: SparkSession, paths: str | list[str], separator: str = ",", with_source: bool = False
) -> DataFrame:
    """The six columns used, as text, and if asked the file name; a file that lacks one is an error."""
    wanted = {c: [c] for c in _COLUMNS}
    rows = read_by_header(spark, paths, wanted, separator=separator, required=_COLUMNS)
    return rows.select(*_COLUMNS, *([SOURCE_FILE] if with_source else []))


def located_admissions(
    raw: DataFrame,
    dimension: DataFrame,
    prefixes: Sequence[str] = WATERBORNE_PREFIXES,
    number: Callable[[str], Column] = to_number,
) -> DataFrame:
    """Usable records of the dimension's municipalities: keys, whether waterborne, days and value.

    `number` reads the measures: to_number, or decimal_comma_number for files written
    with a decimal comma. The dimension is small enough to be broadcast.
    """
    waterborne = starts_with_any(diagnosis_code("DIAG_PRINC"), list(prefixes))
    records = raw.dropna(subset=["ANO_CMPT", "MES_CMPT", "MUNIC_RES"]).select(
        padded_code("MUNIC_RES").alias("lookup_code"),
        to_whole("ANO_CMPT").alias("ano"),
        to_whole("MES_CMPT").alias("mes"),
        waterborne.alias("hidrica"),
        F.coalesce(number("DIAS_PERM"), F.lit(0.0)).alias("dias"),
        F.coalesce(number("VAL_TOT"), F.lit(0.0)).alias("valor"),
        *[c for c in (SOURCE_FILE,) if c in raw.columns],
    )
    names = either_key(dimension).select(
        "lookup_code", "cod_mun", upper_ascii("name").alias("municipio")
    )
    return records.dropna(subset=["ano", "mes"]).join(names, "lookup_code")


def admissions_silver(
    raw: DataFrame,
    dimension: DataFrame,
    prefixes: Sequence[str] = WATERBORNE_PREFIXES,
    number: Callable[[str], Column] = to_number,
) -> DataFrame:
    """Totals and waterborne totals per municipality and month; the only shuffle is that of the partial sums."""
    located = located_admissions(raw, dimension, prefixes, number)
    totals = located.groupBy(*ADMISSION_KEYS).agg(
        F.count("*").alias("internacoes_total"),
        F.count_if("hidrica").alias("internacoes_hidricas"),
        F.sum("dias").alias("dias_perm_total"),
        F.sum(F.when(F.col("hidrica"), F.col("dias")).otherwise(0.0)).alias("dias_perm_hidricas"),
        F.sum("valor").alias("valor_total"),
        F.sum(F.when(F.col("hidrica"), F.col("valor")).otherwise(0.0)).alias("valor_hidricas"),
    )
    return conform(totals, ADMISSIONS_SILVER)


def admission_states(spark: SparkSession, path: str) -> PartialStates:
    """Partial totals per source file; waterborne records have figures of their own."""
    hidrica = F.col("hidrica")
    figures = {
        "dias": F.col("dias"),
        "valor": F.col("valor"),
        "dias_hidricas": F.when(hidrica, F.col("dias")),
        "valor_hidricas": F.when(hidrica, F.col("valor")),
    }
    return PartialStates(spark, path, ADMISSION_KEYS, figures)


def silver_of_states(states: PartialStates) -> DataFrame:
    """The silver table from all files that are in."""
    return conform(
        states.total().select(
            *ADMISSION_KEYS,
            F.col("rows").alias("internacoes_total"),
            F.col("count_dias_hidricas").alias("internacoes_hidricas"),
            F.col("sum_dias").alias("dias_perm_total"),
            F.coalesce("sum_dias_hidricas", F.lit(0.0)).alias("dias_perm_hidricas"),
            F.col("sum_valor").alias("valor_total"),
            F.coalesce("sum_valor_hidricas", F.lit(0.0)).alias("valor_hidricas"),
        ),
        ADMISSIONS_SILVER,
    )


def admissions_by_year(silver: DataFrame, dimension: DataFrame) -> DataFrame:
    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy("cod_mun", "ano").agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in ADMISSION_MEASURES])

    # Summed by raw code first, so that the look-up joins a few rows.
    return sums(with_canonical_code(sums(silver), dimension, "cod_mun"))


def member_share(raw: DataFrame, dimension: DataFrame) -> DataFrame:
    """Record count, records of member municipalities, and their share in percent."""
    members = either_key(dimension).select("lookup_code", F.lit(1).alias("membro"))
    coded = raw.select(padded_code("MUNIC_RES").alias("lookup_code"))
    flagged = coded.join(members, "lookup_code", "left")
    return flagged.agg(
        F.count("*").alias("registros"),
        F.count("membro").alias("registros_membros"),
        (F.avg(F.coalesce("membro", F.lit(0))) * 100).alias("pct_membros"),
    )
