"""Declared schemas of the layer tables."""

from __future__ import annotations

from pyspark.sql import types as T

from igarape.constants import ADMISSION_MEASURES, FINANCE_INDICATORS, STATION_MEASURES

MUNICIPALITIES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("ibge_code", T.StringType()),
        T.StructField("uf", T.StringType()),
        T.StructField("is_rmb", T.IntegerType()),
    ]
)

ADMISSIONS_SILVER = T.StructType(
    [
        T.StructField("cod_mun", T.StringType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("ano", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
        *[
            T.StructField(m, T.LongType() if m.startswith("internacoes") else T.DoubleType())
            for m in ADMISSION_MEASURES
        ],
    ]
)

CLIMATE_SILVER = T.StructType(
    [
        T.StructField("timestamp_utc", T.TimestampNTZType()),
        T.StructField("ano", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
        T.StructField("estacao", T.StringType()),
        *[T.StructField(m, T.DoubleType()) for m in STATION_MEASURES],
    ]
)

FINANCE_SILVER = T.StructType(
    [
        T.StructField("cod_mun", T.StringType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("ano", T.IntegerType()),
        *[T.StructField(column, T.DoubleType()) for column, _ in FINANCE_INDICATORS.values()],
    ]
)

POPULATION_SILVER = T.StructType(
    [
        T.StructField("cod_mun", T.IntegerType()),
        T.StructField("ano", T.IntegerType()),
        T.StructField("populacao", T.IntegerType()),
    ]
)

# One element of the finance indicator payload.
FINANCE_PAYLOAD = T.ArrayType(
    T.StructType(
        [
            T.StructField("numero_indicador", T.StringType()),
            T.StructField("ds_indicador", T.StringType()),
            T.StructField("numerador", T.DoubleType()),
            T.StructField("denominador", T.DoubleType()),
            T.StructField("indicador_calculado", T.DoubleType()),
        ]
    )
)

# Population payload: field -> column of the landed table.
POPULATION_FIELDS = {
    "D1C": "municipio_codigo",
    "D1N": "municipio_nome",
    "D3C": "ano",
    "D2C": "variavel_codigo",
    "D2N": "variavel_nome",
    "MC": "unidade_codigo",
    "MN": "unidade_nome",
    "V": "valor",
}

RESOURCE_PAYLOAD = T.ArrayType(
    T.StructType([T.StructField("format", T.StringType()), T.StructField("url", T.StringType())])
)


def conform(df, schema: T.StructType):
    """Columns of the schema, in its order, cast to its types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
