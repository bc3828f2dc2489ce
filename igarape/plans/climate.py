"""Climate: station files -> hourly silver -> yearly figures per municipality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from igarape.constants import HEAT_THRESHOLD_C, STATION_MEASURES, STATION_MUNICIPALITIES
from igarape.functions.dates import station_timestamp
from igarape.functions.numeric import decimal_comma_number
from igarape.operators.lookup import fan_out
from igarape.schemas import CLIMATE_SILVER, conform


def climate_silver(stations: DataFrame) -> DataFrame:
    """Typed hourly readings; rows whose date or hour does not parse drop out."""
    timed = stations.withColumns(
        {
            "timestamp_utc": station_timestamp("data", "hora_utc"),
            **{m: decimal_comma_number(m) for m in STATION_MEASURES},
        }
    ).filter(F.col("timestamp_utc").isNotNull())
    dated = timed.withColumns({"ano": F.year("timestamp_utc"), "mes": F.month("timestamp_utc")})
    return conform(dated, CLIMATE_SILVER)


def station_year(silver: DataFrame, heat_threshold: float = HEAT_THRESHOLD_C) -> DataFrame:
    """Yearly figures per station.

    One pass: readings are first reduced to days (sums, counts, extremes), and
    both the yearly figures and the hot-day count come from the day rows.
    """
    readings = silver.dropna(subset=["estacao", "ano"])
    means = {"temp_c": "temp_media_c", "umid_rel_pct": "umid_rel_media_pct", "vento_vel_ms": "vento_vel_media_ms"}
    days = readings.groupBy("estacao", "ano", F.to_date("timestamp_utc").alias("dia")).agg(
        F.count("*").alias("horas"),
        F.sum(F.coalesce("chuva_mm", F.lit(0.0))).alias("chuva"),
        F.max("temp_c").alias("temp_max"),
        F.min("temp_c").alias("temp_min"),
        *[F.sum(c).alias(f"soma_{c}") for c in means],
        *[F.count(c).alias(f"n_{c}") for c in means],
    )
    hot = F.col("dia").isNotNull() & (F.col("temp_max") >= heat_threshold)
    return days.groupBy("estacao", "ano").agg(
        F.sum("chuva").alias("chuva_total_mm"),
        (F.sum("chuva") / F.sum("horas")).alias("chuva_media_mm"),
        F.try_divide(F.sum("soma_temp_c"), F.sum("n_temp_c")).alias("temp_media_c"),
        F.max("temp_max").alias("temp_max_c"),
        F.min("temp_min").alias("temp_min_c"),
        *[
            F.try_divide(F.sum(f"soma_{c}"), F.sum(f"n_{c}")).alias(name)
            for c, name in means.items()
            if c != "temp_c"
        ],
        F.count_if(hot).alias("dias_calor_extremo"),
    )


def climate_by_municipality(by_station: DataFrame, bridge: DataFrame, dimension: DataFrame) -> DataFrame:
    """Station figures repeated for the municipalities a station stands for."""
    spread = fan_out(by_station, bridge, "estacao").drop("estacao")
    return spread.join(dimension.select("cod_mun"), "cod_mun", "left_semi")


def station_bridge(spark) -> DataFrame:
    return spark.createDataFrame(STATION_MUNICIPALITIES, "estacao string, cod_mun string")
