"""Date and hour expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from igarape.functions.text import as_column, zero_fill


def hour_text(value: Column | str) -> Column:
    """"0000 UTC", "00:00" or "0" as four digits."""
    text = F.replace(as_column(value).cast("string"), F.lit(" UTC"), F.lit(""))
    return zero_fill(F.translate(text, ":", ""), 4)


def station_timestamp(date: Column | str, hour: Column | str) -> Column:
    """Timestamp from a yyyy/MM/dd or yyyy-MM-dd date and an hour text; NULL if either is bad."""
    day = F.translate(as_column(date), "/", "-")
    clock = hour_text(hour)
    text = F.concat(day, F.lit(" "), F.left(clock, F.lit(2)), F.lit(":"), F.substring(clock, 3, 2))
    return F.when(
        day.rlike(r"^\d{4}-\d{2}-\d{2}$") & clock.rlike(r"^\d{4}$"),
        text.try_cast("timestamp_ntz"),
    )
