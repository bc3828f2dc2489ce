"""Number expressions. Bad input gives NULL, never an error or NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from igarape.functions.text import as_column

# What counts as a number in text (no hex, no type suffix, no infinities).
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(value: Column | str) -> Column:
    """Text to double; anything else than a plain number is NULL."""
    text = as_column(value).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def to_whole(value: Column | str) -> Column:
    """Text to int through double, so that "2020.0" reads as 2020."""
    return to_number(value).try_cast("int")


def nan_to_null(value: Column | str) -> Column:
    number = as_column(value)
    return F.when(~F.isnan(number), number)


def decimal_comma(value: Column | str) -> Column:
    """Tolerant reading: with a comma, dots group thousands; without, the dot is decimal."""
    kept = F.regexp_replace(as_column(value).cast("string"), "[^0-9,.-]", "")
    grouped = F.translate(kept, ",.", ".")
    return to_number(F.when(F.contains(kept, F.lit(",")), grouped).otherwise(kept))


def decimal_comma_number(value: Column | str) -> Column:
    """The comma is the decimal sign and nothing else is repaired: "12abc" and "1.234,5" are NULL, "1e3" is 1000."""
    return to_number(F.translate(as_column(value).cast("string"), ",", "."))


# --- fixed values: words read as missing by the strict reading ---------------
_MISSING_WORDS = ["na", "nan", "null", "none", "sem informacao"]


def decimal_comma_strict(value: Column | str) -> Column:
    """Strict reading: a dot always groups thousands, so "1.5" is 15."""
    text = F.trim(as_column(value).cast("string"))
    number = to_number(F.translate(text, ",.", "."))
    return F.when(~F.lower(text).isin(_MISSING_WORDS), number)


def guarded_ratio(numerator: Column | str, denominator: Column | str, scale: float = 1.0) -> Column:
    """numerator / denominator * scale where the denominator is positive, else NULL."""
    top, bottom = as_column(numerator), as_column(denominator)
    ratio = top / bottom
    return F.when(bottom > 0, ratio if scale == 1.0 else ratio * F.lit(scale))


def clip(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]; NULL stays NULL (least and greatest alone would skip it)."""
    number = as_column(value)
    limited = number
    if low is not None:
        limited = F.greatest(limited, F.lit(low))
    if high is not None:
        limited = F.least(limited, F.lit(high))
    return F.when(number.isNotNull(), limited)


def repair_scale(value: Column | str, limit: float, divisor: float = 100.0) -> Column:
    """Divide once where the value is above the limit."""
    number = as_column(value)
    return F.when(number > limit, number / divisor).otherwise(number)


def sum_skipping_null(columns: list[str]) -> Column:
    total = F.lit(0.0)
    for name in columns:
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return total


def absolute_error(predicted: Column | str, observed: Column | str) -> Column:
    return F.abs(as_column(predicted) - as_column(observed))


def absolute_percentage_error(predicted: Column | str, observed: Column | str) -> Column:
    size = F.abs(as_column(observed))
    return F.when(size > 0, absolute_error(predicted, observed) / size * 100)


def weighted_sum(weights: dict[str, float], value=F.col) -> Column:
    """Sum of weight * value(name), in the order given."""
    total = None
    for name, weight in weights.items():
        term = F.lit(weight) * value(name)
        total = term if total is None else total + term
    return total


def numbers_in_text(value: Column | str) -> Column:
    """All numbers of a text as array<double>; dots group thousands, the comma is decimal."""
    found = F.regexp_extract_all(as_column(value), F.lit(r"\d+(?:[.,]\d+)?"), F.lit(0))
    return F.transform(found, lambda n: F.translate(n, ",.", ".").cast("double"))


def right_closed_label(value: Column | str, edges: list[float], labels: list[str]) -> Column:
    """Label of the right-closed interval the value falls in; NULL stays NULL."""
    number = as_column(value)
    chosen = F.when(number <= edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        chosen = chosen.when(number <= edge, label)
    return chosen.when(number.isNotNull(), labels[-1])


def goal_status(value: Column | str, kind: str, goal: float) -> Column:
    """"OK" or "Alerta" against a goal, "Sem dado" for NULL; kind is "max" or "min"."""
    number = as_column(value)
    reached = number <= goal if kind == "max" else number >= goal
    return F.when(number.isNull(), "Sem dado").when(reached, "OK").otherwise("Alerta")
