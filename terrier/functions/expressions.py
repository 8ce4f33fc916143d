"""Scalar expressions of the cleaning and feature steps.

Each function takes a column (or its name) and returns a column built from SQL built-ins, so
Catalyst can fold, push down and compile it. No Python runs per row. Where an argument may be costly
(a parsed text), the expression refers to it once: branches of a ``CASE`` are not shared subexpressions
in compiled code, so each further mention would evaluate it again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "OUTDOOR_EDGES",
    "OUTDOOR_LABELS",
    "PRICE_FLOOR",
    "bin_outdoor_area",
    "bin_right_closed",
    "category_indicator",
    "collapse_multi_plot",
    "exp_price",
    "fill_missing_zero",
    "is_finite",
    "log_target",
    "month_cos",
    "month_sin",
    "nan_to_null",
    "normal_city_id",
    "parse_date",
    "parse_integer",
    "parse_number",
    "parse_quarter",
    "parse_year",
    "price_per_m2",
    "scale_minmax",
    "scale_standard",
    "strip_braces",
    "sum_multi_plot",
    "unique_city_id",
    "upper_name",
    "year_month_numeric",
]

# Right-closed bin edges of the land area and their labels.
OUTDOOR_EDGES = [-1.0, 0.0, 200.0, 1000.0, math.inf]
OUTDOOR_LABELS = [
    "No garden",
    "Small outdoor space",
    "Average outdoor space",
    "Large outdoor space",
]

# Fixed value: stands in for a price per square metre that is zero or undefined.
PRICE_FLOOR = 1e-5

_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nan_to_null(value: Column | str) -> Column:
    return F.nanvl(_col(value).cast("double"), F.lit(None).cast("double"))


def is_finite(value: Column | str) -> Column:
    """True for a value that is neither NULL, NaN nor infinite."""
    value = _col(value)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(math.inf))


# -- text and dates ----------------------------------------------------------------------------


def parse_date(text: Column | str) -> Column:
    """Calendar date of a date or timestamp text; anything else is NULL."""
    return _col(text).try_cast("timestamp_ntz").try_cast("date")


def parse_year(year: Column | str) -> Column:
    """1 January of a year given as number or text."""
    return F.make_date(parse_integer(_col(year)), F.lit(1), F.lit(1))


def parse_quarter(text: Column | str) -> Column:
    """First day of a quarter such as ``2014-Q3``, ``2014Q3``, ``Q3 2014`` or a plain date."""
    text = _col(text)
    year = F.regexp_extract(text, r"(\d{4})", 1).try_cast("int")
    quarter = F.regexp_extract(text, r"[QqTt]([1-4])|([1-4])[QqTt]\d{4}", 0)
    quarter = F.regexp_extract(quarter, r"[QqTt]([1-4])", 1).try_cast("int")
    leading = F.regexp_extract(text, r"^\s*([1-4])[QqTt]", 1).try_cast("int")
    number = F.coalesce(quarter, leading)
    return F.coalesce(
        F.when(year.isNotNull() & number.isNotNull(), F.make_date(year, (number - 1) * 3 + 1, F.lit(1))),
        F.trunc(parse_date(text), "quarter"),
    )


def parse_number(text: Column | str) -> Column:
    """Text to double; text that is not a plain number (``1d`` and ``1f`` included) is NULL."""
    return F.regexp_extract(_col(text).cast("string"), _NUMBER, 0).try_cast("double")


def parse_integer(value: Column | str) -> Column:
    """Number or numeric text to int, truncating; NULL when it does not parse or fit."""
    return parse_number(value).try_cast("int")


def strip_braces(text: Column | str) -> Column:
    return F.translate(_col(text), "{}", "")


def collapse_multi_plot(text: Column | str) -> Column:
    """A list of several plots counts as no plot: text with a comma becomes ``0``."""
    return F.regexp_replace(_col(text), r"(?s)^.*,.*$", "0")


def sum_multi_plot(text: Column | str) -> Column:
    """Optional alternative to :func:`collapse_multi_plot`: add up the listed plots."""
    plots = F.transform(F.split(_col(text), ","), lambda plot: fill_missing_zero(parse_number(plot)))
    return F.aggregate(plots, F.lit(0.0), lambda total, plot: total + plot).cast("string")


def fill_missing_zero(value: Column | str) -> Column:
    return F.coalesce(nan_to_null(value), F.lit(0.0))


def upper_name(text: Column | str) -> Column:
    return F.upper(_col(text))


def unique_city_id(departement: Column | str, id_ville: Column | str) -> Column:
    """City key as the text ``(dep,id)``."""
    return F.concat(F.lit("("), _col(departement).cast("string"), F.lit(","), _col(id_ville).cast("string"), F.lit(")"))


def normal_city_id(text: Column | str) -> Column:
    """City key of an outside request without blanks: ``(27, 185)`` is ``(27,185)``."""
    return F.regexp_replace(_col(text), r"\s", "")


# -- time --------------------------------------------------------------------------------------


def year_month_numeric(date: Column | str) -> Column:
    date = _col(date)
    return (F.year(date) * 12 + F.month(date)).cast("int")


def month_sin(date: Column | str) -> Column:
    return F.sin(F.month(_col(date)) * (2 * math.pi) / 12)


def month_cos(date: Column | str) -> Column:
    return F.cos(F.month(_col(date)) * (2 * math.pi) / 12)


# -- price -------------------------------------------------------------------------------------


def price_per_m2(price: Column | str, area: Column | str) -> Column:
    """Price over area, with IEEE results for a zero area and a floor for 0 and 0/0."""
    price, area = _col(price).cast("double"), _col(area).cast("double")
    infinite = F.when(price > 0, F.lit(math.inf)).when(price < 0, F.lit(-math.inf))
    ratio = F.when(area == 0, infinite).otherwise(F.try_divide(price, area))
    return F.when(ratio.isNull() | F.isnan(ratio) | (ratio == 0), F.lit(PRICE_FLOOR)).otherwise(ratio)


def log_target(price: Column | str, area: Column | str) -> Column:
    """Natural log of :func:`price_per_m2`; a negative price gives NULL."""
    return F.ln(price_per_m2(price, area))


def exp_price(log_price: Column | str) -> Column:
    return F.exp(_col(log_price))


# -- bins, scales, indicators ------------------------------------------------------------------


def bin_right_closed(value: Column | str, edges: list[float], labels: list[str]) -> Column:
    """Label of the bin ``(edge[i], edge[i+1]]`` that holds the value; outside all bins is NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    value = nan_to_null(value)
    label = F.when(value <= F.lit(float(edges[0])), F.lit(None).cast("string"))
    for upper, name in zip(edges[1:], labels):
        label = label.when(value <= F.lit(float(upper)), F.lit(name))
    return label


def bin_outdoor_area(value: Column | str) -> Column:
    return bin_right_closed(_col(value).cast("float"), OUTDOOR_EDGES, OUTDOOR_LABELS)


def scale_minmax(value: Column | str, low: float | None, high: float | None) -> Column:
    """Map the fitted range to [0, 1] without clipping; a constant column maps to 0."""
    value = _col(value).cast("double")
    if low is None or high is None:
        return value
    return (value - F.lit(float(low))) / F.lit(float(high - low) or 1.0)


def scale_standard(value: Column | str, mean: float | None, std: float | None) -> Column:
    """Centre and divide by the fitted population deviation; a constant column maps to 0."""
    value = _col(value).cast("double")
    if mean is None or std is None:
        return value
    return (value - F.lit(float(mean))) / F.lit(float(std) or 1.0)


def category_indicator(value: Column | str, category: str) -> Column:
    """1 where the value is the category, else 0; NULL counts as another value."""
    return F.when(_col(value) == F.lit(category), 1).otherwise(0)
