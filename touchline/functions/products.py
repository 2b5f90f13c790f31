"""Event lists and product lists."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.text import WHITESPACE_CLASS, strip

PURCHASE_EVENT = "1"

# A decimal number as price fields hold it; nan and infinity are no revenue.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = rf"[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
LINE_REVENUE = (
    rf"^[^;]*;[^;]*;[^;]*;{WHITESPACE_CLASS}*({_NUMBER}){WHITESPACE_CLASS}*(?:;|\z)"
)


def event_array(events: Column) -> Column:
    """Comma list to array, items trimmed."""
    return F.transform(F.split(events, ","), lambda item: strip(item))


def has_event(events: Column, event: str = PURCHASE_EVENT) -> Column:
    """True if the list holds the item; a regular expression keeps this in generated code."""
    return events.contains(event) & events.rlike(
        rf"(?:^|,){WHITESPACE_CLASS}*{re.escape(event)}{WHITESPACE_CLASS}*(?:,|\z)"
    )


def has_products(products: Column) -> Column:
    return strip(products) != ""


def _number(line: Column) -> Column:
    """Fourth field of one product as a double; null where it is missing, blank or no number."""
    return F.regexp_replace(F.regexp_extract(line, LINE_REVENUE, 1), "_", "").try_cast("double")


def _finite(value: Column) -> Column:
    """0 for null and for what 1e999, which the pattern lets through, is as a double."""
    return F.when(F.abs(value) < F.lit(float("inf")), value).otherwise(F.lit(0.0))


def line_revenue(line: Column) -> Column:
    """Fourth field of one product; 0 where it is missing, blank or no number."""
    return _finite(_number(line))


def product_lines(products: Column) -> Column:
    """Array of (category, product, quantity, revenue) for products with four fields or more."""
    lines = F.filter(F.split(products, ","), lambda line: F.size(F.split(line, ";")) >= 4)
    return F.transform(
        lines,
        lambda line: F.struct(
            strip(F.get(F.split(line, ";"), F.lit(0))).alias("category"),
            strip(F.get(F.split(line, ";"), F.lit(1))).alias("product"),
            strip(F.get(F.split(line, ";"), F.lit(2))).alias("quantity"),
            line_revenue(line).alias("revenue"),
        ),
    )


def product_revenue(products: Column) -> Column:
    """Revenue of a hit: the sum over its products. Numbers come first, so each is read only once."""
    numbers = F.transform(F.split(products, ","), _number)
    return F.aggregate(numbers, F.lit(0.0), lambda total, value: total + _finite(value))
