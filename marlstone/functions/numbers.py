"""Guards for money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def positive_price(price: Column | str) -> Column:
    """The price, or NULL where it is missing, zero or negative."""
    price = _col(price)
    return F.when(price > 0, price)


def line_revenue(quantity: Column | str, price: Column | str) -> Column:
    """Quantity times a valid price, to the cent; NULL without a valid price."""
    return F.round(_col(quantity) * positive_price(price), 2)


def safe_ratio(part: Column, whole: Column) -> Column:
    """Division that yields NULL for a zero or missing divisor."""
    return F.try_divide(part, whole)
