"""Standard forms for free text and code-like text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def tidy(value: Column | str) -> Column:
    """Free text without stray blanks at either end."""
    return F.trim(_col(value))


def title_case(value: Column | str) -> Column:
    """Trimmed, each word with a capital first letter."""
    return F.initcap(tidy(value))


def code_upper(value: Column | str) -> Column:
    """Trimmed and in capitals."""
    return F.upper(tidy(value))


def code_lower(value: Column | str) -> Column:
    """Trimmed and in small letters."""
    return F.lower(tidy(value))
