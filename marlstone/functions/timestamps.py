"""Dates that arrive in many shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date layouts, in order of preference.  Month-first
# comes before day-first, so an ambiguous date is read as month-day.
MESSY_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "MM/dd/yyyy",
    "MM/dd/yyyy HH:mm:ss",
    "MM-dd-yyyy",
    "MM-dd-yyyy HH:mm:ss",
    "M/d/yyyy",
    "yyyy/MM/dd",
    "dd-MM-yyyy HH:mm",
    "dd-MM-yyyy",
    "yyyy-MM-dd",
)

# The everyday spellings of those layouts: all numbers fully written out.
_CLOCK = "[0-9]{2}:[0-9]{2}:[0-9]{2}"
_PLAIN = (
    r"^(?:"
    rf"[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?:[ T]{_CLOCK})?"
    r"|[0-9]{4}/[0-9]{2}/[0-9]{2}"
    rf"|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}} {_CLOCK}"
    r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
    rf"|[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}(?: {_CLOCK}| [0-9]{{2}}:[0-9]{{2}})?"
    r")\z"
)
# Every layout starts with three numbers; text without that start cannot be read.
_DATE_LIKE = r"^[+-]?[0-9]+[-/][+-]?[0-9]+[-/][+-]?[0-9]+"


def parse_in_order(value: Column | str, formats=MESSY_FORMATS) -> Column:
    """First layout that reads the text wins; NULL when none does."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(layout)) for layout in formats])


def _year_first(value: Column) -> Column:
    """Rewrite a plainly spelled date as ``yyyy-MM-dd[ HH:mm:ss]``."""
    size = F.length(value)
    mark = F.substring(value, 3, 1)
    first, second = F.substring(value, 1, 2), F.substring(value, 4, 2)
    year, clock = F.substring(value, 7, 4), F.substring(value, 11, 9)
    # Without seconds the layout is day-first.  A bare date is month-first unless
    # its first number is no month; then only day-first can read it.
    day_first = (mark == "-") & ((size == 16) | ((size == 10) & (first > "12")))
    one_digit = F.concat_ws(
        "-",
        F.substring_index(value, "/", -1),
        F.substring_index(value, "/", 1),
        F.substring_index(F.substring_index(value, "/", 2), "/", -1),
    )
    return (
        F.when(size < 10, one_digit)
        .when(F.substring(value, 5, 1) == "-", value)
        .when(F.substring(value, 5, 1) == "/", F.translate(value, "/", "-"))
        .otherwise(F.concat(
            year, F.lit("-"), F.when(day_first, second).otherwise(first),
            F.lit("-"), F.when(day_first, first).otherwise(second),
            clock, F.when(size == 16, ":00").otherwise(""),
        ))
    )


def parse_messy_timestamp(value: Column | str) -> Column:
    """Same result as ``parse_in_order`` over all layouts, at a fraction of its cost.

    A failed layout raises and catches an exception inside the JVM, so trying them
    one after another costs up to ten exceptions per row.  Plain spellings are
    recognised by one pattern, put year first and cast (no exception even for
    30 February); only rare spellings, such as signed years, walk the list.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.when(
        value.rlike(_PLAIN), _year_first(value).try_cast("timestamp")
    ).when(value.rlike(_DATE_LIKE), parse_in_order(value))
