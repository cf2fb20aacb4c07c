"""Year tags such as ``(2024)`` and ``(2024 est.)`` in value text.  Years stay strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the two year forms and the limits of a plain data point
ESTIMATED_YEAR = r"\(([0-9]{4}) est\.\)"
PLAIN_YEAR = r"\(([0-9]{4})\)"
ANY_YEAR = r"\(([0-9]{4})(?: est\.)?\)"
MAX_VALUE_LENGTH = 120
MAX_YEARS_IN_VALUE = 1


def is_data_point(
    value: Column, max_length: int = MAX_VALUE_LENGTH, max_years: int = MAX_YEARS_IN_VALUE
) -> Column:
    """False for text that looks descriptive: several years, or one year in a long text."""
    found = F.regexp_count(value, F.lit(ANY_YEAR))
    fits = (found <= max_years) & ((found != 1) | (F.char_length(value) <= max_length))
    return F.coalesce((value != "") & fits, F.lit(False))


def year_tag(
    value: Column, max_length: int = MAX_VALUE_LENGTH, max_years: int | None = MAX_YEARS_IN_VALUE
) -> Column:
    """The year of a data point: the first estimated one, else the first plain one, else null.

    Descriptive text has none, unless ``max_years`` is None: then every text may.
    """
    if max_years == 1:
        # with a single match its form does not matter; most values have none and stop at once
        single = value.rlike(ANY_YEAR) & ~value.rlike(f"(?s){ANY_YEAR}.*{ANY_YEAR}")
        fits = F.char_length(value) <= max_length
        return F.when(single & fits, F.regexp_extract(value, ANY_YEAR, 1))
    first = F.coalesce(
        F.nullif(F.regexp_extract(value, ESTIMATED_YEAR, 1), F.lit("")),
        F.nullif(F.regexp_extract(value, PLAIN_YEAR, 1), F.lit("")),
    )
    return first if max_years is None else F.when(is_data_point(value, max_length, max_years), first)
