"""Normalisation of free-form dates to ISO strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldmill.functions.binding import let
from fieldmill.functions.text import strip

# fixed values: accepted date forms in order of preference, and how to read them
_ISO_FORM = ("([0-9]{4}-[0-9]{2}-[0-9]{2})", "yyyy-MM-dd")
_DATE_FORMS = (
    ("([A-Za-z]+ [0-9]{1,2}, [0-9]{4})", "MMMM d, yyyy"),
    ("([0-9]{1,2} [A-Za-z]+ [0-9]{4})", "d MMMM yyyy"),
    ("([A-Za-z]+ [0-9]{4})", "MMMM yyyy"),
)
_YEAR_FORM = "([0-9]{4})"
_MONTH_NAMES = (
    "January|February|March|April|May|June|July|August|September|October|November|December"
)


def _parser(fmt: str):
    """Function from found text to its ISO form, null if it is no date.

    A failing parse costs an exception, so text that cannot be a date is not even tried.
    """
    plausible = f"(?i)^(?:[0-9]+ )?(?:{_MONTH_NAMES}) " if "MMMM" in fmt else "^[0-9]"

    def parse(found: Column) -> Column:
        date = F.try_to_date(F.when(found.rlike(plausible), found), fmt)
        return F.date_format(date, "yyyy-MM-dd")

    return parse


def normalize_date(text: Column, iso_first: bool = False) -> Column:
    """ISO date string of the first form that parses; the stripped text itself when none does.

    ``iso_first`` also accepts ``yyyy-MM-dd``, which otherwise falls back to its year.
    """
    forms = (_ISO_FORM, *_DATE_FORMS) if iso_first else _DATE_FORMS

    def normalized(clean: Column) -> Column:
        parsed = [let(F.regexp_extract(clean, p, 1), _parser(fmt)) for p, fmt in forms]
        year = F.nullif(F.regexp_extract(clean, _YEAR_FORM, 1), F.lit(""))
        return F.when(clean != "", F.coalesce(*parsed, F.concat(year, F.lit("-01-01")), clean))

    return let(strip(text), normalized)


def to_date(text: Column, iso_first: bool = False) -> Column:
    """``normalize_date`` as DATE; null when the text holds no date."""
    return F.try_to_date(normalize_date(text, iso_first), "yyyy-MM-dd")
