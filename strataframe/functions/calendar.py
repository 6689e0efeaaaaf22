"""Date and month-key expressions.  A month key is text "YYYY-MM" and sorts in time order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataframe.functions.text import zero_padded

# Month names of the gold contract.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
MONTH_COLUMNS = tuple(name.lower() for name in MONTH_NAMES)

# The period labels and the month that separates them.
PERIOD_CUT = "2020-03"
PERIOD_BEFORE = "Pre-COVID"
PERIOD_AFTER = "Pandemia"


def month_key_of(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_key_from_parts(year: Column, month: Column) -> Column:
    """NULL as soon as one part is NULL or the month is none of 1..12."""
    number = month.cast("string").try_cast("int")
    return F.when(number.between(1, 12), F.concat(year.cast("string"), F.lit("-"), zero_padded(number)))


def first_of_month(year: Column, month: Column) -> Column:
    """Date from parts; a month outside 1..12 gives NULL instead of an error."""
    inside = month.between(1, 12)
    return F.when(inside, F.make_date(year.cast("int"), F.when(inside, month).cast("int"), F.lit(1)))


def safe_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """NULL for text that is no date in this format."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def iso_date(text: Column) -> Column:
    """ISO text to date by the fast built-in parser; other text gives NULL."""
    return text.try_cast("date")


def period_of(month_key: Column, cut: str = PERIOD_CUT, before: str = PERIOD_BEFORE, after: str = PERIOD_AFTER) -> Column:
    return F.when(month_key < cut, before).otherwise(after)


def _lookup(pairs) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def month_name(month: Column) -> Column:
    """1 -> "Enero"; anything else outside the table gives NULL."""
    return _lookup(list(enumerate(MONTH_NAMES, start=1)))[month.cast("int")]


def month_number(name: Column) -> Column:
    """Inverse of :func:`month_name`, ignoring case."""
    return _lookup([(name, i) for i, name in enumerate(MONTH_COLUMNS, start=1)])[F.lower(name)]


def date_attributes(date: Column, prefix: str = "") -> dict[str, Column]:
    """The attribute columns of a day-level date dimension."""
    return {
        f"{prefix}anio": F.year(date),
        f"{prefix}mes": F.month(date),
        f"{prefix}dia": F.dayofmonth(date),
        f"{prefix}trimestre": F.quarter(date),
        f"{prefix}dia_semana": F.weekday(date) + 1,
        f"{prefix}anio_mes": month_key_of(date),
    }


def seasonal(month: Column) -> tuple[Column, Column]:
    """Sine and cosine of the month on a twelve-month circle."""
    angle = month * (2.0 * F.pi() / F.lit(12.0))
    return F.sin(angle), F.cos(angle)
