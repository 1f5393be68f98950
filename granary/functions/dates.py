"""Dates written in several styles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The styles of the call records, the day before the month.
STYLES = (
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),
    (r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$", "dd/MM/yyyy HH:mm"),
    (r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}$", "dd-MM-yyyy HH:mm"),
    (r"^\d{2}-\d{2}-\d{4}$", "dd-MM-yyyy"),
)


def parse_date(text: Column) -> Column:
    """The timestamp that a text states in one of the styles, null if it states none or an impossible one."""
    bare = F.trim(text)
    return F.coalesce(*[F.when(bare.rlike(pattern), F.try_to_timestamp(bare, F.lit(style))) for pattern, style in STYLES])


def from_parts(year: Column, month: Column, day: Column) -> Column:
    """The timestamp of a date given as three texts, null if there is no such date."""
    number = lambda c: F.when(F.trim(c).rlike(r"^\d{1,4}$"), F.trim(c).cast("int"))
    written = F.format_string("%04d-%02d-%02d", number(year), number(month), number(day))
    known = number(year).isNotNull() & number(month).isNotNull() & number(day).isNotNull()
    return F.when(known, F.try_to_timestamp(written, F.lit("yyyy-MM-dd")))


def call_date(created: Column, year: Column, month: Column, day: Column) -> Column:
    """`created`, else the three parts, as yyyy-MM-dd HH:mm:ss, else ''."""
    return F.coalesce(F.date_format(F.coalesce(parse_date(created), from_parts(year, month, day)), "yyyy-MM-dd HH:mm:ss"), F.lit(""))
