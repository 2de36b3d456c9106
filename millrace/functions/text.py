"""Text expressions: blank handling, digit tests, brace lists, dates, templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def digits_only(c: Column) -> Column:
    """The trimmed text as bigint where it is all ASCII digits, else NULL."""
    t = F.trim(c)
    return F.when(t.rlike("^[0-9]+$"), t).cast("bigint")


def brace_list(c: Column) -> Column:
    """'{1,2}' to ['1','2']; items are not trimmed; NULL and blank give one empty item, which matches nothing."""
    return F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"^[{}]+|[{}]+$", ""), ",")


def leading_date(c: Column) -> Column:
    """The date in the first ten characters; blank is NULL, malformed text raises under ANSI."""
    return F.to_date(F.substring(blank_to_null(c), 1, 10))


def time_text(at: Column, rest: str = "MM-dd HH:mm:ss") -> Column:
    """A timestamp as text: the year, a hyphen and the rest by its pattern.

    Years are those of SQL's strftime: four digits at least from 0 to 9999, plain numbers
    beyond, year 0 before year 1. date_format would put a plus before five digits and count
    the years before 1 backwards.
    """
    year = F.year(at)
    return F.concat(F.when(year.between(0, 999), F.lpad(year.cast("string"), 4, "0")).otherwise(year.cast("string")), F.lit("-"), F.date_format(at, rest))


def fill_template(template: str, name: str, value: Column) -> Column:
    """The template with {name} replaced; NULL where the value is NULL or blank."""
    head, tail = template.split("{" + name + "}")
    return F.when(value != "", F.concat(F.lit(head), value, F.lit(tail)))


def char_length(c: Column) -> Column:
    return F.length(c)


def has_any_glyph(c: Column, glyphs: str) -> Column:
    """True where the text holds one of the glyphs; false for NULL."""
    return F.coalesce(c.rlike("[" + glyphs + "]"), F.lit(False))
