"""Column functions for dirty keys, numbers, dates and times. All stay in the JVM; none raises under ANSI mode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Texts that stand for a missing value.
MISSING_TEXTS = ("", "-", "-999", "-999.0", "null", "none", "nan", ".")


def clean_text(c: Column) -> Column:
    """Trimmed text; null for texts that mean missing."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin(*MISSING_TEXTS), t)


def clean_path(c: Column, sep: str = "^") -> Column:
    """A hierarchical key; null if missing or if its last level is missing."""
    t = clean_text(c)
    return F.when(~t.endswith(f"{sep}-999"), t)


def parse_number(c: Column) -> Column:
    """Text in several notations (blanks, thousands commas, exponents) as double; null if it is none."""
    return F.replace(clean_text(c), F.lit(","), F.lit("")).try_cast("double")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _form(c: Column) -> Column:
    """A text with every digit as 0, by which common notations are told without a pattern."""
    return F.translate(c, "123456789", "000000000")


def parse_day(c: Column) -> Column:
    """``yyyy-MM-dd``, ``yyyy/MM/dd``, ``yyyyMMdd`` (each with a time of day behind or not) and ``dd-MMM-yyyy`` as date."""
    named = lambda t: F.try_to_date(F.when(t.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"), F.initcap(t)), "d-MMM-yyyy")
    rare = lambda t: _let(F.regexp_replace(t, r"^(\d{4})[-/]?(\d{2})[-/]?(\d{2})(?:[T ].*)?$", "#$1-$2-$3"), lambda x: F.when(x.startswith("#"), F.substring(x, 2, 10).try_cast("date")).otherwise(named(t)))
    form = lambda t: _form(F.substring(t, 1, 11))
    return _let(
        F.trim(c),
        lambda t: F.when(form(t).isin("0000-00-00", "0000-00-00T", "0000-00-00 "), F.substring(t, 1, 10).try_cast("date"))
        .when(form(t).isin("0000/00/00", "0000/00/00T", "0000/00/00 "), F.translate(F.substring(t, 1, 10), "/", "-").try_cast("date"))
        .when(form(t) == "00000000", F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)).try_cast("date"))
        .otherwise(rare(t)),
    )


def parse_second_of_day(c: Column) -> Column:
    """``HH:mm:ss``, with a fraction (cut off), ``HHmmss`` and ``h:mm:ss AM`` as second of the day; null if it is none."""
    number = lambda t, at: F.substring(t, at, 2).try_cast("int")
    whole = lambda h, m, s: F.when((h < 24) & (m < 60) & (s < 60), h * 3600 + m * 60 + s)

    def rare(t: Column) -> Column:
        found = F.regexp_replace(F.upper(t), r"^(\d{1,2}):?(\d{2}):?(\d{2})(?:\.\d+)?\s*([AP]M)?$", "#:$1:$2:$3:$4")

        def second(x: Column) -> Column:
            h, m, s, half = x[1].try_cast("int"), x[2].try_cast("int"), x[3].try_cast("int"), x[4]
            hour = F.when(half == "", h).when(h.between(1, 12), F.pmod(h, F.lit(12)) + F.when(half == "PM", 12).otherwise(0))
            return F.when(x[0] == "#", whole(hour, m, s))

        return _let(F.split(F.when(found.startswith("#"), found), ":"), second)

    return _let(F.trim(c), lambda t: F.when(_form(t) == "00:00:00", whole(number(t, 1), number(t, 4), number(t, 7))).when(_form(t) == "000000", whole(number(t, 1), number(t, 3), number(t, 5))).otherwise(rare(t)))


def epoch_millis(c: Column) -> Column:
    """An epoch in seconds, milliseconds or microseconds as milliseconds."""
    c = c.cast("bigint")
    return F.when(F.abs(c) >= 10**14, F.floor(c / 1000)).when(F.abs(c) >= 10**11, c).otherwise(c * 1000).cast("bigint")


def iso_millis(c: Column) -> Column:
    """ISO 8601 text with offset as epoch milliseconds; null if it is none."""
    t = F.trim(c)
    return F.unix_millis(F.try_to_timestamp(F.when(t.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:?\d\d)$"), t)))


def epoch_day(c: Column) -> Column:
    """A date as days since 1970-01-01."""
    return F.unix_date(c)
