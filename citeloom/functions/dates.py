"""Years and dates. Dates stay ISO text, because sources publish partial dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.bind import bind, null_if
from citeloom.functions.text import ws

# Month names by number.
MONTHS = {
    "jan": 1,
    "feb": 2,
    "mar": 3,
    "apr": 4,
    "may": 5,
    "jun": 6,
    "jul": 7,
    "aug": 8,
    "sep": 9,
    "oct": 10,
    "nov": 11,
    "dec": 12,
}


def safe_int(c: Column) -> Column:
    """Integer or NULL, never an error."""
    return c.try_cast("int")


def year_in_text(c: Column) -> Column:
    """First 19xx or 20xx in a text."""
    return F.regexp_extract(c, r"(19|20)\d{2}", 0).try_cast("int")


def year_to_date(year: Column) -> Column:
    """First of January of a year; NULL stays NULL."""
    return F.concat(year.cast("string"), F.lit("-01-01"))


def pad2(c: Column) -> Column:
    """At least two digits."""
    return bind(c.cast("string"), lambda t: F.when(F.length(t) < 2, F.lpad(t, 2, "0")).otherwise(t))


def pad4(c: Column) -> Column:
    return bind(c.cast("string"), lambda t: F.when(F.length(t) < 4, F.lpad(t, 4, "0")).otherwise(t))


def year_of_parts(parts: Column) -> Column:
    """Year of a ``date-parts`` value; zero counts as missing."""
    return null_if(F.get(F.get(parts, F.lit(0)), F.lit(0)), 0).cast("int")


def date_of_parts(parts: Column) -> Column:
    """ISO date of a ``date-parts`` value, missing month or day filled with 01."""
    return bind(
        F.get(parts, F.lit(0)),
        lambda head: F.when(
            F.size(head) > 0,
            F.concat_ws(
                "-",
                F.get(head, F.lit(0)).cast("string"),
                F.coalesce(pad2(F.get(head, F.lit(1))), F.lit("01")),
                F.coalesce(pad2(F.get(head, F.lit(2))), F.lit("01")),
            ),
        ),
    )


def month_number(c: Column) -> Column:
    """Month by number (kept within 1-12) or English name; 1 if unknown."""
    by_name = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])

    def pick(text: Column) -> Column:
        number = safe_int(text)
        kept = F.when(number.isNotNull(), F.least(F.greatest(number, F.lit(1)), F.lit(12)))
        return F.coalesce(kept, F.try_element_at(by_name, F.lower(F.substring(text, 1, 3))))

    return F.coalesce(bind(ws(c), pick), F.lit(1))


def display_parts(parts: Column) -> Column:
    """All given numbers of a ``date-parts`` value joined by hyphens."""
    joined = F.array_join(F.get(parts, F.lit(0)).cast("array<string>"), "-")
    return null_if(joined, "")
