"""Steps that all normalisers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.bind import once
from citeloom.functions.names import any_author_full_given, any_author_matches, surname_initial_key, tokens
from citeloom.functions.text import payload_text
from citeloom.operators.order import top_n_per_key

ORDER = ["page_no", "row_no", "item_no"]
KEPT = ["member_name", *ORDER]


def landed(raw: DataFrame, source: str, max_pages: int | None = None) -> DataFrame:
    """Payloads of one source, all that have landed; a caller may ask for the first ``max_pages`` pages only."""
    df = raw.filter(F.col("source") == source)
    if max_pages is not None:
        df = df.filter(F.col("page_no") < max_pages)
    return df.drop("source")


def items(df: DataFrame, array: Column, name: str = "item") -> DataFrame:
    """One row per array element with its place ``item_no``; NULL elements are dropped."""
    base = [c for c in ("member_name", "page_no", "row_no") if c in df.columns]
    return df.select(*base, F.posexplode(array).alias("item_no", name)).filter(F.col(name).isNotNull())


def text(c: Column | str) -> Column:
    return payload_text(F.col(c) if isinstance(c, str) else c)


def texts(arr: Column) -> Column:
    """Cleaned, non-blank texts of an array."""
    return F.filter(F.transform(F.coalesce(arr, F.expr("cast(array() as array<string>)")), payload_text),
                    lambda v: v.isNotNull())


def first_text(arr: Column) -> Column:
    return F.get(texts(arr), F.lit(0))


def in_window(df: DataFrame, min_year: int | None) -> DataFrame:
    """Rows of the lookback window; rows without a year stay."""
    if min_year is None:
        return df
    return df.filter(F.col("year").isNull() | (F.col("year") >= min_year))


def finish(
    df: DataFrame,
    source: str,
    score: float,
    min_year: int | None,
    matcher: str | None = "surname_initial",
    max_rows: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Title, year and author filters. ``df`` holds the record columns plus the order columns.

    All rows stay unless a caller asks for the first ``max_rows`` of every member, a group limit before its shuffle.
    Only what the filters read is held, so that columns that a caller leaves out, abstracts above all, are not worked out.
    """
    out = df
    if matcher is not None:
        named = tokens(F.col("member_name"))
        side = surname_initial_key(named) if matcher == "surname_initial" else named
        read = {c: F.col(c) for c in ("title", "year", "authors")}
        out = once(df, [c for c in df.columns if c not in read], member_key=side, **read)
    out = in_window(out.filter(F.coalesce(F.col("title"), F.lit("")) != ""), min_year)
    if matcher == "surname_initial":
        out = out.filter(any_author_matches(F.col("member_key"), F.col("authors")))
    elif matcher == "full_given":
        out = out.filter(any_author_full_given(F.col("member_key"), F.col("authors")))
    if max_rows is not None:
        out = top_n_per_key(out, ["member_name"], [F.col(c) for c in ORDER], max_rows)
    return out.select(
        *ORDER,
        F.lit(source).alias("source"),
        "source_id",
        "member_name",
        "title",
        F.col("year").cast("int").alias("year"),
        "published_date",
        "venue",
        "doi",
        "authors",
        "abstract",
        "landing_page_url",
        "pdf_url",
        F.lit(score).alias("relevance_score"),
        *keep,
    )
