"""Whitespace, title and display-text normalisers."""

from __future__ import annotations

import html as _html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.functions.bind import bind, null_if

# Unicode white space plus the four ASCII separators, which Java's White_Space class leaves out.
SPACE_CLASS = r"[\s\x1c-\x1f]"
WS_RUN = rf"(?U){SPACE_CLASS}+"


#: Runs that differ from one space: a first white space, and more of them or no space there. Texts without any are not built anew.
WS_ODD = rf"(?U){SPACE_CLASS}(?:{SPACE_CLASS}+|(?<! ))"


def ws(c: Column) -> Column:
    """Collapse white-space runs to one space and trim; NULL stays NULL."""
    return F.trim(F.regexp_replace(c, WS_ODD, " "))


def ws_or_null(c: Column) -> Column:
    return null_if(ws(c), "")


def strip(c: Column) -> Column:
    """Trim white space of any kind at both ends, keep the inside."""
    return F.regexp_replace(c, rf"(?U)^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")


def strip_or_null(c: Column) -> Column:
    return null_if(strip(c), "")


def payload_text(c: Column) -> Column:
    """A text field of a landed payload: white space collapsed, blanks and a literal ``None`` to NULL."""
    return null_if(ws(c), "", "None")


def title_key(c: Column) -> Column:
    """Lower-case ASCII letters and digits of a title, used as its matching key."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def strip_tags(c: Column) -> Column:
    """Replace markup tags by spaces, then collapse; blank to NULL."""
    return ws_or_null(F.regexp_replace(ws(c), "<[^>]+>", " "))


def _decoded(value: str | None) -> str | None:
    """References decoded, numbers of any length too: leading zeros don't count, and what lies beyond Unicode is U+FFFD."""
    if value is not None and "&#" in value:
        value = re.sub("&#0*+([1-9][0-9]{7,}+);?", "\ufffd", re.sub("&#0+(?=[0-9])", "&#", value))
    return _html.unescape(value) if value is not None else None


def _unescape(values: pd.Series) -> pd.Series:
    return values.map(_decoded)


def unescape_entities(c: Column) -> Column:
    """Decode HTML entities. Only values with an ampersand travel to Python (Arrow batches).

    The user function is made here: one kept in the module would hold on to its session, and could not be sent to workers.
    """
    unescape = F.pandas_udf(_unescape, T.StringType())
    return F.coalesce(unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def tidy_markup(c: Column, strip_period: bool = True) -> Column:
    """Tags deleted and white space collapsed; optionally trailing full stops removed."""
    text = strip(F.regexp_replace(c, "<[^>]+>", ""))
    text = F.regexp_replace(text, WS_RUN, " ")
    if strip_period:
        text = F.trim(F.regexp_replace(text, r"\.+$", ""))
    return F.coalesce(text, F.lit(""))


def display_text(c: Column, strip_period: bool = True) -> Column:
    """Text for people: entities decoded, then ``tidy_markup``."""
    return tidy_markup(unescape_entities(c), strip_period)


def display_title_key(c: Column) -> Column:
    """Matching key of a title after ``display_text``."""
    return title_key(display_text(c))


def clip(c: Column, limit: int) -> Column:
    """Shorten to ``limit`` characters with a trailing ellipsis, if longer."""
    return bind(
        c, lambda t: F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit - 3), F.lit("..."))).otherwise(t)
    )


def chunk_words(c: Column, max_chars: int) -> Column:
    """Greedy packing of the words of a text into chunks of at most ``max_chars`` characters.

    A word longer than the limit is a chunk of its own. Returns an array of strings. After ``ws`` one space stands
    between words, so the longest chunk from a word on is one match, and the whole text is cut in one linear scan.
    """
    chunk = rf"(?s)(.{{1,{max_chars}}}(?= |\z)|[^ ]+)(?: |\z)"
    return F.regexp_extract_all(ws(c), F.lit(chunk), F.lit(1))
