"""Ordered, distinct string lists. Array order is significant everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.bind import bind
from citeloom.functions.text import strip, ws

EMPTY = "cast(array() as array<string>)"


def empty_strings() -> Column:
    return F.expr(EMPTY)


def or_empty(c: Column) -> Column:
    return F.coalesce(c, empty_strings())


def non_null(arr: Column) -> Column:
    return F.filter(arr, lambda v: v.isNotNull())


def distinct_ws(arr: Column) -> Column:
    """Collapsed white space, blanks dropped, first occurrence kept, case matters."""
    return F.array_distinct(F.filter(F.transform(or_empty(arr), ws), lambda v: v.isNotNull() & (v != "")))


def distinct_trimmed(arr: Column) -> Column:
    """Trimmed only, blanks dropped, first occurrence kept, case matters."""
    return F.array_distinct(F.filter(F.transform(or_empty(arr), strip), lambda v: v.isNotNull() & (v != "")))


def _first_of_runs(ordered: Column, key: str) -> Column:
    """Of a sorted array of structs, the first element of every run of equal ``key``. The array is made once."""
    def firsts(sorted_: Column) -> Column:
        paired = F.zip_with(
            sorted_,
            F.concat(F.array(F.lit(None)), sorted_),
            lambda cur, prev: F.struct(
                cur.alias("cur"),
                (cur.isNotNull() & (prev.isNull() | (cur[key] != prev[key]))).alias("keep"),
            ),
        )
        return F.transform(F.filter(paired, lambda p: p["keep"]), lambda p: p["cur"])

    return bind(ordered, firsts)


def distinct_ignore_case(arr: Column) -> Column:
    """Collapsed white space, blanks dropped, first spelling of each lower-cased value kept."""
    cleaned = F.filter(F.transform(or_empty(arr), ws), lambda v: v.isNotNull() & (v != ""))
    keyed = F.array_sort(
        F.transform(cleaned, lambda v, i: F.struct(F.lower(v).alias("k"), i.alias("i"), v.alias("v")))
    )
    firsts = F.transform(
        _first_of_runs(keyed, "k"), lambda e: F.struct(e["i"].alias("i"), e["v"].alias("v"))
    )
    return F.transform(F.array_sort(firsts), lambda e: e["v"])


def first_of(arr: Column) -> Column:
    """First element or NULL."""
    return F.get(arr, F.lit(0))


def inverted_index(words: Column) -> Column:
    """``word -> positions`` (from 0) of a word list, inside its row: sorted once, and cut where the word changes."""

    def cut(pairs: Column) -> Column:
        word = lambda i: F.get(pairs, i)["word"]
        places = F.when(F.size(pairs) > 0, F.sequence(F.lit(0), F.size(pairs) - 1)).otherwise(F.expr("cast(array() as array<int>)"))
        starts = F.filter(places, lambda i: (i == 0) | (word(i) != word(i - 1)))

        def entries(starts: Column) -> Column:
            return F.transform(starts, lambda s, j: F.struct(
                word(s).alias("word"),
                F.transform(F.slice(pairs, s + 1, F.coalesce(F.get(starts, j + 1), F.size(pairs)) - s), lambda p: p["pos"]).alias("at"),
            ))

        return F.map_from_entries(bind(starts, entries))

    return bind(F.array_sort(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("pos")))), cut)


def decode_inverted_index(m: Column) -> Column:
    """Rebuild a text from ``word -> positions``; the first word of a position wins, negatives are skipped."""
    pairs = F.flatten(
        F.transform(
            F.map_entries(m),
            lambda e: F.transform(
                F.filter(e["value"], lambda p: p >= 0),
                lambda p: F.struct(p.alias("pos"), e["key"].alias("word")),
            ),
        )
    )
    # Ties on a position keep map order, so the rank inside the flattened list is the second sort key.
    ranked = F.transform(
        pairs, lambda p, i: F.struct(p["pos"].alias("pos"), i.alias("seq"), p["word"].alias("word"))
    )
    kept = _first_of_runs(F.array_sort(ranked), "pos")
    return F.coalesce(F.trim(F.array_join(F.transform(kept, lambda p: p["word"]), " ")), F.lit(""))
