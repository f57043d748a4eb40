"""Scan of texts for a whole table of award numbers in one pass.

One automaton over all numbers runs through each text once, folded to its letters and digits; so the cost grows with the text
and not with the table. It finds every text that any rule can match; the rules of ``functions.scan`` then decide,
for those pairs of text and number alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.scan import DIGIT_GAP, NON_ALNUM_GAP, fold_case

#: Characters of numbers in one automaton, which every task holds; larger tables are scanned in groups of this size.
GROUP_CHARS = 16_000_000


def number_groups(numbers: DataFrame, column: str, group_chars: int = GROUP_CHARS) -> list[list[str]]:
    """The distinct numbers in groups of at most some ``group_chars`` characters; their number comes from a sum, not from a guess."""
    distinct = numbers.select(F.trim(F.col(column).cast("string")).alias("number")).where("number rlike '^[0-9A-Za-z]+$'").distinct()
    chars = distinct.agg(F.coalesce(F.sum(F.length("number")), F.lit(0))).first()[0]
    groups = max(1, -(-chars // group_chars))
    dealt = distinct.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))
    return [[r["number"] for r in dealt.where(F.col("group") == g).select("number").collect()] for g in range(groups)]


def _candidates(texts: DataFrame, id_col: str, text_col: str, numbers: list[str]) -> DataFrame:
    """(id, text, number) of every number whose letters and digits stand in a text one behind the other."""
    sent = texts.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for number in sent.value:
            folded = fold_case(number)
            automaton.add_word(folded, (*automaton.get(folded, ()), number))
        automaton.make_automaton()
        for batch in batches:
            rows, found = [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                folded = "".join(filter(str.isalnum, fold_case(text))) if text else ""
                own = {n for _, names in automaton.iter(folded) for n in names} if folded else ()
                rows += [at] * len(own)
                found += sorted(own)
            if rows:
                taken = batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(found, pa.string())], ["id", "text", "number"])

    narrow = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if not numbers:
        return narrow.withColumn("number", F.lit("")).where("false")
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, text string, number string")


def _spread(number: Column, gap: str) -> Column:
    """Pattern of the number's characters with ``gap`` between them; numbers hold letters and digits only."""
    return F.array_join(F.filter(F.split(number, ""), lambda c: c != ""), gap)


def number_mentions(texts: DataFrame, numbers: DataFrame, id_col: str, text_col: str, number_col: str, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(id_col, number, rule, mentions): how often each rule finds each number of the table in each text.

    Rules are those of a ``ScanSpec`` with that number: ``exact_number`` between word boundaries, ``separated_number`` with
    gaps between its characters, ``collapsed_number`` (once) where only letters and digits count. Numbers hold ASCII letters
    and digits; others are no numbers. Null texts have no mentions.
    """
    out = None
    for group in number_groups(numbers, number_col, group_chars):
        part = _candidates(texts, id_col, text_col, group)
        out = part if out is None else out.unionByName(part)
    count = lambda pattern: F.size(F.regexp_extract_all(F.col("text"), pattern, F.lit(0)))
    rules = F.array(
        F.struct(F.lit("exact_number").alias("rule"), count(F.concat(F.lit(r"(?iU)\b"), "number", F.lit(r"\b"))).alias("mentions")),
        F.struct(F.lit("separated_number").alias("rule"), count(F.concat(F.lit("(?iU)"), _spread(F.col("number"), DIGIT_GAP))).alias("mentions")),
        F.struct(
            F.lit("collapsed_number").alias("rule"),
            F.rlike("text", F.concat(F.lit("(?iu)"), _spread(F.col("number"), NON_ALNUM_GAP))).cast("int").alias("mentions"),
        ),
    )
    hits = out.select("id", "number", F.explode(rules).alias("r")).where("r.mentions > 0")
    return hits.select(F.col("id").alias(id_col), "number", "r.rule", F.col("r.mentions").cast("bigint").alias("mentions"))
