"""Quality rules: a table of thresholds compiled into one projection of length, symbol, stop-word and line ratios.

Each rule names a ratio and the stretch in which it must lie; ``compiled`` turns the whole table into columns, so a document is
judged in the one scan that reads it, without user functions, joins or shuffles.

Repeated three-word windows are found without comparing texts: each window is one number of hash bits and position, the
numbers are sorted, and only windows whose hash bits meet are compared word by word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.bind import bind
from citeloom.llm.common import WORD

#: Fixed values of the base rules.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50
WINDOW = 3

#: Common words of the languages looked for (fixed list): English, German, French, Spanish.
STOP_WORDS = (
    "the of and to a in is that for it was on with be as by this are at from or an have not but which were "
    "der die und in den von zu das sich mit auf des für ist nicht im dem ein eine als auch es an werden aus er hat dass sie nach "
    "de la le et les des en un une du que pour est qui dans par pas au sur avec ce il sont plus ne se "
    "el y los del las por con no su para al lo como más o pero sus "
).split()

#: Bits that hold a window's place; a text has fewer than 2^31 bytes, so fewer than 2^30 words.
PLACE_BITS = 30


@dataclass(frozen=True)
class Rule:
    """A document passes if ``ratio`` lies within ``least`` and ``most`` (None: no bound)."""

    name: str
    ratio: str
    least: float | None = None
    most: float | None = None


#: The table. Ratios are described in ``ratios``.
RULES = (
    Rule("word_length", "mean_word_length", 3.0, 10.0),
    Rule("symbols", "symbols_per_word", most=0.1),
    Rule("letters", "words_with_letter", least=0.8),
    Rule("capitals", "words_in_capitals", most=0.3),
    Rule("stop_words", "stop_words", least=0.02),
    Rule("bullets", "bullet_lines", most=0.9),
    Rule("ellipses", "ellipsis_lines", most=0.3),
    Rule("repeated_lines", "repeated_lines", most=0.5),
    Rule("line_length", "mean_line_length", least=2.0),
)


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more in ``words``, the first one included."""
    n = F.size(words)
    last = F.lit(WINDOW - 1)
    shift = F.lit(PLACE_BITS)

    def packed(i: Column) -> Column:
        bits = F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
        return F.call_function("shiftleft", F.call_function("shiftright", bits, shift), shift).bitwiseOR(i.cast("long"))

    def met(sorted_: Column) -> Column:
        same = lambda p, q: F.call_function("shiftright", p, shift) == F.call_function("shiftright", q, shift)
        return F.filter(sorted_, lambda p, i: F.coalesce(same(p, F.get(sorted_, i + 1)), F.lit(False)) | F.coalesce(same(p, F.get(sorted_, i - 1)), F.lit(False)))

    def spelled(p: Column) -> Column:
        return bind(
            p.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"),
            lambda i: F.struct(*[F.get(words, i + k).alias(f"w{k}") for k in range(WINDOW)], i.alias("at")),
        )

    def places(exact: Column) -> Column:
        return F.filter(exact, lambda e, i: _same_words(e, F.get(exact, i + 1)) | _same_words(e, F.get(exact, i - 1)))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)

    keys = F.sort_array(F.transform(F.sequence(F.lit(0), n - 1 - last), packed))
    found = bind(keys, lambda k: F.array_sort(F.transform(met(k), spelled)))
    at = bind(found, lambda e: F.array_sort(F.transform(places(e), lambda s: s["at"])))
    return F.when(n > last, bind(at, covered)).otherwise(F.lit(0))


def _same_words(a: Column, b: Column) -> Column:
    out = F.lit(True)
    for k in range(WINDOW):
        out = out & (a[f"w{k}"] == b[f"w{k}"])
    return F.coalesce(out, F.lit(False))


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Counts of each whole text; columns ``keep`` stay."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))
    split = docs.select(*keep, F.explode(F.array(F.struct(text.alias("text"), words.alias("words"), lines.alias("lines")))).alias("_t"))
    words, lines = F.col("_t.words"), F.col("_t.lines")
    size = lambda array, test: F.size(F.filter(array, test))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.char_length(F.regexp_replace(F.col("_t.text"), "[\\x20\\x09-\\x0D]+", "")),
        "n_symbols": F.regexp_count(F.col("_t.text"), F.lit(SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
        "n_lines": F.size(lines),
        "n_letter_words": size(words, lambda w: F.rlike(w, F.lit("\\p{L}"))),
        "n_capital_words": size(words, lambda w: F.rlike(w, F.lit("\\p{Lu}[^\\p{Lu}]*\\p{Lu}")) & ~F.rlike(w, F.lit("\\p{Ll}"))),
        "n_stop_words": size(words, lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS)))),
        "n_bullet_lines": size(lines, lambda x: F.rlike(x, F.lit("^[\\x20\\x09]*[-*•][\\x20\\x09]"))),
        "n_ellipsis_lines": size(lines, lambda x: F.rlike(x, F.lit("(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$"))),
    }
    return split.select(*keep, *[c.cast("long").alias(k) for k, c in counts.items()])


def ratios() -> dict[str, Column]:
    """The ratios that rules may name, over the columns of ``measures``; a ratio of nothing is NULL and breaks no rule."""
    of = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return {
        "mean_word_length": of("word_chars", "n_words"),
        "symbols_per_word": of("n_symbols", "n_words"),
        "words_with_letter": of("n_letter_words", "n_words"),
        "words_in_capitals": of("n_capital_words", "n_words"),
        "stop_words": of("n_stop_words", "n_words"),
        "bullet_lines": of("n_bullet_lines", "n_lines"),
        "ellipsis_lines": of("n_ellipsis_lines", "n_lines"),
        "repeated_lines": of("n_dup_lines", "n_lines"),
        "mean_line_length": of("n_words", "n_lines"),
    }


def compiled(rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """One boolean column per rule of the table: true where a document breaks it."""
    known: dict[str, Column] = ratios()
    out = {}
    for rule in rules:
        below = known[rule.ratio] < F.lit(rule.least) if rule.least is not None else F.lit(False)
        above = known[rule.ratio] > F.lit(rule.most) if rule.most is not None else F.lit(False)
        out[rule.name] = F.coalesce(below | above, F.lit(False))
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, broken) of each row of ``docs``.

    ``base_failed``: fewer than LEAST_WORDS words, or more than MOST_REPEATED percent of them in repeated windows. ``broken``
    lists the broken rules of the table in its order, comma-joined; a document is kept if it breaks none and the base rules
    hold. A null text has no words, as an empty one. Repeated rows are judged alike; other columns, whatever their names,
    are not looked at; an empty table gives an empty table. Texts of any length are judged whole, in n log n steps.
    """
    broken = F.array_join(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in compiled(rules).items()]), lambda x: x.isNotNull()), ",")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    found = measures(docs.select(F.col(id_col).alias("_id"), "text"), ["_id"])
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = found.select(F.col("_id").alias(id_col), *base, failed.alias("base_failed"), broken.alias("broken"))
    return judged.select(id_col, *base, "base_failed", (~F.col("base_failed") & (F.col("broken") == "")).alias("kept"), "broken")
