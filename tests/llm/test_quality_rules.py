"""Quality rules against counts by hand, on whole and on awkward texts."""

import re
from collections import Counter

from conftest import SMALL
from llm_fixtures import TEXTS, docs, none

from citeloom.llm import quality_rules as rules

WORD = r"[^\x20\x09-\x0D]+"
MORE = ["a b c a b c", "a b c b c a b c", "x x x x", "one two three", "one two", "é\U0001f600 # $", "l\nl\n \nl \nl", "- a\n- b\n* c", "wait...\nso…", "A BB CCC dD", "the the the the the"]


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    n = len(words)
    base = (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    per_word = lambda test: sum(map(test, words)) / n if n else None
    per_line = lambda test: sum(map(test, lines)) / len(lines) if lines else None
    ratios = {
        "mean_word_length": base[1] / n if n else None, "symbols_per_word": base[2] / n if n else None,
        "words_with_letter": per_word(lambda w: any(c.isalpha() for c in w)),
        "words_in_capitals": per_word(lambda w: sum(c.isupper() for c in w) >= 2 and not any(c.islower() for c in w)),
        "stop_words": per_word(lambda w: w.lower() in rules.STOP_WORDS), "bullet_lines": per_line(lambda x: bool(re.match(r"[ \t]*[-*•][ \t]", x))),
        "ellipsis_lines": per_line(lambda x: x.rstrip(" \t\n\x0b\x0c\r").endswith(("...", "…"))),
        "repeated_lines": base[3] / len(lines) if lines else None, "mean_line_length": n / len(lines) if lines else None,
    }
    broken = [
        r.name for r in rules.RULES
        if ratios[r.ratio] is not None and ((r.least is not None and ratios[r.ratio] < r.least) or (r.most is not None and ratios[r.ratio] > r.most))
    ]
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (*base, failed, not failed and not broken, ",".join(broken))


def check(df):
    got = sorted(((r[0], *tuple(r)[1:]) for r in rules.judge(df).collect()), key=repr)
    assert got == sorted(((r["doc_id"], *brute(r["text"])) for r in df.select("doc_id", "text").collect()), key=repr)


def test_edges(spark):
    check(docs(spark, TEXTS + MORE))
    assert rules.judge(none(docs(spark))).count() == 0


def test_table(spark):
    check(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_equal_hash_bits_are_compared_word_by_word(spark, monkeypatch):
    monkeypatch.setattr(rules, "PLACE_BITS", 61)  # three bits of hash: nearly all windows meet
    check(docs(spark, [t for t in TEXTS + MORE if t is None or len(t) < 1000]))


def test_a_long_text_is_judged_whole(spark):
    text = " ".join(f"w{i}" for i in range(300_000)) + " w0 w1 w2"
    assert rules.judge(docs(spark, [text])).first()["n_repeat_words"] == 6


def test_a_table_of_its_own(spark):
    table = (rules.Rule("short", "mean_line_length", most=2.0),)
    got = {r["doc_id"]: r["broken"] for r in rules.judge(docs(spark, ["a b c", "a\nb", "", None]), rules=table).collect()}
    assert got == {0: "short", 1: "", 2: "", 3: ""}


def test_labelled_documents(spark):
    """Good documents of fifty words or more stay; shouted and symbol-ridden ones go."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id").where("NOT base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.005 * n[1, True] and n.get((0, True), 0) <= 0.05 * n[0, False]
