"""Rare and many languages, and a sample that copies do not fill."""

import random

from citeloom.llm import language

LETTERS = {"en": "abcdefghijklm", "fr": "nopqrstuvwxyz", "el": "αβγδεζηθικλμν"}


def text(lang, seed):
    rng = random.Random(f"{lang}{seed}")
    letters = LETTERS.get(lang) or random.Random(lang).sample("abcdefghijklmnopqrstuvwxyz", 5)
    return " ".join("".join(rng.choices(letters, k=6)) for _ in range(60))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, "src") for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string, source string")


def test_a_rare_language_in_its_own_script_is_kept(spark):
    df = frame(spark, [(text("en", i), "en") for i in range(1500)] + [(text("fr", 0), "fr")] * 1500 + [(text("el", i), "el") for i in range(5)])
    got = language.identify(language.document_rows(df), language.fit(df), "doc_id").where("doc_id >= 3000").collect()
    assert [(r["lang"], r["keep"], r["declared"]) for r in got] == [("el", True, "el")] * 5
    assert language.known_languages(df).count() == df.count()


def test_the_sample_is_bounded_for_each_language(spark):
    df = frame(spark, [(text("fr", 0), "fr")] * 4000 + [(text("en", i), "en-GB") for i in range(1000)] + [(text("el", i), "el") for i in range(5)])
    languages, sample = language.labelled_sample(df, 300)
    rows = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert languages == ["el", "en", "fr"] and rows["el"] == 5
    assert all(0.7 * language.LEAST_ROWS <= rows[x] <= 1.3 * language.LEAST_ROWS for x in ("en", "fr"))


def test_more_than_64_languages(spark):
    names = [f"{a}{b}" for a in "abcdefg" for b in "klmnopqrst"]
    df = frame(spark, [(text(x, i), x) for x in names for i in range(12)])
    model = language.fit(df)
    assert model.languages == names
    got = language.identify(language.document_rows(df), model, "doc_id").join(df.select("doc_id", df.lang.alias("want")), "doc_id")
    assert got.where("lang <> want or not keep").count() == 0
