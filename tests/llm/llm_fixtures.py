"""Small tables with the awkward cases that every operator must take."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} of line{i}" + ("\n" if i % 11 == 0 else "") for i in range(6000))
TEXTS = [
    None, "", " ", "\n\n", "one", "two words", "A shared line\nown text number one", "a SHARED line \nown text number two, longer than the first",
    LONG, LONG, "été à la plage, où l'été dure\n\U0001f600 emoji", "tab\tand\x0bvertical\x0cfeed\rreturn", "123 456 7890", "<<>>!!??", "same text here", "same text here",
]


def docs(spark, texts=None):
    """Documents with null cells, repeated rows, and extra columns whose names clash with those of results."""
    rows = [
        (i, t, ["en", None, "fr", "xx"][i % 4], ["src0", None, "src1"][i % 3], len(t) if t else 0, i, "x", 1.5) for i, t in enumerate(texts or TEXTS)
    ]
    rows.append(rows[-1])
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, fingerprint long, spans string, size double"
    )


def none(df):
    """The same table without rows."""
    return df.where(F.lit(False))


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
