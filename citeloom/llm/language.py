"""Language identification by Bayesian evidence fusion.

Four pieces of evidence meet as log probabilities: the text (byte trigrams, one smoothed distribution per language, and
a uniform one for what is no language), the language that markup or metadata declare, and a prior of the host. Host
priors are smoothed by those of the host's domain, its address suffix, and all rows, each level learnt by grouped
aggregation of what text and declaration say. How far a declaration is to be believed is learnt in the same way.

Texts are read once, into one narrow row each; all else works on these.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import map_columns
from citeloom.session import materialise

BUCKETS = 1 << 15
#: Rows of the labelled sample that the trigram distributions are fitted on, shared alike by the languages; each has so many at least.
SAMPLE_ROWS = 20_000
LEAST_ROWS = 500
#: Name of the uniform class.
UNKNOWN = "und"
#: Cells of one product of trigrams and classes.
CELLS = 4_000_000
#: Trigrams in a row depend on one another: a text counts as so many independent ones at most.
MOST_TRIGRAMS = 64
#: Share of a text that may be names, quotes or other languages: all buckets alike. It bounds what one odd trigram costs, for
#: each language by the same amount, so that the language of most of a text wins.
FOREIGN = 0.2
#: Pseudo-rows that each level of the host hierarchy takes from the level above.
STRENGTH = 20.0
LEAST_POSTERIOR = 0.5

#: Digits and ASCII punctuation count as blanks.
_CLEAN = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class TrigramModel:
    """Log probability of each trigram bucket, one column per language; the last one is the uniform class."""

    languages: list[str]
    weights: np.ndarray


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each trigram that holds a letter, and the text it is from."""
    parts = [(t or "").lower().encode().translate(_CLEAN) for t in texts]
    whole = np.frombuffer(b"  ".join(parts) + b"  ", np.uint8).astype(np.uint32)
    if len(whole) < 3:
        return np.array([], np.int64), np.array([], np.int64)
    code = (whole[:-2] << 16) | (whole[1:-1] << 8) | whole[2:]
    row = np.repeat(np.arange(len(parts)), [len(p) + 2 for p in parts])[: len(code)]
    letters = (whole[:-2] != 32).astype(np.uint8) + (whole[1:-1] != 32) + (whole[2:] != 32) >= 2
    return ((code[letters] * np.uint32(2_654_435_761)) >> np.uint32(17)).astype(np.int64), row[letters]


def _label(lang: Column | str) -> Column:
    """Primary language of a declaration: its leading letters in lower case."""
    return F.lower(F.regexp_extract(F.coalesce(F.trim(lang), F.lit("")), "^[A-Za-z]+", 0))


def _lookup(values: dict, kind: str, key: Column | str) -> Column:
    """Value of ``key`` in ``values`` or NULL; the map is one folded literal, whatever its size."""
    return F.try_element_at(F.from_json(F.lit(json.dumps(values)), f"map<string,{kind}>"), F.col(key) if isinstance(key, str) else key)


def labelled_sample(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], DataFrame]:
    """All languages of column ``lang``, and (lang, text) of some equally many rows of each: all rows of rare ones.

    Languages are counted over all rows. Rows are drawn by a hash of their id, so copies do not fall together.
    """
    labelled = docs.where("text is not null").select("doc_id", _label("lang").alias("lang"), "text").where(~F.col("lang").isin("", UNKNOWN))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    rows = max(LEAST_ROWS, sample_rows // max(1, len(counts)))
    shares = {x: min(1 << 30, (rows << 30) // n) for x, n in counts.items()}
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < _lookup(shares, "bigint", "lang")
    return sorted(counts), labelled.where(drawn).select("lang", "text")


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> TrigramModel:
    """Trigram distributions of all languages in column ``lang``, from a sample of each (see ``labelled_sample``)."""
    languages, sample = labelled_sample(docs, sample_rows)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for lang in set(langs):
                at, _ = _trigrams([t for t, x in zip(texts, langs, strict=True) if x == lang])
                sums[lang] = sums.get(lang, 0) + np.bincount(at, minlength=BUCKETS)
        seen = {lang: np.flatnonzero(s) for lang, s in sums.items()}
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(seen), pa.string()), pa.array([at.astype("<u2").tobytes() for at in seen.values()], pa.binary()),
                pa.array([sums[lang][at].astype("<i8").tobytes() for lang, at in seen.items()], pa.binary()),
            ],
            ["lang", "buckets", "sums"],
        )

    column = {lang: i for i, lang in enumerate(languages)}
    sums = np.zeros((len(languages), BUCKETS), np.int64)
    for r in sample.repartition(8).mapInArrow(count, "lang string, buckets binary, sums binary").collect():  # 8 tasks, seen buckets of each language
        sums[column[r["lang"]], np.frombuffer(r["buckets"], "<u2")] += np.frombuffer(r["sums"], "<i8")
    weights = np.full((BUCKETS, len(languages) + 1), -np.log(BUCKETS), np.float32)
    for i in range(len(languages)):
        weights[:, i] = np.log((1 - FOREIGN) * sums[i] / max(1, sums[i].sum()) + FOREIGN / BUCKETS)
    return TrigramModel(languages, weights)


def text_evidence(rows: DataFrame, model: TrigramModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``rows`` with ``trigrams`` (their number in the whole text) and ``ll`` (log likelihoods per class)."""
    sent = rows.sparkSession.sparkContext.broadcast(model.weights)
    classes = model.weights.shape[1]
    base = rows.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != "text") + ", trigrams long, ll array<double>"

    def run(batch: pa.RecordBatch) -> dict:
        weights, texts = sent.value, batch.column(len(keep)).to_pylist()
        sums, n = np.zeros((len(texts), classes)), np.zeros(len(texts), np.int64)
        for at in range(0, len(texts), 50):
            bucket, row = _trigrams(texts[at : at + 50])
            step = max(1, CELLS // classes)
            for x in range(0, len(bucket), step):
                part, of = bucket[x : x + step], row[x : x + step]
                first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                sums[at + of[first]] += np.add.reduceat(weights[part], first, axis=0)
                n[at + of[first]] += np.diff(np.r_[first, len(part)])
        scale = np.minimum(n, MOST_TRIGRAMS) / np.maximum(n, 1)
        out = {name: batch.column(i) for i, name in enumerate(keep)}
        return out | {"trigrams": n, "ll": pa.array(list(sums * scale[:, None]), pa.list_(pa.float64()))}

    return map_columns(base, run, schema)


def _normal(ll: Column) -> Column:
    """Probabilities from log values."""
    top = F.array_max(ll)
    weights = F.transform(ll, lambda x: F.exp(x - top))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def _summed(df: DataFrame, keys: list[str], classes: int) -> DataFrame:
    """Expected number of rows per class and key (``n_0`` ...), combined before the shuffle."""
    return df.groupBy(*keys).agg(*[F.sum(F.get("p", F.lit(i))).alias(f"n_{i}") for i in range(classes)])


def _prior(counts: list[Column], above: Column) -> Column:
    """Class probabilities of a level: its expected counts plus STRENGTH rows dealt as the level above says."""
    total = sum(counts[1:], counts[0])
    return F.array(*[(c + F.lit(STRENGTH) * F.get(above, F.lit(i))) / (total + F.lit(STRENGTH)) for i, c in enumerate(counts)])


def identify(rows: DataFrame, model: TrigramModel, id_col: str) -> DataFrame:
    """(id_col, lang, posterior, keep, declared, trigrams) of each row of ``rows`` (id_col, text, declared, host).

    ``keep`` is false where no class but the uniform one explains the text, where none reaches LEAST_POSTERIOR, and where
    the text has no letters (null, empty, digits only): ``lang`` is then ``und`` unless one language still leads. A null or
    unknown declaration is no evidence, a null host has the prior of all rows. Ties go to the first language in alphabetical
    order. Repeated rows are judged alike; an empty table gives an empty table.
    """
    names = [*model.languages, UNKNOWN]
    n = len(names)
    known = _label("declared")
    labels = rows.select(
        F.col(id_col), "text", F.when(known.isin(*model.languages), known).alias("declared"), F.lower("host").alias("host")
    )
    seen = materialise(text_evidence(labels, model, [id_col, "declared", "host"]), "text-evidence")
    voted = seen.where("trigrams > 0").withColumn("p", _normal(F.col("ll")))
    # How often each language is declared where the text is in another: P(declared | language), smoothed.
    told = {r["declared"]: [r[f"n_{i}"] or 0.0 for i in range(n)] for r in _summed(voted.where("declared is not null"), ["declared"], n).collect()}
    of_class = [sum(v[i] for v in told.values()) for i in range(n)]
    belief = {
        d: [float(np.log((told.get(d, [0.0] * n)[i] + (0.8 if x == d else 0.2 / n)) / (of_class[i] + 1.0))) for i, x in enumerate(names)]
        for d in model.languages
    }
    declared = F.coalesce(_lookup(belief, "array<double>", "declared"), F.array(*[F.lit(0.0)] * n))
    fused = seen.withColumn("ll", F.transform(F.arrays_zip("ll", declared.alias("d")), lambda x: x["ll"] + x["d"]))
    labels = F.split("host", "\\.")
    placed = fused.withColumn("suffix", F.element_at(labels, -1)).withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), F.lit(2)), "."))
    placed = placed.withColumn("p", _normal(F.col("ll")))
    counted = placed.where("trigrams > 0")
    top = counted.agg(*[F.coalesce(F.sum(F.get("p", F.lit(i))), F.lit(0.0)) for i in range(n)]).first()
    everything = [(float(x) + 1.0) / (sum(map(float, top)) + n) for x in top]
    by_host = materialise(_summed(counted.where("host is not null"), ["host", "domain", "suffix"], n), "host-counts")
    level = lambda key: by_host.groupBy(key).agg(*[F.sum(f"n_{i}").alias(f"{key}_{i}") for i in range(n)])
    tree = by_host.join(level("domain"), "domain").join(level("suffix"), "suffix")
    of_suffix = _prior([F.col(f"suffix_{i}") for i in range(n)], F.array(*map(F.lit, everything)))
    tree = tree.withColumn("prior", of_suffix)
    tree = tree.withColumn("prior", _prior([F.col(f"domain_{i}") for i in range(n)], F.col("prior")))
    tree = tree.select("host", _prior([F.col(f"n_{i}") for i in range(n)], F.col("prior")).alias("prior"))
    joined = placed.join(tree, "host", "left")
    prior = F.coalesce("prior", F.array(*map(F.lit, everything)))
    posterior = joined.withColumn("p", _normal(F.transform(F.arrays_zip("ll", prior.alias("q")), lambda x: x["ll"] + F.log(x["q"]))))
    best = F.array_max("p")
    scored = posterior.select(
        id_col, F.element_at(F.array(*map(F.lit, names)), F.array_position("p", best).cast("int")).alias("best"), best.alias("posterior"), "declared", "trigrams"
    )
    lang = F.when(F.col("trigrams") == 0, F.lit(UNKNOWN)).otherwise(F.col("best"))
    return scored.select(
        id_col, lang.alias("lang"), "posterior", ((lang != UNKNOWN) & (F.col("posterior") >= LEAST_POSTERIOR)).alias("keep"), "declared", "trigrams"
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, host) of raw pages: text outside tags, the root element's ``lang``, the address's host."""
    bare = F.regexp_replace(F.regexp_replace("html", r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " "), "<[^>]*>", " ")
    declared = F.regexp_extract("html", r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return pages.select("page_id", bare.alias("text"), F.nullif(declared, F.lit("")).alias("declared"), F.nullif(host, F.lit("")).alias("host"))


def document_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, declared, host) of documents, whose metadata declare a language and name a source."""
    return docs.select("doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host"))


def known_languages(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that no language explains."""
    judged = identify(document_rows(docs), fit(docs), "doc_id").where("not keep").select("doc_id")
    return docs.join(materialise(judged.distinct(), "rejected-languages"), "doc_id", "left_anti").select(docs.columns)
