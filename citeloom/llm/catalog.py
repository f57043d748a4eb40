"""Queries of the training-data operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import (
    decontaminate, html_content, language, line_dedup, merkle, mixing, pii, quality, quality_rules, secrets, simhash, topk, vector_codes,
)
from citeloom.llm.common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return html_content.main_text(table(spark, sf_dir, "pages"), html_content.fit())


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from each document, and the digest of what is kept."""
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document."""
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.fit(docs))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, *quality.fit(docs))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, from its text, declared language and source."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(language.document_rows(docs), language.fit(docs), "doc_id")


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each page, from its text, declared markup language, address suffix and host."""
    model = language.fit(table(spark, sf_dir, "documents"))
    return language.identify(language.page_rows(table(spark, sf_dir, "pages")), model, "page_id")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, topk.query_every(vectors, 100), k=10)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    mixed = mixing.taken_words(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of each document, some of them tampered with."""
    return merkle.verified_documents(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the threshold table on each document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of each vector."""
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


REGISTRY = {f.__name__: f for f in (
    op1_html_extraction, op2_line_dedup, op3_secret_scan, op4_decontamination, op5_pii, op6_simhash_near_dedup,
    op7_quality, op8_language_id, page_languages, op9_top_k, op10_source_mix, op11_merkle_manifest, op12_quality_rules, op13_vector_codes,
)}

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op2_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
        k AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANK})")} AS key FROM l),
        hot AS (SELECT key FROM (SELECT DISTINCT doc_id, key FROM k WHERE key <> '') GROUP BY key HAVING count(*) >= 10),
        m AS (SELECT k.*, hot.key IS NOT NULL AS gone FROM k LEFT JOIN hot ON k.key = hot.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op4_decontamination": """
        WITH w AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\\pL\\pN]+') IF x <> ''] AS ws FROM documents),
        v AS (SELECT item_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\\pL\\pN]+') IF x <> ''] AS ws FROM benchmark),
        i AS (SELECT DISTINCT item_id, least(5, len(ws)) AS n,
                     unnest([array_to_string(ws[k : k + least(5, len(ws)) - 1], ' ') FOR k IN range(1, len(ws) - least(5, len(ws)) + 2)]) AS s
              FROM v WHERE len(ws) > 0),
        d AS (SELECT DISTINCT doc_id, n, unnest([array_to_string(ws[k : k + n - 1], ' ') FOR k IN range(1, len(ws) - n + 2)]) AS s
              FROM w, (SELECT DISTINCT n FROM i) WHERE len(ws) >= n),
        c AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id),
        f AS (SELECT doc_id, item_id, count(*) AS n_found FROM i JOIN d USING (n, s) GROUP BY ALL)
        SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
        FROM f JOIN c USING (item_id) WHERE n_found >= ceil(0.8 * n_shingles - 1e-9)
    """,
    "op9_top_k": """
        WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.v, c.v)]) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op10_source_mix": """
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   CAST('0x' || substr(md5('mix:' || doc_id), 1, 10) AS BIGINT) AS h FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (SELECT *, greatest(1, least(4096, source_size // 64)) AS bw, [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight FROM s),
        f AS (SELECT *, 2 * source_size / weight AS full_level FROM w),
        l AS (SELECT *, (1.5 * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER (ORDER BY full_level, source IS NULL, source
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY full_level, source IS NULL, source
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
        o AS (SELECT arg_min(level, full_level) AS level FROM l WHERE level < full_level),
        t AS (SELECT source, source_size, bw, CAST(coalesce(least(o.level * weight, 2 * source_size), 2 * source_size) AS DOUBLE) AS target,
                     greatest(1, CAST(ceil(source_size / bw) AS BIGINT)) AS blocks FROM l, o),
        n AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END * blocks AS slots FROM t),
        u AS (SELECT *, CAST(round(slots * 1048576) AS BIGINT) AS units FROM n),
        hi AS (SELECT *, CAST(round(CAST(sum(units) OVER (ORDER BY source IS NULL, source) AS DOUBLE) / CAST(sum(units) OVER () AS DOUBLE)
                  * 4294967296) AS BIGINT) AS high FROM u),
        lo AS (SELECT *, coalesce(lag(high) OVER (ORDER BY source IS NULL, source), 0) AS low FROM hi),
        g AS (SELECT i AS slot, CAST(((i + 1)::HUGEINT * 2654435769) % 4294967296 AS BIGINT) AS point
              FROM range((SELECT CAST(round(sum(slots)) AS BIGINT) FROM n)) r(i)),
        r AS (SELECT source, blocks, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
              FROM g JOIN lo ON point >= low AND point < high),
        k AS (SELECT source, rank % blocks AS block, count(*) AS times FROM r WHERE rank // blocks < 2 GROUP BY ALL),
        p AS (SELECT doc_id, source, size, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d),
        c AS (SELECT p.*, t.source_size, t.target, bw, unnest(range(start // bw, (start + greatest(size, 1) - 1) // bw + 1)) AS block
              FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
        SELECT c.doc_id, CAST(c.size AS BIGINT) AS size, c.source_size, c.target,
               CAST(sum((least(start + c.size, (c.block + 1) * bw) - greatest(start, c.block * bw)) * coalesce(times, 0)) AS BIGINT) AS taken
        FROM c
        LEFT JOIN k ON c.source IS NOT DISTINCT FROM k.source AND c.block = k.block
        GROUP BY c.doc_id, c.size, c.source_size, c.target, c.source, start
    """,
}

_CELL = "coalesce(strlen({0}) || ':' || {0}, '-')"
_DECIMAL = "CAST({} AS VARCHAR)"
_HEAD = " || ".join(_CELL.format(_DECIMAL.format(c) if c in ("doc_id", "n_chars") else c) for c in ("doc_id", "source", "lang", "n_chars"))

# CRC-32 by its table; levels of the trees and the folds of the proofs by recursion.
SQL["op11_merkle_manifest"] = f"""
    WITH RECURSIVE bits AS (
        SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) r(i)
        UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
    d AS (SELECT doc_id, lang, sha256({_HEAD} || {_CELL.format("text")}) AS leaf,
                 sha256({_HEAD} || {_CELL.format(_LOWER.format("text"))}) AS low,
                 xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(x)::BIGINT FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
                     lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS code
          FROM documents, crc),
    p AS (SELECT *, dense_rank() OVER (ORDER BY lang IS NOT NULL, encode(coalesce(lang, ''))) - 1 AS tree,
                 row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
    lower_nodes AS (
        SELECT tree, 0 AS level, place, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM p
        UNION ALL
        SELECT tree, level + 1, place // 8, sha256(string_agg(h, '' ORDER BY place)), (n + 7) // 8 FROM lower_nodes WHERE n > 1
        GROUP BY tree, level, place // 8, n),
    subs AS (SELECT tree, arg_max(h, level) AS subroot, max(level) AS depth FROM lower_nodes GROUP BY tree),
    upper_nodes AS (
        SELECT 0 AS level, tree AS place, subroot AS h, count(*) OVER () AS n FROM subs
        UNION ALL
        SELECT level + 1, place // 8, sha256(string_agg(h, '' ORDER BY place)), (n + 7) // 8 FROM upper_nodes WHERE n > 1
        GROUP BY level, place // 8, n),
    nodes AS (
        SELECT tree, level, place, h FROM lower_nodes WHERE n > 1
        UNION ALL SELECT s.tree, s.depth + u.level, u.place, u.h FROM upper_nodes u, subs s WHERE u.n > 1),
    top AS (SELECT arg_max(h, level) AS root FROM upper_nodes),
    steps AS (SELECT tree, depth + (SELECT max(level) FROM upper_nodes) AS steps FROM subs),
    fold AS (
        SELECT row_number() OVER () AS id, doc_id, tree, leaf, CASE WHEN code % 3 = 0 THEN low ELSE leaf END AS h, place, 0 AS level, '' AS proof FROM p
        UNION ALL
        SELECT f.id, f.doc_id, f.tree, f.leaf,
               sha256(coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place < f.place), '') || f.h
                      || coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place > f.place), '')),
               CASE WHEN f.level + 1 = s.depth THEN f.tree ELSE f.place // 8 END, f.level + 1,
               f.proof || coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place <> f.place), '')
        FROM fold f JOIN nodes n ON n.tree = f.tree AND n.level = f.level AND n.place // 8 = f.place // 8 JOIN subs s ON s.tree = f.tree
        GROUP BY f.id, f.doc_id, f.tree, f.leaf, f.h, f.place, f.level, f.proof, s.depth)
    SELECT f.doc_id, f.leaf, s.subroot, top.root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = top.root AS verified
    FROM fold f JOIN steps t ON t.tree = f.tree AND t.steps = f.level JOIN subs s ON s.tree = f.tree, top
"""

_STOP = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))
_BROKEN = ", ".join(
    f"CASE WHEN {' OR '.join(f'{r.ratio} {op} {bound}' for op, bound in (('<', r.least), ('>', r.most)) if bound is not None)} THEN '{r.name}' END"
    for r in quality_rules.RULES
)

SQL["op12_quality_rules"] = f"""
    WITH s AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
               [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS l, row_number() OVER () AS id FROM documents),
    win AS (SELECT id, unnest(range(1, len(w) - 1)) AS i, w FROM s),
    named AS (SELECT id, i, count(*) OVER (PARTITION BY id, w[i : i + 2]) AS times FROM win),
    rep AS (SELECT id, count(DISTINCT i + k) AS n FROM named, range(3) r(k) WHERE times > 1 GROUP BY id),
    m AS (
        SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0) AS word_chars,
               len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
               len(l) AS n_lines, len([x FOR x IN w IF regexp_matches(x, '\\pL')]) AS n_letter,
               len([x FOR x IN w IF NOT regexp_matches(x, '\\p{{Ll}}') AND len(regexp_extract_all(x, '\\p{{Lu}}')) >= 2]) AS n_capital,
               len([x FOR x IN w IF lower(x) IN ({_STOP})]) AS n_stop, len([x FOR x IN l IF regexp_matches(x, '^[\\x20\\x09]*[-*•][\\x20\\x09]')]) AS n_bullet,
               len([x FOR x IN l IF regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')]) AS n_ellipsis
        FROM s LEFT JOIN rep ON s.id = rep.id),
    r AS (
        SELECT *, word_chars / nullif(n_words, 0) AS mean_word_length, n_symbols / nullif(n_words, 0) AS symbols_per_word,
               n_letter / nullif(n_words, 0) AS words_with_letter, n_capital / nullif(n_words, 0) AS words_in_capitals, n_stop / nullif(n_words, 0) AS stop_words,
               n_bullet / nullif(n_lines, 0) AS bullet_lines, n_ellipsis / nullif(n_lines, 0) AS ellipsis_lines, n_dup_lines / nullif(n_lines, 0) AS repeated_lines,
               n_words / nullif(n_lines, 0) AS mean_line_length, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
    b AS (SELECT *, array_to_string([x FOR x IN [{_BROKEN}] IF x IS NOT NULL], ',') AS broken FROM r)
    SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND broken = '' AS kept, broken FROM b
"""


def _vector_codes_sql(rounds: int = vector_codes.ROUNDS, parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES) -> str:
    """Every round assigns all parts to their nearest entry by looking at all of them, then takes floored means."""
    steps = [f"""
        v AS (SELECT row_number() OVER () AS id, vec_id, label, [CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        x AS (SELECT id, vec_id, label, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS u FROM v, range({parts}) r(p)),
        b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, v) - 1 AS e, u FROM x JOIN v USING (id, vec_id)
               QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id, v) <= {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"""
        a{n} AS (SELECT id, x.p, arg_min({{'e': e, 'd': d}}, {{'d': d, 'e': e}}) AS m FROM (
                   SELECT x.id, x.p, b.e, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x.u, b.u)]) AS BIGINT) AS d
                   FROM x JOIN b{n} b ON x.p = b.p) x GROUP BY id, x.p)""")
        if n < rounds:
            steps.append(f"""
        s{n} AS (SELECT a.p, a.m.e AS e, j, CAST(sum(x.u[j]) AS BIGINT) AS s, count(*) AS c FROM a{n} a JOIN x USING (id, p), range(1, len(x.u) + 1) r(j) GROUP BY ALL),
        b{n + 1} AS (SELECT b.p, b.e, coalesce(m.u, b.u) AS u FROM b{n} b LEFT JOIN (
                   SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY j) AS u FROM s{n} GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)""")
    return f"""WITH {','.join(steps)},
        books AS (SELECT sha256(string_agg(array_to_string(u, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
        c AS (SELECT id, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY id)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN v USING (id), books
    """


SQL["op13_vector_codes"] = _vector_codes_sql()
