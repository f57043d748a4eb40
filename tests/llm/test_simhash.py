import numpy as np
import xxhash
from conftest import SMALL
from llm_fixtures import TEXTS, docs, none

from citeloom.llm import simhash


def brute_print(text):
    words, word = [], ""
    for c in text or "":
        c = c.lower() if "A" <= c <= "Z" else c
        if c == " " or "\t" <= c <= "\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    words += [word] * bool(word)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    group = list(range(len(ids)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return [least[find(i)] for i in range(len(ids))]


def check(df):
    pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    prints = [brute_print(t) for _, t in pairs]
    want = sorted((d, f"{p:016x}", c) for (d, _), p, c in zip(pairs, prints, brute_components([d for d, _ in pairs], prints), strict=True))
    assert sorted(tuple(r) for r in simhash.near_duplicates(df).collect()) == want


def test_edges_match_brute_force(spark):
    check(docs(spark))
    assert simhash.near_duplicates(none(docs(spark))).count() == 0


def test_table_matches_brute_force(spark):
    check(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_fingerprints_within_three_bits_share_a_key():
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63 - 1, 4000, dtype=np.int64)
    flips = np.zeros(4000, np.int64)
    for _ in range(3):
        flips ^= np.where(rng.random(4000) < 0.8, np.int64(1) << rng.integers(0, 63, 4000), 0)
    keys = []
    for prints in (base, base ^ flips):
        row, key = simhash.golay_keys(prints)
        keys.append({(r, k) for r, k in zip(row.tolist(), key.tolist(), strict=True)})
    assert {r for r, _ in keys[0] & keys[1]} == set(range(4000))


def test_every_syndrome_has_its_error_and_codewords_decode_to_themselves():
    assert len(set(simhash.ERRORS.tolist())) == 2048
    words = np.arange(1 << 12, dtype=np.int64) << 11
    codewords = words ^ simhash._syndrome(words)
    assert (simhash._syndrome(codewords) == 0).all()
    assert (simhash.nearest(codewords ^ 0b10000100001) == np.arange(1 << 12)).all()


def test_a_key_of_many_fingerprints_is_cut_into_blocks(spark):
    near = [(int(v) << 46 >> 0) for v in range(5000)]  # one codeword in two segments, a dense ball in the third
    far = [(0x5A5A5A << 23) | (1 << 60), 0x1234567]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in near + far], "fp long"))
    groups = simhash.components(links)
    sizes = sorted(r["count"] for r in groups.groupBy("component").count().collect())
    assert sizes[-1] == 5000
    assert links.count() < 60_000


def test_texts_of_fixture_are_hashed_alike():
    assert [simhash.fingerprint(t) & (2**64 - 1) for t in TEXTS] == [brute_print(t) for t in TEXTS]
