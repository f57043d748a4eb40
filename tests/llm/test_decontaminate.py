import re

from llm_fixtures import LONG, docs, none

from citeloom.llm import decontaminate

ITEM = "the quick brown fox jumps over the lazy dog and then it sleeps under a tall green tree until the morning comes again"


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def brute(texts, items):
    out = set()
    for i, item in items:
        ws = words(item)
        n = min(5, len(ws))
        own = {" ".join(ws[k : k + n]) for k in range(len(ws) - n + 1)} if ws else set()
        for d, t in texts:
            dw = words(t)
            found = len(own & {" ".join(dw[k : k + n]) for k in range(len(dw) - n + 1)}) if own else 0
            if own and found >= 0.8 * len(own) - 1e-9:
                out.add((d, i, len(own), found))
    return sorted(out)


def test_edges_match_brute_force(spark):
    changed = ITEM.replace("morning", "evening").upper()
    far = " ".join(w if i % 4 else "other" for i, w in enumerate(ITEM.split()))
    df = docs(spark, [None, "", ITEM, f"{LONG} {ITEM}, {LONG}", changed, far, "nothing here", "Short item!", "a short-item inside", ITEM.replace(" ", "\n")])
    items = [(0, ITEM), (1, None), (2, ""), (3, "short item"), (4, "!!"), (5, LONG[:3000]), (6, ITEM), (0, ITEM), (7, "here")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, hash string")
    got = decontaminate.leaks(df, frame)
    texts = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute(texts, items)
    assert decontaminate.leaks(none(df), frame).count() == 0
    assert decontaminate.leaks(df, none(frame)).count() == 0
    gone = {d for d, *_ in brute(texts, items)}
    kept = decontaminate.without_leaks(df, frame)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in texts if d not in gone)
    assert kept.columns == df.columns


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    df = docs(spark, [ITEM, "no", f"{ITEM} more"])
    frame = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    want = sorted(tuple(r) for r in decontaminate.leaks(df, frame).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert sorted(tuple(r) for r in decontaminate.leaks(df, frame).collect()) == want
