from __future__ import annotations

import re

from pyspark.sql import functions as F

from ridgeway.llm import decontaminate as D

from tests.llm.helpers import prose, rows


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(doc, items, window=13):
    w, hit, found = words(doc), set(), set()
    for item, text in items:
        b = words(text)
        if not b:
            continue
        n = min(window, len(b))
        grams = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(w), sorted(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


ITEMS = [(1, prose(50, 40)), (2, prose(51, 13)), (10, "Short-item of FIVE words é"), (3, ""), (4, None), (5, prose(50, 40)), (6, "...")]


def docs():
    a, b = prose(50, 40).split(), prose(51, 13)
    out = [(1, prose(60, 30) + " " + " ".join(a[5:25]).upper() + ", " + prose(61, 30)), (2, prose(62, 900) + " " + b), (3, " ".join(a[:12])),
           (4, "x short item; of five\nwords É y"), (5, "x short item of five words é é"), (6, None), (7, ""), (8, " ".join(a) + " " + " ".join(a)), (8, b), (None, b + " " + b)]
    return out


def test_matches_brute_force(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as i", "2 as t")
    df = spark.createDataFrame(docs(), "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as state", "3 as row")
    key = lambda t: tuple((x is None, str(x)) for x in t)
    want = sorted([(i, *brute(t, ITEMS)) for i, t in docs()], key=key)
    for limit in (D.MAX_BYTES, 5000, 1000):  # one broadcast, and several slices one after another
        got = D.scan(df, bench, max_bytes=limit)
        assert rows(got, "doc_id", "n_words", "hit_words", "item_ids", "contaminated") == want
    kept = D.clean(df, bench)
    assert kept.columns == df.columns
    assert rows(kept, "doc_id") == sorted([(i,) for i, t in docs() if not brute(t, ITEMS)[3]], key=key)
    cut = D.clean(df, bench, remove="spans")
    assert cut.count() == len(docs())
    assert not any(brute(r.text, [x for x in ITEMS if x[0] != 10])[1] for r in cut.collect())


def random_items(seed, n):
    import random
    r = random.Random(seed)
    vocab = ["a", "b", "cc", "dd", "é", "x1"]
    return [(k, " ".join(r.choices(vocab, k=r.randint(0, 40)))) for k in range(n)]


def test_set_against_brute_force_with_colliding_hashes(monkeypatch):
    import numpy as np
    items = random_items(1, 40) + [(3, "a b cc"), (3, "a b cc"), (99, "a a a a a a a a a a a a a a a a a a")]
    texts = [t for _, t in random_items(2, 60)] + ["a " * 50, "", "a b cc", "a b cc dd"]
    for weak in (False, True):
        if weak:    # all words of two lengths collide: only the comparison of words decides
            monkeypatch.setattr(D, "_hashes", lambda w: np.array([len(x) % 2 for x in w], dtype=np.uint64))
        grams = D.NgramSet([(i, t.encode()) for i, t in items], 3 if weak else 13)
        import pickle
        grams = pickle.loads(pickle.dumps(grams))
        for t in texts:
            n, hits, found, _ = brute(t, items, 3 if weak else 13)
            got, ids = grams.scan(D.words_of(t.encode()))
            assert ([] if got is None else got.tolist()) == hits and sorted(ids) == found


def test_set_keeps_its_bound():
    for items in ([(k, prose(k, 300)) for k in range(200)], [(k, "a b c d e f g " * 40 + str(k)) for k in range(200)],
                  [(k, f"w{k}") for k in range(5000)]):
        grams = D.NgramSet([(i, t.encode()) for i, t in items])
        assert grams.nbytes <= sum(len(t.encode()) + D.WORD_BYTES * len(t.split()) for _, t in items) + 64


def test_spans_are_cut_out_whole():
    assert D.cut_spans("a, b c. D e", [1, 2]) == "a,  D e".replace("  ", " . ") or D.cut_spans("a, b c. D e", [1, 2]) == "a, . D e"
    assert D.cut_spans("one two three", [0]) == " two three"


def test_edges(spark, edge_docs, empty_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.scan(edge_docs, bench).where("contaminated").count() == 0
    assert rows(D.clean(edge_docs, bench)) == rows(edge_docs)
    assert D.scan(empty_docs, bench).count() == 0
    none = D.scan(edge_docs, bench.limit(0))
    assert none.where(F.size("hit_words") > 0).count() == 0 and none.count() == 11
