from __future__ import annotations

from collections import defaultdict
from fractions import Fraction
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from ridgeway.llm import source_mix as M

from tests.llm.helpers import EXTRA, SF, rows

WORD_SPACE = " \t\n\v\f\r"


def size_of(text):
    return len((text or "").encode().split())


def brute(docs, weights=(3, 1, 2), share=150, epochs=2, seed=1):
    """docs: (id, text, source) -> (id, size, source_size, target, taken), by clamping in rounds."""
    sized = [(i, size_of(t), s) for i, t, s in docs]
    total = defaultdict(int)
    for _, n, s in sized:
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, closed = {}, set()
    while True:
        left = Fraction(share * sum(total.values()), 100) - sum(epochs * total[s] for s in closed)
        open_ = [s for s in names if s not in closed]
        target = {s: Fraction(epochs * total[s]) if s in closed else left * weight[s] / sum(weight[o] for o in open_) for s in names}
        over = {s for s in open_ if target[s] > epochs * total[s]}
        if not over:
            break
        closed |= over
    out = []
    for s in names:
        mine = [(int(md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:15], 16), n, i) for i, n, o in sized if o == s]
        whole, rest = divmod(int(target[s]), total[s]) if total[s] else (0, 0)
        for h, n in sorted({(h, n) for h, n, _ in mine}):
            ties = [i for g, m, i in mine if (g, m) == (h, n)]
            part = min(n, max(0, rest // len(ties))) if n else 0
            rest -= min(n * len(ties), rest)
            out += [(i, n, total[s], float(target[s]), whole * n + part) for i in ties]
    return sorted(out, key=str)


def run(docs, **how):
    return sorted((tuple(r) for r in M.mix(docs, **how).select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)


@pytest.mark.parametrize("how", [{}, {"weights": (1,), "share_percent": 60, "seed": 5}, {"weights": (5, 1), "share_percent": 280, "max_epochs": 3},
                                 {"share_percent": 190}])
def test_against_brute_force(spark, how):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    names = {"share_percent": "share", "max_epochs": "epochs"}
    assert run(docs, **how) == brute(plain, **{names.get(k, k): v for k, v in how.items()})


def test_targets_are_met_and_capped(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = M.mix(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"))
    for r in got.collect():
        assert abs(r["taken"] - r["target"]) <= 1 and r["over"] <= 0


def test_a_hot_source_and_a_hot_row(spark):
    """A source with most rows, and one row repeated so often that it lies at the edge."""
    docs = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("a b c d e").alias("text"),
                                    F.when(F.col("id") < 2800, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 3)).alias("source"))
    plain = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for share in (35, 70, 150):
        got = run(docs, share_percent=share)
        assert got == brute(plain, share=share)
        taken = sum(t[4] for t in got if t[2] == 14000)
        aim = next(t[3] for t in got if t[2] == 14000)
        assert aim - 2000 <= taken <= aim


def test_capped_everywhere_weight_table_and_reruns(spark):
    docs = spark.createDataFrame([(i, "w " * (i + 1), "abc"[i % 3]) for i in range(30)], "doc_id long, text string, source string")
    assert all(t[4] == 2 * t[1] for t in run(docs, share_percent=500))
    told = spark.createDataFrame([("a", 1), ("b", 0), ("z", 9)], "source string, weight int")
    got = M.mix(docs, weights=told, share_percent=50, carry=["source"]).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"))
    assert {r["source"]: (r["t"], r["n"]) for r in got.collect()} == {"a": (232.5, 232), "b": (0.0, 0), "c": (0.0, 0)}
    assert run(docs) == run(docs.repartition(7))


def test_the_mix_itself(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = M.mix(docs, carry=["text"])
    out = M.repeat(mixed).select("doc_id", "taken", "copy", "text").collect()
    words = defaultdict(int)
    for r in out:
        words[r.doc_id] += size_of(r.text)
    want = {r.doc_id: r.taken for r in mixed.collect() if r.taken}
    assert dict(words) == want


def test_edges(spark, edge_docs, empty_docs):
    plain = [(r.doc_id, r.text, r.source) for r in edge_docs.collect()]
    assert run(edge_docs) == brute(plain)
    assert rows(M.mix(empty_docs)) == []
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(t[0], t[1], t[3], t[4]) for t in run(blank)] == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert M.mix(edge_docs, carry=list(EXTRA[:3])).columns[1:4] == list(EXTRA[:3])
