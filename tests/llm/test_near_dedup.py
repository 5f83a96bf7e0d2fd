from __future__ import annotations

import random

import numpy as np
import pytest

from ridgeway.llm import graph
from ridgeway.llm import near_dedup as N

from tests.llm.helpers import prose, rows


def brute(data, words=4, percent=80):
    """(id, n, component) by comparing all pairs."""
    sets = []
    for _, text in data:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({ord(c): " " for c in "\t\n\v\f\r"}).split(" ")
        w = [x for x in w if x]
        n = min(words, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set())
    up = list(range(len(data)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[find(i)] = find(j)
    groups = {}
    for i in range(len(data)):
        groups.setdefault(find(i), []).append(data[i][0])
    best = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(data[i][0], len(s), best[find(i)] if s else data[i][0]) for i, s in enumerate(sets)]


def variant(text, seed, edits):
    r, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
    return " ".join(w)


def check(spark, data, **options):
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = N.deduplicate(df, **options)
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute(data), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())
    return df


def test_groups_of_near_copies_and_chains(spark):
    data, k = [], 0
    for g in range(12):
        base = prose(g, 60 + 20 * g)
        for v in range(10):
            data.append((k := k + 1, variant(base, k, v % 5)))
    chain = prose(99, 120)
    for _ in range(15):  # a chain: neighbours are similar, the ends are not
        chain = variant(chain, k, 3)
        data.append((k := k + 1, chain))
    check(spark, data)


def test_large_nodes_are_finished_exactly(spark):
    base = prose(7, 80)
    data = [(i, variant(base, i, i % 6)) for i in range(150)]           # one dense group
    line = prose(8, 60)
    data += [(1000 + i, line + " " + prose(5000 + i, 8 + i % 30)) for i in range(150)]  # similar, most below the limit
    check(spark, data, trees=4, depth=1, leaf=8, block=16)


def test_edges(spark, edge_docs, empty_docs):
    data = [(r.doc_id, r.text) for r in edge_docs.collect()]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert rows(N.deduplicate(edge_docs), "doc_id", "n_shingles", "component_id") == sorted(brute(data), key=key)
    kept = N.keep(edge_docs)
    assert kept.columns == edge_docs.columns
    assert rows(kept, "doc_id") == sorted([(1,), (3,), (4,), (5,), (None,), (6,), (7,), (8,)], key=key)
    assert N.deduplicate(empty_docs).count() == 0 and N.keep(empty_docs).count() == 0


def test_keep_leaves_one_row_of_repeated_rows(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (5, "A b C d e f")], "doc_id long, text string")
    assert N.keep(df).count() == 1
    assert {r.kept for r in N.deduplicate(df).collect()} == {True}


def test_hashes_do_not_depend_on_the_pieces(monkeypatch):
    text = prose(3, 5000).encode() + b"\t\x0b" + b"z" * 5000 + b" end"
    whole = N.word_hashes(text)
    monkeypatch.setattr(N, "_PIECE", 512)
    assert (N.word_hashes(text) == whole).all() and len(whole) == len(text.split())


def test_miss_probability_of_the_coordinate_bound():
    rng, k = np.random.default_rng(0), N.least_matches(0.8)
    assert 25 < k < 45
    assert (rng.binomial(N.COORDINATES, 0.8, 10**6) < k).mean() < 1e-5


@pytest.mark.parametrize("seed", [0, 1])
def test_components_match_union_find(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(200, 200 + i) for i in range(30)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {x.u: x.v for x in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in up if find(x) != x}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_trees_share_no_coordinate():
    """A coordinate that differs moves the nodes of one tree only, at one level only."""
    import pyarrow as pa
    mins = np.random.default_rng(1).integers(0, 1 << 32, N.COORDINATES, dtype=np.uint32)

    def paths(mins):
        """Nodes of each level by tree."""
        out, node = [], None
        for level in range(N.DEPTH):
            if level == 0:
                batch = pa.RecordBatch.from_arrays([pa.array([b"k"]), pa.array([mins.tobytes()])], names=["key", "mins"])
                got = list(N._roots(N.TREES)([batch]))
            else:
                batch = pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array([b"k"] * len(node)), pa.array([mins.tobytes()] * len(node))],
                                                   names=["node", "key", "mins"])
                got = list(N._branch(N.TREES, N.DEPTH, level)([batch]))
            node = [x for b in got for x in b.column("node").to_pylist()]
            out.append({t: sorted(x for x in node if x & 63 == t) for t in range(N.TREES)})
        return out

    whole = paths(mins)
    assert all(len(x) for level in whole for x in level.values())
    for c in range(N.COORDINATES):
        other = mins.copy()
        other[c] ^= 1
        moved = {t for was, now in zip(whole, paths(other)) for t in was if was[t] != now[t]}
        assert len(moved) <= 1
    assert sum(len(x) == 2 for x in whole[0].values()) == 3
