from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd

from ridgeway.llm import divergence as D
from ridgeway.llm import queries as Q

from tests.llm.helpers import SF, prose, rows


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    times, hit = Counter(zip(w, w[1:], w[2:])), set()
    for k in range(len(w) - 2):
        if times[tuple(w[k:k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit)


def test_base_counts_and_verdict_of_the_query(spark):
    got = Q.QUERIES["op5_distribution_divergence"](spark, SF).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")
    for i, t in docs.text.items():
        n = brute(t)
        r = got.loc[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0]) and not (r.base_failed and r.kept)
    told = got.join(pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id"), how="inner")
    told = told[~told.base_failed]
    assert told[told.quality == 1].kept.mean() > 0.99 and told[told.quality == 0].kept.mean() < 0.5


def test_references_match_counting_by_hand(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    refs = D.references(spark.read.parquet(f"{SF}/documents.parquet").repartition(5))
    for lang, part in docs.groupby("lang"):
        words, shares = Counter(), []
        for t in part.text:
            words.update(D.bare_words(t.encode()))
            c = D.class_counts(t.encode())
            shares.append([int(x) * D.BINS // int(c.sum()) for x in c])
        top = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:D.COMMON]
        assert refs.totals[lang] == sum(words.values())
        assert list(refs.words[lang][0]) == [w for w, _ in top] and refs.words[lang][1][:-1].tolist() == [c for _, c in top]
        mid = [sorted(col)[(len(col) - 1) // 2] for col in zip(*shares)]
        assert [round(x) for x in refs.classes[lang]] == mid


def test_js_distance():
    import numpy as np
    assert D.js_distance(np.array([1.0, 0]), np.array([0, 2.0])) == 1.0
    assert D.js_distance(np.array([3.0, 1]), np.array([6.0, 2])) == 0.0
    p, q = (0.5, 0.5), (0.25, 0.75)
    m = [(a + b) / 2 for a, b in zip(p, q)]
    want = math.sqrt(sum(0.5 * a * math.log2(a / c) for x in (p, q) for a, c in zip(x, m)))
    assert abs(D.js_distance(np.array(p), np.array(q)) - want) < 1e-12


def test_edges(edge_docs, empty_docs):
    got = D.score(edge_docs, min_words=50)
    want = sorted([(r.doc_id, *brute(r.text)) for r in edge_docs.collect()], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert rows(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == want
    kept = D.keep(edge_docs)
    assert kept.columns == edge_docs.columns
    assert rows(kept, "doc_id") == rows(got.where("kept"), "doc_id")
    assert D.score(empty_docs).count() == 0 and D.keep(empty_docs).count() == 0


def test_symbol_tokens_count_as_words_of_the_character_test():
    refs = D.References({"en": [793, 14, 0, 166, 23, 0, 0, 0]}, {"en": [(b"the", 500)]}, {"en": 5000})
    judge = D.Rules(refs).judge
    prose_words = prose(1, 40).split()
    junk = " ".join(f"{w} {mark}" for w, mark in zip(prose_words, ["|", "###", "$ % &", "***"] * 10)).encode()
    base, failed, c, w, kept = judge("en", junk)
    assert base[0] >= 50 and len(D.bare_words(junk)) < 50 and not failed and c > 0.3 and w is not None and not kept
    bare = " ".join("|&$#"[k % 4] * (1 + k // 4) for k in range(80)).encode()  # no word at all
    base, failed, c, w, kept = judge("en", bare)
    assert base[0] == 80 and not failed and c > 0.5 and w is None and not kept
    assert judge("en", prose(1, 80).encode())[4] and judge("en", b"| # |")[4] is False


def test_short_junk_is_caught(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = D.score(docs).toPandas().merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    short = got[~got.base_failed & (got.n_words < 200)]
    assert not short[short.quality == 0].kept.any() and short[short.quality == 1].kept.mean() > 0.98


def test_small_languages_lean_on_the_pooled_reference(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").head(300)[["doc_id", "text", "lang"]]
    junk = " | ".join(prose(9, 80).split())
    few = pd.DataFrame([(-1, junk, "xx"), (-2, prose(9, 80), "xx"), (-3, junk, None)], columns=docs.columns)
    every = pd.concat([docs, few])
    df = spark.createDataFrame(every, "doc_id long, text string, lang string")
    refs = D.references(df)
    assert 0 < refs.weights["xx"] < 0.1 < 0.9 < refs.weights["en"] and None in refs.classes
    shares = []
    for t in every.text:
        c = D.folded(D.class_counts(t.encode()))
        shares.append([int(x) * D.BINS // int(c.sum()) for x in c])
    assert [round(x) for x in refs.pooled] == [sorted(col)[(len(col) - 1) // 2] for col in zip(*shares)]
    got = {r.doc_id: r for r in D.score(df, refs).where("doc_id < 0").collect()}
    assert not got[-1].kept and got[-2].kept and not got[-3].kept and got[-1].char_distance > 0.2
    # slices of languages give the same rows as one broadcast
    columns = ("doc_id", "n_words", "char_distance", "word_distance", "kept")
    assert rows(D.score(df, max_languages=2), *columns) == rows(D.score(df, refs), *columns)
    assert D.reference_slices(df, max_languages=2)[0] > 1
    assert rows(D.keep(df, max_languages=2), "doc_id") == rows(D.score(df, refs).where("kept"), "doc_id")


def test_the_verdict_has_no_jump_at_any_size():
    own, pooled, text = [600, 14, 0, 160, 23, 0, 0, 203], [793, 14, 0, 166, 23, 0, 0], prose(2, 90).encode()
    before = None
    for total in [*range(0, 5000), *range(5000, 200_000, 997)]:
        refs = D.References({"en": own}, {"en": [(b"the", total // 10)]}, {"en": total}, pooled=pooled) if total else D.References({}, {}, {}, pooled=pooled)
        c, w, _ = refs.distances("en", text)
        if before is not None:
            assert abs(c - before[0]) < (0.001 if total < 5000 else 0.05) and abs((w or 0.0) - before[1]) < (0.001 if total < 5000 else 0.08)
        before = c, w or 0.0


def test_verdict_of_the_query_by_hand(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rules = D.Rules(D.references(spark.read.parquet(f"{SF}/documents.parquet")))
    got = {r.doc_id: r for r in Q.QUERIES["op5_distribution_divergence"](spark, SF).collect()}

    def js(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        return math.sqrt(max(0.0, sum(a * math.log2(2 * a / (a + b)) / 2 for x, y in ((p, q), (q, p)) for a, b in zip(x, y) if a)))

    for r in docs.itertuples():
        t, g, refs = r.text.encode(), got[r.doc_id], rules.refs
        a = refs.totals[r.lang] / (refs.totals[r.lang] + D.PRIOR)
        k = D.class_counts(t).tolist()
        c = a * js(k, refs.classes[r.lang].tolist()) + (1 - a) * js([k[0] + k[7], *k[1:7]], refs.pooled.tolist())
        index, reference = refs.words[r.lang]
        words = Counter(x if x in index else None for x in D.bare_words(t))
        w = a * js([words[x] for x in index] + [words[None]], reference.tolist())
        assert abs(g.char_distance - c) < 1e-9 and abs(g.word_distance - w) < 1e-9
        n, bare = len(t.split()), sum(words.values())
        bad = (n >= 50 and c > 0.15 + 0.4 / math.sqrt(n)) or (bare >= 50 and w > 0.3 + 2 / math.sqrt(bare))
        assert g.kept == (not g.base_failed and not bad)
