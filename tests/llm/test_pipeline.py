from __future__ import annotations

import hashlib

import pandas as pd
import pytest

import corpus_pipeline as C
from ridgeway.llm import divergence
from ridgeway.llm.graph import store

from tests.llm.helpers import SF, rows
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_divergence import brute as base
from tests.llm.test_near_dedup import brute as components
from tests.llm.test_secrets import RULES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    out = [spark.read.parquet(f"{SF}/documents.parquet").limit(400)]
    for name, stage in C.STAGES:
        out.append(store(stage(spark, out[-1], SF), name))
    return [x.toPandas() for x in out]


def test_stages_keep_the_columns_and_only_drop(kept):
    for a, b in zip(kept, kept[1:-1]):
        assert list(b.columns) == COLUMNS and set(b.doc_id) <= set(a.doc_id)
    assert len(kept[0]) > len(kept[1]) > len(kept[2]) >= len(kept[3]) == len(kept[4]) == len(kept[5])


def test_quality_rules_drop_what_fails(kept):
    gone = kept[0][~kept[0].doc_id.isin(kept[1].doc_id)]
    for t in kept[1].text:
        n = base(t)
        assert n[0] >= 50 and 100 * n[4] <= 50 * n[0]
    assert len(gone)


def test_one_of_each_group_of_near_copies_stays(kept):
    want = components(list(zip(kept[1].doc_id, kept[1].text)), words=5)
    assert sorted(kept[2].doc_id) == sorted(i for i, _, c in want if i == c)


def test_contaminated_documents_go(kept):
    items = list(pd.read_parquet(f"{SF}/benchmark.parquet").itertuples(index=False, name=None))
    assert sorted(kept[3].doc_id) == sorted(i for i, t in zip(kept[2].doc_id, kept[2].text) if not hits(t, items)[3])


def test_secrets_are_replaced_and_nothing_else(kept):
    both = kept[3].merge(kept[4], on="doc_id")
    for r in both.itertuples():
        assert not any(len(m.group(g)) >= n for _, rx, g, n in RULES for m in rx.finditer(r.text_y))
        if "[REDACTED]" not in r.text_y:
            assert r.text_x == r.text_y
        assert r.n_chars_y == len(r.text_y)


def test_tokens_decode_to_the_texts(kept):
    last = kept[5].merge(kept[4], on="doc_id")
    for r in last.itertuples():
        assert len(r.ids) == r.n_tokens and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
    plain = lambda t: "".join(t.lower().split())
    ascii_rows = [r for r in last.itertuples() if r.text.isascii()]
    assert ascii_rows and all(r.decoded.replace(" ", "").replace("</w>", "") == plain(r.text) for r in ascii_rows)


def test_edges(spark, edge_docs, empty_docs, tmp_path):
    only = edge_docs.select(*COLUMNS)
    for name, stage in C.STAGES:
        assert stage(spark, empty_docs.select(*COLUMNS), SF).count() == 0
        assert stage(spark, only, SF).count() <= 11
    assert rows(divergence.keep(only), "doc_id")
