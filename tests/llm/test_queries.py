"""Registered queries at sf0.001 against their SQL; the entry lists all of them."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from ridgeway.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


def test_entry_lists_every_operator_and_the_pipeline():
    names = E.queries()
    assert {f"op{k}" for k in range(1, 14)} <= {n.split("_")[0] for n in names}
    assert names["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({Q.ORACLES[name]}) q").fetchall()
    got = [tuple(r) for r in df.select(*cols).collect()]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)
