"""Every registered query against its DuckDB SQL on sf0.001 (the gate's check, smaller)."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as E
from ridgeway import plans
from tests.conftest import SF_SMALL

QUERIES = plans.QUERIES
ORACLES = plans.ORACLES


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):  # exact: both sides round identically; only NaN needs care
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v

    out = sorted((tuple(norm(r[i]) for i in order) for r in rows),
                 key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["class_idx", "feature_idx", "weight"]
    assert len(rows) == 4


# Three registered queries on one and the same run of 450 passes: here one run serves them all.
ONE_RUN = ("sgd_softmax", "sgd_softmax_history", "multiclass_accuracy")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ONE_RUN)))
def test_query_matches_sql(spark, duck, name):
    compare(QUERIES[name](spark, SF_SMALL), duck, ORACLES[name])


def test_softmax_run_matches_sql(spark, duck, monkeypatch):
    from ridgeway.plans import multiclass as M
    result = M._train(spark, SF_SMALL, M.SGD_SOFTMAX)
    monkeypatch.setattr(M, "_train", lambda *_: result)
    head = M.run_sql(M.SGD_SOFTMAX)
    assert all(ORACLES[name].startswith(head) for name in ONE_RUN)
    duck.execute(f"CREATE OR REPLACE TEMP TABLE run AS {head}\nSELECT * FROM run")
    stored = "WITH final AS (SELECT * FROM run WHERE epoch = (SELECT max(epoch) FROM run))"
    assert len(result.history) == 450
    for name in ONE_RUN:
        compare(QUERIES[name](spark, SF_SMALL), duck, stored + ORACLES[name][len(head):])


def compare(df, duck, sql):
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(sql)
    o_cols, o_rows = _canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows
