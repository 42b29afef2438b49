"""Every query of the engine against its DuckDB twin, reconciliation identities, and the scalable plan shapes."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from parlance.operators import aggregates as A
from parlance.operators import detail
from parlance.plans import oracle, queries
from parlance.sources import bridge

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def norm(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return "[" + ",".join(map(norm, v)) + "]" if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(oracle.sql()))
def test_twin(spark, con, name):
    df = queries.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    cur = con.execute(oracle.sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_sums_agree(spark):
    t, s = bridge.tables(spark, DATA), queries.scope()
    total = A.summary_counts(t, s).first()
    assert A.rooms(t, s).groupBy().sum("events").first()[0] == total["events"] == A.room_categories(t, s).groupBy().sum("events").first()[0]
    involved = A.agents(t, s).groupBy().sum("involved", "owned").first()
    assert A.agent_categories(t, s).groupBy().sum("events").first()[0] == involved[0] >= involved[1]


def test_bounds(spark):
    t, s = bridge.tables(spark, DATA), queries.scope()
    for page, size in ((0, 10), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            detail.event_page(t, s, page, size)
    with pytest.raises(ValueError, match="more than"):
        detail.checked_rows(s.rows(t), 3)
    assert detail.pages(101, 100) == 2


def test_plans(spark, capsys):
    queries.QUERIES["room_top_groups"](spark, DATA).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out
    queries.QUERIES["event_count"](spark, DATA).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "CartesianProduct" not in plan
