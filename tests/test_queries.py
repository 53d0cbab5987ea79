"""Every registered catalogue query against its SQL in DuckDB, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from cairnframe.plans import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.queries()))
def test_equal_rows(spark, db, name):
    got = queries.queries()[name](spark, SF)
    cols = sorted(got.columns)
    rows = Counter(repr(tuple(r)) for r in got.select(*cols).collect())
    want = db.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    assert rows == Counter(repr(tuple(r[names.index(c)] for c in cols)) for r in want.fetchall())


def test_no_python_and_no_cartesian_plans(spark):
    for name, query in queries.queries().items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "Python" not in plan and "Pandas" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = queries.QUERIES["allocate_cave_ids"](spark, SF)
    assert plan.columns == ["o_orderkey", "cave_id"]
    scan = queries.QUERIES["best_event_per_user"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in scan


def test_entry_works_without_the_llm_folders(spark, monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as entry

    with monkeypatch.context() as m:
        m.setitem(sys.modules, "corpus_pipeline", None)
        importlib.reload(entry)
        assert set(entry.queries()) > set(queries.queries()) and set(entry.oracle_sql()) == set(entry.queries()) and not any(n.startswith("op") for n in entry.queries())
        assert entry.entry(spark).count() > 0
    importlib.reload(entry)
