import datetime
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from certflow.plans.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def plain(rows):
    def one(v):
        if isinstance(v, float):
            return None if v != v else float(f"{v:.9g}")
        if isinstance(v, datetime.datetime):
            return v.replace(tzinfo=None).isoformat()
        return list(map(one, v)) if isinstance(v, list) else v
    return sorted((tuple(map(one, r)) for r in rows), key=repr)


@pytest.fixture(scope="module")
def db():
    found = duckdb.connect()
    for t in TABLES:
        found.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.columns and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns = ", ".join(f'"{c}"' for c in sorted(df.columns))
    assert plain(df.select(sorted(df.columns)).collect()) == plain(db.execute(f"SELECT {columns} FROM ({SQL[name]})").fetchall())


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "bench.py"))


def test_the_other_queries_load_without_the_subpackage():
    code = ("import sys; sys.modules['{0}'] = None; import __spark_entry__ as e; "
            "assert 'clean_report' in e.queries() and not any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in e.queries())")
    for name in ("xxhash", "certflow.llm", "corpus_pipeline"):
        done = subprocess.run([sys.executable, "-c", code.format(name)], cwd=os.path.dirname(entry.__file__), capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
        assert "left out" in done.stderr
