"""Driver contract: entry runs, every oracle has a query, a sample of the
catalogue equals DuckDB on sf0.001."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert "lag_7" in df.columns


def test_oracles_have_queries():
    import __spark_entry__ as E

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


@pytest.mark.parametrize(
    "name",
    ["c3_features_per_series", "w2_lag_global", "p4_ffill", "v7_validate", "a3_numeric", "d2_columns",
     "a18_cv_summary", "w9_temporal_split", "st1_stream_serving"],
)
def test_query_equals_duckdb(spark, name):
    import duckdb
    from check_oracle import TABLES, digest

    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    sdf = E.queries()[name](spark, sf)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert digest(sdf.columns, [tuple(r) for r in sdf.collect()])[0] == digest(dcols, res.fetchall())[0]


def test_oracle_sql_needs_no_spark():
    """The driver may read oracle_sql() before any session exists."""
    code = "import sys; sys.path.insert(0, %r); import __spark_entry__ as E; print(len(E.oracle_sql()))" % ROOT
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.strip().splitlines()[-1]) >= 90


def test_entry_without_the_optional_operators():
    """The rest imports and registers when the llm folder is not there."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('sparkcast.llm'):\n"
        "            raise ImportError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 'c3_features_per_series' in names and 'pipeline' not in names\n"
        "assert not any(n.startswith('op') for n in names)\n"
        "assert set(e.oracle_sql()) <= names\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
