"""Every registered query against its DuckDB oracle on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from strata.plans.catalogue import QUERIES
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    ocols = [c[0] for c in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    # Counting prunes columns differently from collecting; it must work too.
    assert df.count() == len(rows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "flight_id"


def test_entry_lives_without_the_training_queries(tmp_path):
    """A missing library of theirs takes none of the other queries down."""
    code = ("import builtins, warnings; real = builtins.__import__\n"
            "def gone(name, *a, **k):\n"
            "    if name.split('.')[0] == 'public_tokenizers': raise ModuleNotFoundError(name, name=name)\n"
            "    return real(name, *a, **k)\n"
            "builtins.__import__ = gone; warnings.simplefilter('ignore')\n"
            "import __spark_entry__ as e; from strata.plans.catalogue import QUERIES\n"
            "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())")
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
