"""Every query with SQL gives the same rows as DuckDB on the smallest tables; the training-data package is optional."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

from granary.plans import branches, catalogue  # noqa: F401 - branches adds its queries to the catalogue

DATA = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0) if not math.isnan(v) else "nan"
    if isinstance(v, bool) or isinstance(v, str) or not hasattr(v, "__float__"):
        return repr(v)
    return repr(float(v))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", list(catalogue.oracles()))
def test_against_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(v) for v in r) for r in df.select(*columns).collect())
    rel = duck.execute(catalogue.oracles()[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(norm(r[names.index(c)]) for c in columns) for r in rel.fetchall())


@pytest.mark.parametrize("name", [n for n in catalogue.queries() if n not in catalogue.oracles()])
def test_rows(spark, name):
    assert catalogue.queries()[name](spark, DATA).count() > 0


def test_core_without_the_training_package():
    code = "import sys; sys.modules['granary.llm'] = None; import __spark_entry__ as e; assert not any(n.startswith('p1_') for n in e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
