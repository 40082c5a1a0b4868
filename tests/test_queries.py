"""Every registered query against its SQL, values compared exactly."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests import oracle

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return oracle.connect(sf)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, duck, name):
    assert oracle.compare(spark, duck, QUERIES[name], SQL[name], sf) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["series", "us", "value"]
    assert out.count() > 0


def test_entry_without_the_text_operators():
    code = "import sys; sys.modules['tidemark.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True, timeout=300)
    n, m, *names = done.stdout.split()
    assert done.returncode == 0 and int(n) == len(names) > 190 and int(m) > 180
    assert not any(x == "pipeline" or x.startswith("op") for x in names) and "without the text operators" in done.stderr
