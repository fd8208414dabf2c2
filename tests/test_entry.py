"""The driver contract: queries against DuckDB on the smallest tables, and the entry without the corpus operators."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__
from sporelight import catalog

ROOT, SF = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _plain(v):
    if v is None or v != v:
        return None
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    columns = sorted(df.columns)
    got = sorted(repr([_plain(r[c]) for c in columns]) for r in df.collect())
    order = [want.columns.index(c) for c in columns]
    assert got == sorted(repr([_plain(r[i]) for i in order]) for r in want.fetchall())
    assert got


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_corpus_operators(tmp_path):
    shutil.copytree(f"{ROOT}/sporelight", tmp_path / "sporelight", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'best_hit_per_contig' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
