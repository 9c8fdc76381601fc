"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests.conftest import SF, rows_of
from versica.plans.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    want = duck.sql(SQL[name]).to_arrow_table()
    assert sorted(got.schema.names) == sorted(want.schema.names)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_corpus_operators(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/versica", tmp_path / "versica", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert int(out.stdout) == len(QUERIES)
