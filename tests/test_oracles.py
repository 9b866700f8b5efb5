"""Every registered query against its SQL in DuckDB on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as registered

QUERIES = registered.queries()
SQL = registered.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    return oracle.connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, db, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), db, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_flagship_runs(spark):
    assert registered.entry(spark).count() > 0


def test_rest_works_without_training_data_folders(tmp_path):
    """The entry point offers everything else where the optional folders are gone, with the pipeline file or without."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for pipeline in (True, False):
        copy = tmp_path / str(pipeline)
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "tests", ".pytest_cache"))
        if not pipeline:
            (copy / "corpus_pipeline.py").unlink()
        code = "import __spark_entry__ as e; n = e.queries(); assert len(n) > 80 and not any(q.startswith('op') or q == 'pipeline' for q in n); e.oracle_sql()"
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=300)
