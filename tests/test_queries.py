"""Every query with SQL gives what DuckDB gives; the others give rows."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def shape(df: pd.DataFrame) -> list[tuple]:
    plain = lambda x: None if x is None or (isinstance(x, float) and x != x) or x is pd.NA else tuple(x) if hasattr(x, "tolist") and not hasattr(x, "item") else x.tolist() if hasattr(x, "tolist") else x
    rows = [tuple(str(tuple(v) if isinstance(v, list) else v) for v in map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)]
    return sorted(tuple(x[:-2] if x.endswith(".0") else x for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(k for k in entry.queries() if not k.startswith("op") and k != "pipeline"))
def test_query(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    if name in entry.oracle_sql():
        want = duck.sql(entry.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert shape(got) == shape(want)
    else:
        assert len(got)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_the_rest_without_the_llm_subpackage(tmp_path):
    """corpus_pipeline.py stays, as it may: the entry still imports, and the other tests pass."""
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{top}/marlstone", tmp_path / "marlstone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(f"{top}/tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(f"{top}/{name}", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)
    (tmp_path / "corpus_pipeline.py").unlink()
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)
    # Those that need no session of their own for long; the whole of them would run this test again.
    done = subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", "tests/test_rows_and_reports.py", "tests/test_images.py"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stdout[-2000:]


def test_arrow_batches_of_texts_are_bounded(spark, sf_dir):
    """A worker of clean_text held 10,000 texts of any length, several times over."""
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    entry.queries()["clean_text"](spark, sf_dir)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "2000"
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "8m"
