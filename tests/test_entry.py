"""The driver contract: entry(), queries() and oracle_sql() agree, and each
registered query matches its SQL on DuckDB at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from bigraph.plans import QUERIES, SQL

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "next_word", "probability"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _key(rows, cols):
    def norm(v):
        return ("null",) if v is None or (isinstance(v, float) and math.isnan(v)) else (type(v) is float, str(v))
    return sorted(tuple(norm(r[c]) for c in cols) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    srows = [r.asDict() for r in df.collect()]
    assert _key(srows, cols) == _key(drows, cols)


def test_a_broken_import_is_not_hidden(tmp_path):
    """Only the missing subpackage is passed over."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module_here\n")
    code = (f"import sys; sys.path.insert(0, {root!r}); sys.path.insert(0, {str(tmp_path)!r})\n"
            "import corpus_pipeline")
    assert subprocess.run([sys.executable, "-c", code], capture_output=True).returncode
    code = (f"import sys, types; sys.path.insert(0, {root!r})\n"
            "class Finder:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in GONE: raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Finder())\n"
            "import __spark_entry__ as e; print('pipeline' in e.queries(), 'adjacency' in e.queries())")
    for gone, out in (({"corpus_pipeline"}, "False True"), ({"bigraph.llm"}, "False True"), ({"numpy.linalg"}, None)):
        run = subprocess.run([sys.executable, "-c", f"GONE = {gone!r}\n" + code], capture_output=True, text=True)
        assert run.stdout.strip() == (out or "") and (run.returncode == 0) == (out is not None)


def test_package_reaches_the_workers(tmp_path):
    """A script that has the package on its own path only."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(f"""import sys
sys.path.insert(0, {root!r})
from bigraph.session import local_session, ship
spark = local_session(1, 1)
spark.conf.set("spark.sql.execution.pyspark.udf.faulthandler.enabled", "false")
ship(spark)
def f(batches):
    import bigraph.functions.text
    yield from batches
print("rows", spark.range(3).mapInArrow(f, "id bigint").count())
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "rows 3" in run.stdout, run.stderr[-2000:]
