import __spark_entry__ as se


def test_entry_runs_on_smoke_data(spark):
    df = se.entry(spark)
    assert df.columns == ["brand", "avg_price_compliant", "avg_price_non_compliant", "percent_diff"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert len(se.oracle_sql()) >= 35


def test_queries_run_from_another_directory(tmp_path):
    """The driver imports the entry module from elsewhere; Python workers then
    cannot import this package, so nothing they run may depend on it."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as se\n"
        "print('ROWS', se.queries()['read_bronze_union'](s, '/root/testdata/sf0.001').count())\n"
    ) % repo
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 6000" in out.stdout, out.stderr[-2000:]
