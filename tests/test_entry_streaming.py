"""Driver contract and the streaming monitor."""
import glob
import os
import shutil
import tempfile

import pytest

from tests.conftest import SF001


def test_entry_runs_and_has_stable_schema(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert {"overall_drift_score", "recommendations", "total_features"} <= set(df.columns)


def test_every_oracle_has_a_query():
    from __spark_entry__ import oracle_sql, queries
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 149  # the catalogue only grows
    # the corpus queries and the pipeline are there exactly where the optional part is
    here = os.path.exists(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tabsmith", "llm", "queries.py"))
    assert bool([n for n in q if n.startswith("op") or "pipeline" in n]) == here


@pytest.mark.parametrize("name", ["orders_features", "stratified_split", "expectation_suite", "histogram"])
def test_queries_run_at_smallest_scale(spark, name):
    from __spark_entry__ import queries
    assert queries()[name](spark, SF001).count() > 0


def test_validate_and_drift_stream(spark):
    from pyspark.sql import functions as F

    from tabsmith.streaming.monitor import drift_stream, validate_stream
    src = tempfile.mkdtemp(prefix="tabsmith-stream-src-")
    for i in range(2):
        shutil.copy(f"{SF001}/orders.parquet", os.path.join(src, f"part-{i}.parquet"))
    schema = spark.read.parquet(f"{SF001}/orders.parquet").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = tempfile.mkdtemp(prefix="tabsmith-stream-out-")
    rules = [{"type": "expect_column_values_to_be_in_set", "column": "o_orderstatus", "value_set": ["F", "O", "P"]}]
    q = validate_stream(stream, rules, f"{out}/quality", checkpoint=f"{out}/ck1")
    q.awaitTermination(120)
    res = spark.read.parquet(f"{out}/quality")
    assert res.select("batch_id").distinct().count() == 2 and res.where(~F.col("success")).count() == 0
    ref = spark.read.parquet(f"{SF001}/orders.parquet")
    q2 = drift_stream(stream, ref, ["o_totalprice"], ["o_orderpriority"], f"{out}/drift", checkpoint=f"{out}/ck2")
    q2.awaitTermination(180)
    rep = spark.read.parquet(f"{out}/drift").collect()
    assert len(rep) == 2 and all(r["drifted_features"] == 0 for r in rep)
    assert glob.glob(f"{out}/drift/batch_id=*")


def test_entry_from_foreign_cwd():
    """The driver loads the entry file from elsewhere: Python workers must not need the package."""
    import subprocess
    import sys
    code = ("import importlib.util\n"
            "spec = importlib.util.spec_from_file_location('e', '/root/repo/__spark_entry__.py')\n"
            "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "print('rows', m.queries()['chi2_drift'](s, '/root/testdata/sf0.001').count())\n")
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True, timeout=600)
    assert "rows 2" in out.stdout, out.stderr[-2000:]
