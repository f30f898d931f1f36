"""Plan-shape checks for scale properties (read from explain output)."""

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_fact_scan_is_pruned_and_filtered(spark):
    df = entry.queries()["ratings_per_user"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # only the three lineitem columns the rating needs reach the scan
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan
    df2 = entry.queries()["large_parts"](spark, SF_SMALL)
    assert "GreaterThan(p_size,10)" in df2._jdf.queryExecution().executedPlan().toString()  # pushed into the scan


def test_top_k_uses_group_limit_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("user_holdout", "neighbour_prediction_desc"):
            assert "WindowGroupLimit" in _plan(spark, name)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_pair_statistics_stay_in_the_jvm(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("item_similarity", "pca_covariance", "copair_counts", "candidate_neighbours"):
            plan = _plan(spark, name)
            assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_register_needs_no_session_and_no_folder():
    """From a zip on the path, in another folder, without a JVM."""
    import os
    import shutil
    import subprocess
    import sys
    import tempfile

    root = os.path.dirname(os.path.abspath(entry.__file__))
    work = tempfile.mkdtemp(prefix="orrery-zip-")
    for name in ("orrery", "__spark_entry__.py"):
        src, to = os.path.join(root, name), os.path.join(work, "lib", name)
        if os.path.isdir(src):
            shutil.copytree(src, to, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, to)
    packed = shutil.make_archive(os.path.join(work, "lib"), "zip", os.path.join(work, "lib"))
    code = ("import __spark_entry__ as e, sys; from pyspark import SparkContext; q, o = e.queries(), e.oracle_sql();"
            "assert len(q) > 60 and set(o) <= set(q) and SparkContext._active_spark_context is None;"
            "assert not any(k.startswith('op') or k == 'pipeline' for k in q); assert '.zip' in e.__file__")
    run = subprocess.run([sys.executable, "-c", code], cwd=work, env=os.environ | {"PYTHONPATH": packed}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr[-2000:]
