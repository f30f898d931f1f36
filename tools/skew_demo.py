"""Skew check for the pair statistics: add one user who rated every item to
the sparse train split (a hot key) and compare the longest single task of
the split self-join against the naive self-join on the user. Task times come
from Spark's event log in a fresh scratch folder. Prints one JSON line.
This is a diagnostic, not a registered query."""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import zstandard  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from orrery.operators import itemcf as CF  # noqa: E402
from orrery.plans.common import Inputs  # noqa: E402
from orrery.session import build_session  # noqa: E402
from tools.naive_compare import naive  # noqa: E402


def task_times(log_dir):
    f = glob.glob(os.path.join(log_dir, "*", "events_*"))[0]
    raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(f, "rb").read())).read()
    out = {}
    for line in raw.decode().splitlines():
        e = json.loads(line)
        if e.get("Event") == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            out.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01")
    log_dir = tempfile.mkdtemp(prefix="orrery-skew-")
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.driver.memory": "24g", "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": log_dir})
    d = Inputs(spark, sf_dir)
    train, _ = d.split()
    items = train.select("item_id").distinct()
    hot = items.select(F.lit(-1).cast("bigint").alias("user_id"), "item_id", F.lit(3.0).alias("rating"))
    skewed = train.select("user_id", "item_id", "rating").unionByName(hot).persist()
    n_hot = skewed.where(F.col("user_id") == -1).count()
    result = {"sf_dir": sf_dir, "hot_user_items": n_hot}
    for name, build in (("split_self_join", lambda: CF.item_similarity(skewed, block=256)),
                        ("naive_self_join", lambda: naive(skewed))):
        before = set(task_times(log_dir)) if glob.glob(os.path.join(log_dir, "*", "events_*")) else set()
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        wall = time.perf_counter() - t0
        stages = {k: v for k, v in task_times(log_dir).items() if k not in before}
        result[name] = {"wall_sec": round(wall, 2),
                        "longest_task_sec": round(max(max(v) for v in stages.values()), 2)}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
