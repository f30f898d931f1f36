"""Times item similarity two ways on the same input at $BENCH_SF_DIR:
the split self-join and the naive plan (self-join on the user, then
group by item pair), the shape the original job had. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from orrery.operators import itemcf as CF  # noqa: E402
from orrery.operators.gram import pearson  # noqa: E402
from orrery.operators.olap import with_support  # noqa: E402
from orrery.plans.common import Inputs  # noqa: E402
from orrery.session import build_session  # noqa: E402


def naive(train):
    f = with_support(train, "item_id", 25).select("user_id", "item_id", (F.col("rating") * 2).alias("x"))
    a, b = f.alias("a"), f.alias("b")
    pairs = a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.item_id") < F.col("b.item_id")))
    st = pairs.groupBy(F.col("a.item_id").alias("c1"), F.col("b.item_id").alias("c2")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("a.x").alias("sx"), F.sum("b.x").alias("sy"),
        F.sum(F.col("a.x") * F.col("b.x")).alias("sxy"), F.sum(F.col("a.x") * F.col("a.x")).alias("sxx"),
        F.sum(F.col("b.x") * F.col("b.x")).alias("syy"))
    return pearson(st)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "24g"})
    d = Inputs(spark, sf_dir)
    train, _ = d.split()
    train.count()
    out = {}
    for name, build in (("split_self_join", lambda: CF.item_similarity(train)), ("naive_self_join", lambda: naive(train))):
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t0, 3)
    out["sf_dir"] = sf_dir
    print(json.dumps(out))


if __name__ == "__main__":
    main()
