"""Shuffle files do not outlive what read them."""

import os
import re
import time

from orrery.operators import als as ALSO
from orrery.session import written


def shuffles(spark) -> set:
    """Numbers of the shuffles that have files."""
    top = spark.sparkContext.getConf().get("spark.local.dir")
    return {int(m.group(1)) for _, _, names in os.walk(top) for n in names if (m := re.match(r"shuffle_(\d+)_.*\.data", n))}


def left(spark, before: set, most: int) -> int:
    """How many new shuffles have files, as soon as there are at most ``most``."""
    end = time.time() + 15
    while len(shuffles(spark) - before) > most and time.time() < end:
        time.sleep(0.2)
    return len(shuffles(spark) - before)


def cells(spark):
    return spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(30) for i in range(12)], "user_id int, item_id int, rating double")


def test_als_drops_the_messages_of_past_iterations(spark):
    train, before = cells(spark), shuffles(spark)
    model = ALSO.fit_als(train, 2, 9, 0.1)
    assert left(spark, before, 8) <= 8
    assert model.transform(train).count() == 360


def test_written_tables_leave_no_shuffle(spark):
    df, before = cells(spark).repartition(3, "user_id"), shuffles(spark)
    out = written(df.groupBy("item_id").count())
    assert left(spark, before, 0) == 0
    assert out.count() == 12 and df.count() == 360
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_the_grid_keeps_one_step_on_disk(spark):
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    factors = lambda: {d for _, names, _ in os.walk(top) for d in names if d.startswith("factors-")}
    df, tables, before = cells(spark), factors(), shuffles(spark)
    runs, _, _ = ALSO.grid_search(df, df, [2, 3], [2, 6], [0.1, 0.2])
    assert factors() == tables and runs.count() == 8
    assert left(spark, before, 16) <= 16
