"""Cases of the fourth round's findings."""

import numpy as np
from pyspark.sql import functions as F

from qanvas.functions import vector as V
from qanvas.operators import choices as C


def test_a_large_pool_is_sent_twice_and_is_all_tasks_work(spark):
    """no vector is copied for each block of its pool, and the pairs of one pool are not one task's."""
    sizes = {1: 1, 2: 7, 3: 8, 4: 9, 5: 16, 6: 61}
    x = np.random.default_rng(7).normal(size=(sum(sizes.values()), 3)).tolist()
    qids = [q for q, n in sizes.items() for _ in range(n)]
    pools = spark.createDataFrame([(q, k * 37 % 102, v) for k, (q, v) in enumerate(zip(qids, x, strict=True))], "qid int, i long, embedding array<double>")
    pairs = C.all_pair_distances(pools, block=8)
    rounded = lambda df: sorted(map(str, df.select("qid", "i", "j", F.round("distance", 9).alias("d")).collect()))
    assert rounded(pairs) == rounded(C.pair_distances(pools))
    assert pairs.count() == sum(n * (n - 1) // 2 for n in sizes.values())
    assert "Generate" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    one = C.all_pair_distances(pools.where("qid = 6"), block=8)
    assert one.select(F.spark_partition_id()).distinct().count() > 4


def test_rounded_as_round(spark):
    rng = np.random.default_rng(8)
    ties = [k * 1e-6 + 5e-7 for k in range(0, 2_000_000, 1999)]
    odd = [0.0, -0.0, -1e-16, 5e-7, -5e-7, 1e300, 999.9999995, 123456789.1234565, float("inf"), float("nan"), None]
    rows = spark.createDataFrame([(x,) for x in [*(2 * rng.random(2000)).tolist(), *ties, *(-t for t in ties), *odd]], "x double")
    both = rows.select(V.rounded("x").alias("a"), F.round("x", 6).alias("b"))
    assert both.where("NOT a <=> b OR string(a) <> string(b)").count() == 0
