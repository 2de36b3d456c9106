import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.running import exact_median, global_rank, running_total
from millrace.sources import scratch
from millrace.sources.scratch import shared_dir, stored


def table(spark, seed=1, n=3000):
    rnd = random.Random(seed)
    rows = [(rnd.choice([1, 1, 1, 1, 2, 3, None, 4]), rnd.choice([None, *range(40)]), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k bigint, v bigint, i bigint").repartition(5)


@pytest.mark.parametrize("tasks", [1, 3, 16])
def test_running_totals(spark, tasks):
    rows, df = table(spark)
    got = running_total(df, ["k"], [F.col("v").asc_nulls_first(), F.col("i").asc()], "i", "before", "all", tasks).collect()
    want, sums = {}, {}
    for k, v, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        want[i] = sums.get(k, 0)
        sums[k] = want[i] + i
    assert {r["i"]: r["before"] for r in got} == want and all(r["all"] == sums[r["k"]] for r in got) and len(got) == len(rows)


@pytest.mark.parametrize("tasks", [1, 7])
def test_global_rank(spark, tasks):
    rows, df = table(spark, 2)
    got = {r["i"]: r["position"] for r in global_rank(df, [F.col("v").asc_nulls_first(), F.col("i").desc()], tasks=tasks).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, -r[2]))
    assert got == {r[2]: n for n, r in enumerate(order, 1)}
    assert global_rank(df.limit(0), [F.col("i").asc()]).count() == 0


def test_rank_has_no_window_over_everything(spark):
    _, df = table(spark, 3, 50)
    plan = global_rank(df, [F.col("i").asc()])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan


def test_medians_like_the_built_in(spark):
    for seed in range(3):
        _, df = table(spark, seed, 997)
        for value in (F.col("v"), F.col("v") / 7, F.col("v").cast("decimal(10,2)")):
            d = df.withColumn("x", value)
            want = {r["k"]: r["m"] for r in d.groupBy("k").agg(F.median("x").alias("m")).collect()}
            got = {r["k"]: r["median_value"] for r in exact_median(d, "k", "x", tasks=6).collect()}
            assert got.keys() == want.keys() and all(got[k] == pytest.approx(float(want[k])) for k in want)
    d = spark.createDataFrame([(1, None), (2, 5), (2, 8)], "k bigint, v int")
    assert {tuple(r) for r in exact_median(d, "k", "v").collect()} == {(1, None), (2, 6.5)}
    assert exact_median(d.limit(0), "k", "v").count() == 0


def test_a_hot_key_is_shared_out(spark):
    """One key with nine tenths of the distinct values: no range holds much more than its share."""
    df = spark.range(0, 40_000).selectExpr("CASE WHEN id % 10 > 0 THEN 0 ELSE id END AS k", "id * 7919 % 40009 AS v")
    made = []
    real = scratch.stored
    import millrace.operators.running as running

    running.stored = lambda d, name: made.append(real(d, name)) or made[-1]
    try:
        got = {r["k"]: r["median_value"] for r in exact_median(df, "k", "v", tasks=16).where("k = 0").collect()}
    finally:
        running.stored = real
    assert got[0] == df.where("k = 0").agg(F.median("v")).first()[0]
    sizes = [r["count"] for r in made[0].groupBy("_task").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 40_000 / 16


def test_shared_folder(spark, monkeypatch):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Context:
        applicationId, master = "app", "local[2]"

        class _jsc:
            @staticmethod
            def sc():
                class Sc:
                    getCheckpointDir = staticmethod(lambda: type("O", (), {"isDefined": lambda self: False})())

                return Sc

    class Session:
        conf, sparkContext = Conf, Context

    assert shared_dir(Session) == shared_dir(Session)  # unset, local: one temporary folder, and the setting isn't touched
    Context.master, Context.applicationId = "spark://x", "other"
    with pytest.raises(RuntimeError):
        shared_dir(Session)
    assert stored(spark.range(3), "t").count() == 3
