"""Distributed exact quantiles equal Spark's exact ``percentile``."""

import math

from pyspark.sql import functions as F

from wearlog.operators.quantiles import exact_quantiles


def test_matches_percentile(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 11 == 0, F.lit(None))
        .when(F.col("id") % 7 == 0, F.lit(0.0))
        .otherwise((F.sin(F.col("id")) * 1000).cast("decimal(10,2)").cast("double") * F.when(F.col("id") % 5 == 0, -1).otherwise(1))
        .alias("v"),
    ).union(spark.createDataFrame([(3, 2.5), (3, 2.5), (4, -1e300), (4, 1e-300), (4, 8.0), (4, 8.0000001)], "g long, v double"))
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, 0.33]
    # max_distinct=3 sends the big groups through the bucketed path too
    got = {r.g: [r[f"q_{i}"] for i in range(len(probs))] for r in exact_quantiles(df, ["g"], "v", probs, max_distinct=3).collect()}
    got_small = {r.g: [r[f"q_{i}"] for i in range(len(probs))] for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    want = {
        r.g: list(r.q)
        for r in df.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()
    }
    assert set(got) == set(want) == set(got_small)
    for k in want:
        for a, b, c in zip(got[k], want[k], got_small[k]):
            assert math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9), (k, a, b)
            assert math.isclose(c, b, rel_tol=1e-12, abs_tol=1e-9), (k, c, b)


def test_global_group(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 2, 4]], "v double")
    for md in (1, 100):
        r = exact_quantiles(df, [], "v", [0.25, 0.5], max_distinct=md).first()
        assert (r.q_0, r.q_1) == (2.0, 3.0)
