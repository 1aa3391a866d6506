"""Radix selection gives the exact quantiles, also with a value held by a third of the rows."""

from decimal import Decimal

from pyspark.sql import functions as F

from wagerscope.functions import radix, scans

PROBS = {"p0": 0.0, "p01": 0.01, "p33": 0.33, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def test_matches_exact_quantiles(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 3).cast("string").alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(Decimal("7.25")))  # a third of all rows: one value
        .otherwise(((F.col("id") * 7919) % 100_003 - 50_000).cast("decimal(18,2)") / 100)
        .cast("decimal(18,2)").alias("v"),
    ).union(spark.createDataFrame([("1", None), (None, Decimal("-3.5"))], "g string, v decimal(18,2)"))
    want = sorted(map(tuple, scans.exact_quantiles(df, "v", PROBS, by=["g"]).collect()), key=repr)
    got = sorted(map(tuple, radix.radix_quantiles(df, "v", PROBS, by=["g"]).select("g", *PROBS).collect()), key=repr)
    assert got == want
    whole = radix.radix_quantiles(df, "v", PROBS).collect()
    assert tuple(whole[0]) == tuple(scans.exact_quantiles(df, "v", PROBS).collect()[0])


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v decimal(18,2)")
    assert radix.radix_quantiles(df, "v", PROBS, by=["g"]).count() == 0
