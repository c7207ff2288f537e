"""Skew-safe ordered aggregates equal plain window functions, on a hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ptloom.operators.ordered import running_aggregate, row_number_in_group


def _skewed(spark):
    # group 0 holds most rows (a hot key); values repeat so sums are checked too
    return spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 7).alias("g"),
        (F.col("id") * 7919 % 5003).alias("o"),
        (F.col("id") % 13).cast("double").alias("v"),
    )


def test_row_number_matches_window(spark):
    df = _skewed(spark)
    got = row_number_in_group(df, ["g"], ["o"], num_partitions=16).select("g", "o", "rn")
    exp = df.select("g", "o", F.row_number().over(Window.partitionBy("g").orderBy("o")).alias("rn"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_running_sum_and_min(spark):
    df = _skewed(spark)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.select("g", "o", F.coalesce(F.sum("v").over(w), F.lit(0.0)).alias("s"), F.min("v").over(w).alias("m"))
    s = running_aggregate(df, ["g"], ["o"], "v", "sum", "s", inclusive=False, num_partitions=16)
    m = running_aggregate(df, ["g"], ["o"], "v", "min", "m", inclusive=False, num_partitions=16)
    got = s.join(m.select("g", "o", "m"), ["g", "o"]).select("g", "o", "s", "m")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_same_result_for_1_and_8_partitions(spark):
    df = _skewed(spark)
    a = row_number_in_group(df, ["g"], ["o"], num_partitions=1)
    b = row_number_in_group(df.repartition(8), ["g"], ["o"], num_partitions=8)
    assert a.exceptAll(b).count() == 0
