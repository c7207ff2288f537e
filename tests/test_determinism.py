"""Order-dependent queries give the same rows whatever the shuffle layout."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["packing", "loss_deltas", "exact_split_pairs", "padding_batches",
                                  "contiguous_split_docs", "pref_quality_report"])
def test_same_rows_for_different_partitioning(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = sorted(map(tuple, E.queries()[name](spark, SF).collect()), key=str)
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        b = sorted(map(tuple, E.queries()[name](spark, SF).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b
