"""Rows in are rows out: null keys and groups, null arguments, long or deep JSON, packs, repeated outputs."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ptloom.operators import build, evaluate, ordered, split, tokens, validate
from ptloom.sources import textio


@pytest.mark.parametrize("ratio", [0.1, 0.5, 0.6, 0.7, 0.9])
def test_exact_split_keeps_null_keys(spark, ratio):
    df = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("k"), "id")
    got = Counter(r.split for r in split.exact_split(df, "k", ratio).collect())
    assert sum(got.values()) == 900 and got["val"] == split.val_count(900, ratio, "half_even")


def test_split_check_counts_null_and_repeated_keys(spark):
    inp = spark.createDataFrame([(None,), (None,), ("a",), ("a",), ("b",)], "k string")
    out = spark.createDataFrame([(None, "train"), (None, "val"), ("a", "train"), ("c", "val"), ("c", "val")], "k string, split string")
    got = {r.metric: r.value for r in split.split_check(out, inp, "k").collect()}
    assert got == {"n_train": 2, "n_val": 3, "n_overlap_keys": 1, "n_lost": 2, "n_extra": 2}


def test_ordered_aggregates_over_a_null_group(spark):
    df = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.lit("g")).alias("g"), F.col("id").alias("o"), F.lit(1).alias("v")).repartition(7)
    assert sorted((r.g or "", r.rn) for r in ordered.row_number_in_group(df, ["g"], ["o"]).collect()) == [(g, i) for g in ("", "g") for i in range(1, 201)]
    total = ordered.running_aggregate(df, ["g"], ["o"], value_col="v", how="sum", out_col="s").groupBy("g").agg(F.max("s").alias("m"))
    assert {r.g: r.m for r in total.collect()} == {None: 200, "g": 200}


def test_null_arguments_give_all_variants(spark):
    calls = spark.createDataFrame([("k", "p", "weather", None, None)], "key string, prompt string, tool string, arguments_json string, chosen string")
    got = {r.variant: r.rejected for r in build.expand_pairs(calls).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6] and got[2] == '{"function":"weather","params":null}'


def test_parser_limit_is_its_own_rule(spark):
    long = '{"id": "a", "messages": "' + "x" * (40 << 20) + '"}'
    deep = "[" * 1100 + "]" * 1100
    df = spark.createDataFrame([(1, long), (2, deep), (3, '{"id":'), (4, "[" * 900 + "]" * 900)], "n int, value string")
    got = {r.n: [e.rule for e in r.errors] for r in validate.validate_chat(df).select("n", "errors").collect()}
    assert got == {1: ["parser_limit"], 2: ["parser_limit"], 3: ["invalid_json"], 4: ["not_object"]}
    # the limits are parameters; a text that parses is judged whatever its size
    low = spark.createDataFrame([(1, '{"id":' + "x" * 100), (2, '{"id":'), (3, "[" * 60 + "]" * 59), (4, "[" * 900 + "]" * 900)], "n int, value string")
    got = {r.n: [e.rule for e in r.errors] for r in validate.validate_chat(low, max_bytes=100, max_depth=50).collect()}
    assert got == {1: ["parser_limit"], 2: ["invalid_json"], 3: ["parser_limit"], 4: ["not_object"]}
    with pytest.raises(ValueError):
        validate.validate_preference(low, max_bytes=1 << 30)


def test_duplicate_keys_do_not_depend_on_the_session(spark):
    before = spark.conf.get("spark.sql.variant.allowDuplicateKeys")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        df = spark.createDataFrame([('{"id":"a","id":"b","messages":[]}',)], "value string")
        assert [e.rule for e in validate.validate_chat(df).first().errors] == ["bad_messages"]
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", before)


def test_two_empty_lists_are_no_equal_answers(spark):
    df = spark.createDataFrame([('{"prompt":[{"role":"user","content":"q"}],"chosen":[],"rejected":[]}',)], "value string")
    r = validate.validate_preference(df).first()
    assert r.n_warnings == 0 and [e.rule for e in r.errors] == ["empty_list", "empty_list"]


def test_every_pack_is_present_and_full(spark):
    sizes = [5, 0, 23, 7, 1, 40, 3]
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate(sizes)], "b int, d int, n int")
    rows = tokens.pack(df, 10, "b", "d", "n").collect()
    per = Counter()
    for r in rows:
        assert 0 <= r.start < r.end <= sizes[r.d]
        per[r.pack_id] += r.end - r.start
    assert dict(per) == {**{i: 10 for i in range(7)}, 7: 9}


def test_repeated_outputs_are_counted(spark):
    df = spark.createDataFrame([("a", "p", "x", 0.1), ("a", "p", "y", 0.9), ("b", "p", " ", 0.4)], "model string, prompt_id string, output string, score double")
    for c in ("is_valid_json", "has_tool_key", "tool_correct", "has_arguments"):
        df = df.withColumn(c, F.lit(True))
    r = evaluate.compare_models(df, "a", "b").first()
    assert (r.a_n_outputs, r.b_n_outputs, r.a_output, r.a_score, r.a_answered, r.b_answered) == (2, 1, "y", 0.9, True, False)


def test_lines_of_files_of_one_name_stay_apart(spark, tmp_path):
    for d, n in (("x", 3), ("y", 5)):
        os.makedirs(tmp_path / d)
        (tmp_path / d / "part-0.jsonl").write_text("".join(f'{{"n":{i}}}\n' for i in range(n)))
    df = textio.read_lines(spark, [str(tmp_path / "x"), str(tmp_path / "y")], line_numbers=True)
    got = Counter(r.file for r in df.collect())
    assert sorted(got.values()) == [3, 5]
    assert all(f'{{"n":{r.line_no - 1}}}' == r.value and len(r.line_key) == 64 for r in df.collect())


def test_chat_queries_run_nothing_while_they_are_built(spark):
    from ptloom.plans.catalog import QUERIES
    from ptloom.sources.tables import read_table

    read_table(spark, "/root/testdata/sf0.001", "conversations")  # the schema of the file
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "plans only")
    try:
        for name in ("chat_records", "messages_to_turns", "chat_validate_lines", "prompt_only_records", "chat_render", "overlength_chat", "label_mask"):
            QUERIES[name](spark, "/root/testdata/sf0.001")
        jobs = tracker.getJobIdsForGroup("build")
        # reading a Parquet footer is one task; anything else would have a shuffle or more tasks
        assert all(len(tracker.getStageInfo(s) and [s]) == 1 for j in jobs for s in tracker.getJobInfo(j).stageIds) and len(jobs) <= 7
    finally:
        spark.sparkContext.setJobGroup("", "")
