"""What the queries leave on disk, and what their steps keep and repeat, on rows built here."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from ptloom.plans import derived
from ptloom.plans.catalog import QUERIES
from ptloom.session import ensure_checkpoint_dir
from ptloom.sources.tables import Tables


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    ids = spark.range(1, 401)
    ids.selectExpr("id AS o_orderkey", "CASE WHEN id % 50 = 0 THEN NULL ELSE id % 40 END AS o_custkey").unionAll(
        spark.sql("SELECT NULL, 5L UNION ALL SELECT 7L, 7L UNION ALL SELECT NULL, NULL")).write.parquet(f"{at}/orders.parquet")
    spark.sql("SELECT 0L n_nationkey, 'GER\"MANY' n_name").write.parquet(f"{at}/nation.parquet")
    spark.sql("SELECT 0L r_regionkey, 'ASIA' r_name").write.parquet(f"{at}/region.parquet")
    ids.selectExpr("id AS p_partkey", "concat('part ', id) AS p_name").write.parquet(f"{at}/part.parquet")
    ids.selectExpr("id AS c_custkey").write.parquet(f"{at}/customer.parquet")
    return at


def _left(spark, pattern):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f: os.path.getsize(f) for f in glob.glob(f"{base}/**/{pattern}", recursive=True) if os.path.isfile(f)}


def _text_bytes(spark, tables):
    return derived.raw_pair_lines(Tables(spark, tables)).agg(F.sum(F.octet_length("value") + 1)).first()[0]


def test_jsonl_roundtrip_leaves_compressed_lines(spark, tables):
    before = _left(spark, "pairs-jsonl-*/**/part-*")
    got = {tuple(r) for r in QUERIES["jsonl_roundtrip"](spark, tables).collect()}
    left = {f: n for f, n in _left(spark, "pairs-jsonl-*/**/part-*").items() if f not in before}
    assert got == {tuple(r) for r in QUERIES["pref_file_summary"](spark, tables).collect()}
    assert left and all(f.endswith(".gz") for f in left) and sum(left.values()) * 5 < _text_bytes(spark, tables)


def test_line_error_table_orders_short_rows(spark, tables):
    before = {**_left(spark, "ptloom-table-*/part-*"), **_left(spark, "numbered-lines-*/**/part-*")}
    df = QUERIES["line_error_table"](spark, tables)
    left = {f: n for f, n in {**_left(spark, "ptloom-table-*/part-*"), **_left(spark, "numbered-lines-*/**/part-*")}.items() if f not in before}
    assert df.count() > 0
    assert left and sum(left.values()) * 3 < _text_bytes(spark, tables)


def test_lines_of_keys_are_the_raw_lines(spark, tables):
    t = Tables(spark, tables)
    a = sorted(map(str, derived.raw_pair_lines(t).select("file", "line_id", "value").collect()))
    assert a == sorted(map(str, derived.lines_of_keys(derived.raw_pair_keys(t)).select("file", "line_id", "value").collect()))


def test_counts_make_no_row_for_an_occurrence(spark):
    from ptloom.operators import bpe, codec, tokens

    d = spark.createDataFrame([("ab ab\ta\x01",), (None,), ("",), ("é😀 ab",)], "text string").coalesce(1)
    assert codec.char_counts(d, "text").where("ch = 'a'").collect() == [("a", 4)]
    assert codec.word_counts(d, "text").where("w = 'ab'").collect() == [("ab", 3)]
    assert {(r.ch, r.n) for r in tokens.char_vocab(d).collect()} == {("\t", 1), (" ", 2), ("\x01", 1), ("a", 4), ("b", 3), ("é", 1), ("😀", 1)}
    got = bpe._postings(bpe.word_table(d).select("word", "freq", F.lit("").alias("old")), 0)
    assert sorted((r.pair, r.diff) for r in got.collect() if "b" in r.pair) == [("\x01a\x02\x01b\x02", 3)]


def test_batches_for_workers_are_small(spark):
    from ptloom.operators import codec

    spark.conf.set(codec.BATCH_SETTING, str(64 << 20))
    codec.char_encoder(spark, ["a"], [0])
    assert spark.conf.get(codec.BATCH_SETTING) == f"{codec.BATCH_BYTES}b"


def test_id_totals(spark):
    from ptloom.operators import codec

    total, from_least = codec.id_totals(spark, 2)
    d = spark.createDataFrame([(1, [1, 2, 3]), (2, []), (3, None), (4, [None, 5])], "i int, ids array<int>")
    got = d.select("i", total("ids"), from_least("ids")).collect()
    assert {tuple(r) for r in got} == {(1, 6, 2), (2, 0, 0), (3, None, None), (4, None, 1)}


def test_blank_and_object_white_space(spark):
    from ptloom.functions.text import is_blank, strip_object_ws, strip_ws

    d = spark.createDataFrame([(x,) for x in ("", " 　\x0b", None, " a ", "{}", " {} ", "{ ", "\xa0{\"a\": 1}")], "s string")
    got = d.select("s", is_blank(F.col("s")).alias("b"), strip_object_ws(F.col("s")).alias("o"), strip_ws(F.col("s")).alias("t")).collect()
    assert all(r.o == r.t and r.b == (not (r.s or "").strip()) for r in got)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_outputs_make_only_the_text_they_pick(spark, tables):
    from ptloom.functions.hashing import hex8_to_long, seeded_hex
    from ptloom.operators import build

    t = Tables(spark, tables)
    o = derived.outputs(t)
    assert "named_struct(variant" not in _plan(o) and "Generate" not in _plan(o)
    d = derived.toolcalls(t).withColumn("vars", build.rejected_variants(F.col("key"), F.col("tool"), F.col("arguments_json"), F.col("chosen")))
    for model, share in derived.MODELS:
        h = seeded_hex(F.lit(model), F.col("key"))
        pick = (F.pmod(hex8_to_long(h, 9), F.lit(6)) + 1).cast("int")
        out = F.when(F.pmod(hex8_to_long(h, 1), F.lit(10)) < share, F.col("chosen")).otherwise(F.element_at("vars", pick)["text"])
        made = d.select("key", "prompt", out.alias("output"), "tool", "arguments_json", "answer")
        assert sorted(map(repr, map(tuple, made.collect()))) == sorted(repr(tuple(r)[1:]) for r in o.where(F.col("model") == model).collect())


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_output_words_meet_the_corpus_in_a_semi_join(spark, tables, tmp_path, broadcast):
    for name in ("orders", "nation", "region", "part", "customer"):
        os.symlink(f"{tables}/{name}.parquet", tmp_path / f"{name}.parquet")
    texts = ["The TOOL, the tool; the tool's \n", "unseen words été 😀x2", None, "", "  ", "ASIA part-expression"]
    spark.createDataFrame([(t,) for t in texts * 3], "text string").write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = QUERIES["output_text_stats"](spark, str(tmp_path))
        plan, got = _plan(df), {r.model: r.known_word_share for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the words of the corpus are no lists of one group each, and those no output has go no further
    assert "collect_list" not in plan and "LeftSemi" in plan
    letters = re.compile(r"[^\W\d_]+")
    known = {w for t in texts if t for w in letters.findall(t.lower())}
    for model, _ in derived.MODELS:
        words = [w for r in derived.outputs(Tables(spark, str(tmp_path))).where(F.col("model") == model).collect() for w in letters.findall((r.output or "").lower())]
        assert got[model] == pytest.approx(sum(w in known for w in words) / len(words), abs=1e-6)


def test_round_trip_keeps_ids_in_the_worker(spark, tmp_path):
    from ptloom.operators import codec

    encode = codec.bpe_encoder(spark, ["a", "b", " "], [0, 1, 2], [("a", "b")])
    known = {"a": 0, "b": 1, " ": 2, "ab": 3}
    told = codec.round_trip(encode, codec.decoder(spark, known), *codec.id_totals(spark, 3))
    d = spark.createDataFrame([(1, "ab a"), (2, ""), (3, None), (4, "abx"), (5, "ab" * 300)], "i int, text string")
    got = {r.i: tuple(r.s) for r in d.select("i", told(F.col("text")).alias("s")).collect()}
    assert got == {1: (3, 1, 5, True), 2: (0, 0, 0, True), 3: (None, None, None, True), 4: (2, 1, None, False), 5: (300, 300, 900, True)}
    d.selectExpr("text", "'en' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    plan = QUERIES["bpe_encode_stats"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "array<int>" not in plan and plan.count("ArrowEvalPython [") <= 2


def test_roundtrip_lines_are_not_sorted_by_folder(spark, tmp_path):
    from ptloom.sources import textio

    before = spark.conf.get(textio.OPEN_FOLDERS)
    d = spark.range(1000).selectExpr("concat('line ', id) AS value", "concat('f', id % 3) AS file").coalesce(1)
    textio.write_text_lines(d, "value", f"{tmp_path}/lines", partition_by=["file"], compression="gzip", open_folders=3)
    assert spark.conf.get(textio.OPEN_FOLDERS) == before
    assert sorted(r.value for r in textio.read_lines(spark, f"{tmp_path}/lines").collect()) == sorted(f"line {i}" for i in range(1000))
    assert spark.read.text(f"{tmp_path}/lines/file=f0").collect()[0].value == "line 0"


def test_pairs_are_made_from_numbers(spark, tables):
    plan = _plan(derived.pairs(Tables(spark, tables)))
    assert "named_struct(variant" not in plan and "Generate" in plan
