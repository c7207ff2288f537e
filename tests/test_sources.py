import json
import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ptloom.functions import jsonx
from ptloom.sources import textio


def test_missing_paths_report(spark):
    d = tempfile.mkdtemp(prefix="ptloom-src-")
    present = os.path.join(d, "train.jsonl")
    open(present, "w").write("{}\n")
    out = textio.missing_paths(spark, [present, os.path.join(d, "val.jsonl")]).collect()
    assert [(os.path.basename(r.path), r.rule) for r in out] == [("val.jsonl", "file_missing")]


def test_multi_file_scan_keeps_file_names(spark):
    d = tempfile.mkdtemp(prefix="ptloom-src-")
    for name, lines in {"a.jsonl": ['{"x":1}', ""], "b.jsonl": ['{"x":2}']}.items():
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    df = textio.read_lines(spark, [os.path.join(d, "a.jsonl"), os.path.join(d, "b.jsonl")])
    got = sorted((os.path.basename(r.file), r.value) for r in df.collect())
    assert got == [("a.jsonl", ""), ("a.jsonl", '{"x":1}'), ("b.jsonl", '{"x":2}')]


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-10**6, 10**6) | st.text(max_size=8),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(max_size=5), inner, max_size=4),
    max_leaves=12,
)
mutations = st.sampled_from(["none", "truncate", "trailing", "prefix", "double"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(json_values, mutations), min_size=1, max_size=12))
def test_strict_json_parity_property(spark, cases):
    texts = []
    for v, m in cases:
        s = json.dumps(v, ensure_ascii=False)
        s = {"none": s, "truncate": s[:-1], "trailing": s + " x", "prefix": "x" + s, "double": s + " " + s}[m]
        texts.append(s)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.s_ok for r in jsonx.with_strict_json(df, "s", "s").select("i", "s_ok").collect()}

    def py_ok(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False

    for i, t in enumerate(texts):
        assert got[i] == py_ok(t), t


def test_line_numbers_follow_splits_and_paths(spark, tmp_path):
    """Files of one name in two folders, cut into many splits; blank lines count, no line is shuffled."""
    texts = {"a/x.txt": ["l%d " % i + "y" * (i % 17) for i in range(900)], "b/x.txt": ["m%d" % i if i % 3 else "" for i in range(500)], "b/y.txt": [], "c/one.txt": ["only"]}
    for name, lines in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("".join(x + "\n" for x in lines))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "700b")
    try:
        df = textio.read_lines(spark, [str(tmp_path / d) for d in "abc"], line_numbers=True)
        got = df.collect()
        assert df.select("file").rdd.getNumPartitions() > 8
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    mine = {}
    for r in got:
        mine.setdefault("/".join(r.file.split("/")[-2:]), {})[r.line_no] = r.value
    assert mine == {name: {i + 1: x for i, x in enumerate(lines)} for name, lines in texts.items() if lines}
    assert len(got) == sum(map(len, texts.values()))


def test_seeded_shuffle_positions(spark):
    from ptloom.operators import split

    df = spark.range(500).select(F.format_string("k%d", "id").alias("k"))
    order = [r.k for r in split.seeded_shuffle(df, "k").collect()]
    assert {r.k: r.pos for r in split.seeded_shuffle(df.repartition(6), "k", pos_col="pos").collect()} == {k: i + 1 for i, k in enumerate(order)}
