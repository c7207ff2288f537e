"""Segmented scans, as-of joins and exact quantiles against plain Python and Spark's own functions."""

import random

import pytest
from pyspark.sql import functions as F

from ptloom.operators import scan


def rows(seed=1, n=700):
    r = random.Random(seed)
    # one group holds half of the rows, one is null
    return [(r.choice(["hot"] * 4 + ["a", "b", None, "c"]), i, r.choice([None, float("nan"), r.random(), r.random(), round(r.random(), 1)]), r.choice([None, r.randint(-5, 50)])) for i in range(n)]


@pytest.mark.parametrize("batch", [10_000, 7])
def test_composed_state(spark, batch):
    data = rows()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(data, "g string, o long, v double, n int").repartition(5)
        got = scan.segmented_scan(df, ["g"], ["o"], ordinal="ord", previous={"prev": "v"}, least={"low": "v", "low_n": "n"}, total={"sum": "n"}, last={"seen": "v"}, num_partitions=9).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(data)
    mine = {r.o: r for r in got}
    least = lambda xs: min((x for x in xs if x is not None and x == x), default=float("inf") if any(x is not None for x in xs) else None)
    state = {}
    for g, o, v, n in data:
        before = state.setdefault(g, [])
        r = mine[o]
        assert (r.g, repr(r.v), r.n, r.ord) == (g, repr(v), n, len(before) + 1)
        assert repr(r.prev) == repr(before[-1][0] if before else None)
        assert r.low == least([x for x, _ in before]) or (r.low != r.low and least([x for x, _ in before]) == float("inf"))
        assert r.low_n == min((m for _, m in before if m is not None), default=None)
        assert r.sum == sum(m for _, m in before if m is not None)
        assert repr(r.seen) == repr(next((x for x in [v, *[x for x, _ in reversed(before)]] if x is not None), None))
        before.append((v, n))


def test_scan_without_groups_and_without_rows(spark):
    df = spark.range(100).select("id")
    got = scan.segmented_scan(df, [], ["id"], ordinal="ord", total={"sum": "id"}).collect()
    assert all(r.ord == r.id + 1 and r["sum"] == r.id * (r.id - 1) // 2 for r in got) and len(got) == 100
    assert scan.segmented_scan(df.limit(0), [], ["id"], ordinal="ord").count() == 0
    with pytest.raises(ValueError):
        scan.segmented_scan(df, [], ["id"], ordinal="id")


def test_asof_join(spark):
    r = random.Random(3)
    left = [(r.choice(["a", "b", "hot", "hot", None]), r.choice([None, r.randint(0, 40)]), i) for i in range(300)]
    right = [(r.choice(["a", "hot", "hot", None, "z"]), r.choice([None, r.randint(5, 45)]), i) for i in range(200)]
    a, b = spark.createDataFrame(left, "k string, t int, i int").repartition(4), spark.createDataFrame(right, "k string, t int, x int").repartition(3)
    got = {x.i: (x.match.x if x.match else None) for x in scan.asof_join(a, b, ["k"], "t", ties=["x"]).collect()}
    assert len(got) == 300
    for k, t, i in left:
        fits = [(u, x) for kk, u, x in right if kk == k and t is not None and u is not None and u <= t]
        assert got[i] == (max(fits)[1] if fits else None)


def test_quantiles_equal_percentile(spark):
    r = random.Random(4)
    data = [(r.choice(["hot", "hot", "a", None]), r.choice([None, r.randint(0, 9), r.randint(0, 9)])) for _ in range(500)] + [("one", 3), ("two", 1), ("two", 2), ("none", None)]
    df = spark.createDataFrame(data, "g string, v int").repartition(4)
    shares = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    want = {x.g: x for x in df.groupBy("g").agg(*[F.percentile("v", q).alias(k) for k, q in shares.items()]).collect()}
    got = {x.g: x for x in scan.exact_quantiles(df, ["g"], "v", shares).collect()}
    assert set(want) - set(got) == {"none"}
    for g, x in got.items():
        assert [x[k] for k in shares] == pytest.approx([want[g][k] for k in shares])
    assert scan.exact_quantiles(df, [], "v", {"m": 0.5}).first().m == df.agg(F.percentile("v", 0.5)).first()[0]


def test_packed_sequences_concatenate_to_the_input(spark):
    from ptloom.operators import tokens

    r = random.Random(6)
    docs = [(r.randint(0, 2), i, [r.randint(0, 99) for _ in range(r.choice([0, 1, 3, 9, 47]))]) for i in range(60)] + [(1, 100, None), (None, 101, [1, None, 3])]
    df = spark.createDataFrame(docs, "b int, d int, ids array<int>").repartition(4)
    got = sorted(tokens.packed_sequences(df, 10, "b", "d").collect(), key=lambda x: (str(x.b), x.pack_id))
    for b in (0, 1, 2, None):
        packs = [x for x in got if x.b == b]
        want = [(t, d, i) for bb, d, ids in docs if bb == b for i, t in enumerate(ids or [])]
        assert [t for x in packs for t in x.input_ids] == [t for t, _, _ in want]
        assert [len(x.input_ids) for x in packs[:-1]] == [10] * (len(packs) - 1) and [x.pack_id for x in packs] == list(range(len(packs)))
        for k, x in enumerate(packs):
            mine = [d for _, d, _ in want[10 * k:10 * k + 10]]
            seg = [1 + sorted(set(mine)).index(d) for d in mine]
            assert x.segment_ids == seg and x.position_ids == [seg[:i].count(s) for i, s in enumerate(seg)]


def test_truncation_spares_the_answer(spark):
    from ptloom import constants as K
    from ptloom.operators import tokens

    r = random.Random(7)
    chats = [[(r.choice(["system", "user", "assistant", "user", None]), r.choice([None, "", "x" * r.randint(1, 30), "é日" * r.randint(1, 40)])) for _ in range(r.randint(0, 5))] for _ in range(80)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(chats)], "i int, m array<struct<role:string,content:string>>")
    for x in df.select("i", tokens.truncate_chat(F.col("m"), 60).alias("t")).collect():
        pieces = [(role or "", f"{K.CHATML_PRE}{role or ''}\n{text or ''}{K.CHATML_POST}") for role, text in chats[x.i]]
        whole = "".join(p for _, p in pieces)
        ends = [sum(len(p) for _, p in pieces[:k + 1]) for k in range(len(pieces))]
        answers = [(e - len(p), e) for (role, p), e in zip(pieces, ends) if role == "assistant"]
        at = 0
        if answers and len(whole) > 60 and answers[-1][1] > 60:
            a, b = answers[-1]
            at = a if b - a > 60 else b - 60
        t = x.t
        assert (t.n_tokens, t.cut_start, "".join(map(chr, t.input_ids))) == (len(whole), at, whole[at:at + 60])
        assert t.answer_kept == (None if not answers else answers[-1][0] >= at and answers[-1][1] <= at + 60)
        assert [y.n_lost for y in t.lost] == [len(p) - len(set(range(e - len(p), e)) & set(range(at, at + 60))) for (_, p), e in zip(pieces, ends)]
        labels = [c if any(a <= k < b for a, b in answers) else -100 for k, c in enumerate(map(ord, whole))]
        assert t.labels == labels[at:at + 60]
