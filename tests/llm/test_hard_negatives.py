"""Operator 11 against plain sorting of all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from ptloom.llm import hard_negatives as hn

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                       *[T.StructField(c, T.StringType()) for c in ("vector", "tree", "block", "shard", "rank", "id", "score", "values", "ps")]])


def cases(n=700, dim=6, seed=3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(7)]
    out = []
    for i in range(n):
        c = r.choice(centres)
        out.append((i, [np.float32(a + r.gauss(0, 0.2)).item() for a in c], 0 if r.random() < 0.4 else r.randint(1, 9)))
    same = out[5][1]
    out += [(1000 + i, same, i % 3) for i in range(80)]                       # one vector very often
    out += [(100, out[3][1], 4), (100, out[3][1], 4), (None, out[4][1], 2), (None, out[4][1], 3)]  # repeated ids, no ids
    out += [(2000, None, 1), (2001, [1.0, None, 2.0], 1), (2002, [float("nan")] * dim, 1), (2100, [float("inf")] * dim, 1), (2200, same, None)]
    out += [(2300, [], 1), (2400, [1.0] * (dim + 3), 1), (2401, [2.0] * (dim + 3), 5), (2500, [0.0] * dim, 3), (-100, same, 2), (2600, [3e38] * dim, 6), (2601, [-3e38] * dim, 6), (2602, [3e37] * dim, 7)]
    return out


def quantised(v):
    return [max(-2**53, min(2**53, math.floor(256 * x))) for x in v]


def plain(data, every=100):
    part = [(i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, quantised(v)) for i, v, label in data
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, label, v) in enumerate(part):
        if i is None or i % every:
            continue
        scored = [(-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), j is None, j, other == label) for b, (j, other, w) in enumerate(part) if b != a]
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        for p, _, pid, _ in [s for s in scored if s[3]][:5]:
            fits = [s for s in scored if not s[3] and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(i, pid, k, s[2], -p, -s[0]) for k, s in enumerate(fits[:10], 1)]
    return out


def key(r):
    return tuple(map(str, r))


@pytest.mark.parametrize(("block", "queries"), [(4096, 1024), (40, 3)])
def test_mining(llm, tmp_path, block, queries):
    data = cases()
    df = llm.createDataFrame([(*d, *["x"] * 9) for d in data], SCHEMA).repartition(5)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    want = sorted(plain(data), key=key)
    if block == 4096:
        got = hn.op11(llm, str(tmp_path))
    else:
        from pyspark.sql import functions as F
        got = hn.mine(hn.participants(df).withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))), block=block, queries=queries)
    assert sorted(map(tuple, got.collect()), key=key) == want and len(want) > 100
    assert hn.mine(hn.participants(df.limit(0))).count() == 0


def test_tree_covers_and_separates():
    x = np.random.default_rng(4).normal(size=(500, 3)) * 50
    made = hn.grow(x)
    order, sizes = made["order"], made["sizes"].tolist()
    assert sorted(order.tolist()) == list(range(500)) and sizes[0] == 1 and sizes == sorted(sizes)
    top = np.sqrt((x * x).sum(1).max())
    y = np.column_stack([x, np.sqrt(np.maximum(top**2 - (x * x).sum(1), 0))])[order] / top
    centres = y[made["centers"]]
    gaps = [np.inf if s == 1 else min(np.linalg.norm(centres[i] - centres[j]) for i in range(s) for j in range(i)) for s in sizes]
    cover = [np.linalg.norm(y[:, None] - centres[None, :s], axis=2).min(1).max() for s in sizes]
    # the centres of a level lie further apart than the next one that would join them covers
    assert all(g >= c - 1e-9 for g, c in zip(gaps, cover)) and cover == sorted(cover, reverse=True)


def test_bounds_skip_leaves_and_lose_nothing():
    """Clustered vectors: few rows are checked, and the best are those of all products."""
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 16)) * 100
    x = np.floor(centres[r.integers(0, 40, 3000)] + r.normal(size=(3000, 16))).astype(np.int64)
    made = hn.grow(x.astype(float))
    order = made.pop("order")
    tree = hn.Tree({"ids": order.astype(np.int64).tobytes(), "labels": np.zeros(3000, np.int64).tobytes(), "points": x[order].astype("i4").tobytes(), "width": 4, "dim": 16,
                    **{c: made[c].astype(np.float64 if c == "angles" else np.int64).tobytes() for c in ("leaf_at", "centers", "sizes", "parents", "angles")}})
    q = x[:20]
    search = hn.Search(q, np.zeros(20, np.int64), np.full((20, 1), -2**63), np.full((20, 1), 2**63 - 1), 5, True)
    seen = []
    check = search._check
    search._check = lambda tree, q, x, own, queries, leaves, done: (seen.append(int((tree.leaf_at[leaves + 1] - tree.leaf_at[leaves]).sum())), check(tree, q, x, own, queries, leaves, done))
    search.visit(tree, np.full(20, -1))
    assert sum(seen) < 0.3 * 20 * 3000
    for i in range(20):
        s = x @ q[i]
        best = sorted(zip((-s).tolist(), range(3000)))[:5]
        mine = search.cell == i
        assert list(zip((-search.score[mine]).tolist(), search.ids[mine].tolist())) == best


def test_products_beyond_doubles():
    q, x = np.array([[2**53, 2**53, 3]]), np.array([[2**53, 2**53, 1], [2**10 + 1, 2**9 + 1, 1], [-2**53, -2**53, 7]])
    assert hn.products(q, x).tolist() == [[2**63 - 1, min(2**63 - 1, 2**53 * (2**10 + 2**9 + 2) + 3), -2**63]]
    p = np.array([2**62, -7, 0, 10, 11, 33, -1])
    assert hn.share(p, 30, True).tolist() == [-((-v * 30) // 100) for v in p.tolist()]
    assert hn.share(p, 90, False).tolist() == [v * 90 // 100 for v in p.tolist()]
