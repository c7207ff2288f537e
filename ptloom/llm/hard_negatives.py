"""Operator 11, hard-negative mining: cover trees over norm-augmented candidates.

Vectors are quantised to integers and dealt, in order of their label, to blocks
of about ``BLOCK`` rows; each block gets its own tree, one row of the index.
A vector of norm |x| gets one more coordinate, sqrt(M^2 - |x|^2) with M the
greatest norm of the block, so that all lie on one sphere and the inner product with a
query (whose further coordinate is 0) is |q| M cos(angle).  The centres come
from a farthest-first traversal: each prefix of it covers the block within the
next centre's distance and is that far apart itself, so the centres of
a level are a prefix, nested and separated, and each has the nearest
one of the level above as its parent.  A node keeps the angle to its farthest descendant, the
covering radius of its level; with it |q| M cos(angle -/+ radius) bounds the
inner products below the node from both sides.

A search goes down level by level and leaves out nodes whose bounds lie outside
all windows of the query (or below the k-th score of each); of the leaves that are left it
visits the best first, in rounds, checks every row of them by exact integer products,
and drops what the better k-th scores exclude.  The positives are one search
(same label, no window), the negatives another (other label, a window for
each positive).  Queries are a stated set, packed in blocks of ``QUERIES``; for the
positives a block goes to the trees that hold one of its labels, for the negatives to all.
A task keeps the best k of the query blocks that it has open over all trees of
its shard, and a ranked window (limited before its shuffle) merges the shards.

On vectors without clusters in many dimensions the radii near a right angle bound nothing and every leaf is
checked, as products of small matrices: the result does not depend on it, the cost does.

Cases: rows with a null label, a null vector or a component that is null or
not finite take no part; a null vec_id is never an anchor and sorts last (and so does 2^63-1, which is read as null); repeated rows
are rows of their own, and all but the anchor's own row are other rows; vectors
of several lengths are filled up with zeros, and an empty vector scores 0; components
saturate at 2^53 and scores at the range of a long; ties go by vec_id; an empty table, an anchor
without a positive and a window without a row give nothing; a label that holds a third of all rows is dealt over
many trees; further columns, whatever their names, are left out.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import rows
from ptloom.llm.rows import NULL_ID

BLOCK, LEAF, BASE = 4096, 32, 1.2
QUERIES = 1024
#: query blocks whose best rows a task holds at a time
OPEN = 16
#: trees of a shard where there are many
SHARD_TREES = 32
EXACT = float(2**53)

TREE = T.StructType([
    T.StructField("tree", T.LongType()), T.StructField("dim", T.IntegerType()), T.StructField("width", T.IntegerType()),
    T.StructField("held", T.ArrayType(T.LongType())), T.StructField("ids", T.BinaryType()), T.StructField("labels", T.BinaryType()), T.StructField("points", T.BinaryType()),
    T.StructField("leaf_at", T.BinaryType()), T.StructField("centers", T.BinaryType()), T.StructField("sizes", T.BinaryType()), T.StructField("parents", T.BinaryType()), T.StructField("angles", T.BinaryType()),
])
QUERY = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("q_dim", T.IntegerType()), T.StructField("q_held", T.ArrayType(T.LongType())),
    *[T.StructField(c, T.BinaryType()) for c in ("q_tree", "q_at", "q_id", "q_label", "q_points", "p_id", "p_score")],
])
FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("a_tree", "a_at", "anchor_id", "place", "positive_id", "positive_score", "id", "score")])


# ---- one block

def grow(x: np.ndarray) -> dict:
    """The tree of a block: order of its points by leaf, leaf bounds, centres (in that order), level sizes, parents and angles by level."""
    n = len(x)
    norm2 = np.einsum("ij,ij->i", x, x)
    top = math.sqrt(norm2.max())
    y = np.column_stack([x, np.sqrt(np.maximum(top * top - norm2, 0))]) / (top or 1.0)
    far, owner = 1 - y @ y[0], np.zeros(n, np.int64)
    perm, gap = [0], [np.inf]
    while len(perm) < max(1, n // LEAF):
        c = int(far.argmax())
        if far[c] <= 1e-12:
            break
        gap.append(math.sqrt(2 * far[c]))
        d = 1 - y @ y[c]
        nearer = d < far
        far[nearer], owner[nearer] = d[nearer], len(perm)
        perm.append(c)
    gap, sizes = np.array(gap), [1]
    r = gap[1] if len(gap) > 1 else 0.0
    while sizes[-1] < len(perm):
        r /= BASE
        if (size := int((gap > r).sum())) > sizes[-1]:
            sizes.append(size)
    centres = y[perm]
    near = centres @ centres.T
    parents = [near[:b, :a].argmax(1) for a, b in zip(sizes, sizes[1:])]
    above, angles = owner, []
    for level in range(len(sizes) - 1, -1, -1):
        cos = np.ones(sizes[level])
        np.minimum.at(cos, above, np.einsum("ij,ij->i", y, centres[above]))
        angles.append(np.arccos(np.clip(cos, -1, 1)) + 1e-6)
        if level:
            above = parents[level - 1][above]
    order = np.argsort(owner, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return {"order": order, "leaf_at": np.searchsorted(owner[order], np.arange(len(perm) + 1)), "centers": place[perm], "sizes": np.array(sizes),
            "parents": np.concatenate([*parents, np.empty(0, np.int64)]), "angles": np.concatenate(angles[::-1])}


class Tree:
    def __init__(self, r: dict):
        self.ids, self.labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
        self.points = np.frombuffer(r["points"], f"i{r['width']}").reshape(len(self.ids), r["dim"]).astype(np.int64)
        self.values = self.points.astype(np.float64)
        self.top = math.sqrt(np.einsum("ij,ij->i", self.values, self.values).max())
        self.leaf_at, self.centers, sizes = (np.frombuffer(r[c], np.int64) for c in ("leaf_at", "centers", "sizes"))
        parents, angles = np.frombuffer(r["parents"], np.int64), np.frombuffer(r["angles"], np.float64)
        self.sizes = sizes.tolist()
        self.parents = [None, *np.split(parents, np.cumsum(sizes[1:])[:-1])] if len(sizes) > 1 else [None]
        self.angles = np.split(angles, np.cumsum(sizes)[:-1])


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors as int64: doubles where they suffice, else integers of any size, saturated."""
    if q.size == 0 or x.size == 0:
        return np.zeros((len(q), len(x)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < EXACT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    wide = q.astype(object) @ x.astype(object).T
    return np.array([[max(-2**63, min(2**63 - 1, v)) for v in row] for row in wide.tolist()], np.int64)


def share(p: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """``percent`` hundredths of integers, rounded up or down, without leaving the range of a long."""
    whole, rest = np.divmod(p, 100)
    return whole * percent + (-((-rest * percent) // 100) if up else rest * percent // 100)


class Search:
    """The best ``k`` rows of each window of each query of a block, over the trees seen so far.

    ``low`` and ``high`` hold a row for each query and a column for each of its windows.
    """

    def __init__(self, points: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.points, self.labels, self.low, self.high, self.k, self.same = points, labels, low, high, k, same
        self.values = points.astype(np.float64)
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.values, self.values))
        self.cell, self.score, self.ids = (np.empty(0, np.int64) for _ in range(3))
        self.least = low.copy()  # what a row needs at least: the window's end, later the k-th score

    def _wanted(self, ub: np.ndarray, lb: np.ndarray) -> np.ndarray:
        out = np.zeros(ub.shape, bool)
        for w in range(self.low.shape[1]):
            out |= (ub >= self.least[:, w, None]) & (lb <= self.high[:, w, None]) & (self.low[:, w] <= self.high[:, w])[:, None]
        return out

    def visit(self, tree: Tree, own: np.ndarray) -> None:
        """``own`` is each query's own row in this tree, -1 where it has none."""
        dim = max(self.points.shape[1], tree.points.shape[1])
        wide = lambda a: a if a.shape[1] == dim else np.pad(a, ((0, 0), (0, dim - a.shape[1])))
        q, x = wide(self.points), wide(tree.points)
        reach = (self.norms * tree.top)[:, None]
        with np.errstate(invalid="ignore", divide="ignore"):
            cos = np.where(reach > 0, wide(self.values) @ wide(tree.values)[tree.centers].T / reach, 0.0)
        angle, slack = np.arccos(np.clip(cos, -1, 1)), 1e-6 * reach + 1e-3
        bounds = lambda size, radius: (reach * np.cos(np.maximum(angle[:, :size] - radius, 0)) + slack, reach * np.cos(np.minimum(angle[:, :size] + radius, np.pi)) - slack)
        ub, lb = bounds(tree.sizes[-1], tree.angles[-1])
        done = np.zeros(ub.shape, bool)
        # the most promising leaf of each query first: its rows give the descent k-th scores to skip by
        first = np.where(self._wanted(ub, lb), ub, -np.inf)
        pick = first.argmax(1)
        at = np.flatnonzero(first[np.arange(len(q)), pick] > -np.inf)
        self._check(tree, q, x, own, at, pick[at], done)
        alive = self._wanted(*bounds(1, tree.angles[0]))
        for level in range(1, len(tree.sizes)):
            alive = alive[:, tree.parents[level]] & self._wanted(*bounds(tree.sizes[level], tree.angles[level]))
        take = 1
        while True:
            left = alive & ~done & self._wanted(ub, lb)
            if not left.any():
                return
            ranked = np.where(left, ub, -np.inf)
            best = np.argpartition(-ranked, min(take, ranked.shape[1]) - 1, axis=1)[:, :take]
            queries = np.repeat(np.arange(len(q)), best.shape[1])
            leaves = best.ravel()
            real = left[queries, leaves]
            self._check(tree, q, x, own, queries[real], leaves[real], done)
            take *= 2

    def _check(self, tree: Tree, q, x, own, queries: np.ndarray, leaves: np.ndarray, done: np.ndarray) -> None:
        """Exact scores of the rows of (query, leaf) pairs."""
        done[queries, leaves] = True
        order = np.argsort(leaves, kind="stable")
        queries, leaves = queries[order], leaves[order]
        cuts = np.flatnonzero(np.diff(leaves)) + 1
        got = [(self.cell, self.score, self.ids)]
        for qs, leaf in zip(np.split(queries, cuts), leaves[np.concatenate(([0], cuts))] if len(leaves) else []):
            a, b = int(tree.leaf_at[leaf]), int(tree.leaf_at[leaf + 1])
            s = products(q[qs], x[a:b])
            fits = (tree.labels[None, a:b] == self.labels[qs, None]) == self.same
            fits &= np.arange(a, b)[None] != own[qs, None]
            for w in range(self.low.shape[1]):
                i, j = np.nonzero(fits & (s >= self.least[qs, w, None]) & (s <= self.high[qs, w, None]))
                if len(i):
                    got.append((qs[i] * self.low.shape[1] + w, s[i, j], tree.ids[a + j]))
        if len(got) > 1:
            self._merge(*map(np.concatenate, zip(*got)))

    def _merge(self, cell, score, ids) -> None:
        order = np.lexsort((ids, ~score, cell))
        cell, score, ids = cell[order], score[order], ids[order]
        at = np.arange(len(cell)) - np.searchsorted(cell, cell)
        keep = at < self.k
        self.cell, self.score, self.ids = cell[keep], score[keep], ids[keep]
        full = at == self.k - 1
        self.least.reshape(-1)[cell[full]] = score[full]


# ---- over the table

def participants(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` of the rows that take part."""
    finite = lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False))
    return df.where(df[label].isNotNull() & F.forall(df[vector], finite)) \
        .select(df[vec_id].cast("long").alias("vec_id"), df[label].cast("long").alias("label"), df[vector].alias("vector"))


def quantised(vectors: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, rows filled up with zeros."""
    size = np.diff(np.asarray(vectors.offsets))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    with np.errstate(over="ignore"):
        out[np.arange(out.shape[1])[None] < size[:, None]] = np.clip(np.floor(scale * flat), -EXACT, EXACT).astype(np.int64)
    return out


def build(df: DataFrame, *, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """The index of ``participants``: one row (schema ``TREE``) for each block, stored."""
    spark = df.sparkSession
    n = df.count()
    parts = max(1, -(-n // (4 * block)), min(2 * spark.sparkContext.defaultParallelism, -(-n // 512)))
    dealt = df.repartitionByRange(parts, "label", F.xxhash64("vec_id", "vector"))

    def cut(batches):
        """Tables of half a block to one and a half, the last of a task maybe fewer."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= block + block // 2:
                part = pa.Table.from_batches(held)
                yield part.slice(0, block)
                held, size = part.slice(block).to_batches(), size - block
        if size:
            yield pa.Table.from_batches(held)

    def run(batches):
        from pyspark import TaskContext

        tree = TaskContext.get().partitionId() << 24
        for part in cut(batches):
            part = part.combine_chunks()
            vectors = part.column("vector").chunk(0)
            points = quantised(vectors, scale)
            ids = part.column("vec_id").fill_null(int(NULL_ID)).to_numpy()
            labels = part.column("label").to_numpy()
            made = grow(points.astype(np.float64))
            order = made.pop("order")
            most = int(np.abs(points).max(initial=0))
            width = 2 if most < 2**15 else 4 if most < 2**31 else 8
            yield rows.table(TREE, [(tree, points.shape[1], width, np.unique(labels).tolist(), ids[order].tobytes(), labels[order].tobytes(), points[order].astype(f"i{width}").tobytes(),
                                     *[made[c].astype(np.float64 if c == "angles" else np.int64).tobytes() for c in ("leaf_at", "centers", "sizes", "parents", "angles")])]).to_batches()[0]
            tree += 1

    return rows.stored(dealt.mapInArrow(run, TREE))


ANCHOR = T.StructType([*[T.StructField(c, T.LongType()) for c in ("a_tree", "a_at", "anchor_id", "label")], T.StructField("values", T.ArrayType(T.LongType()))])


def anchors(trees: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, with their place in the index."""

    def run(batches):
        for batch in rows.sliced(batches):
            for r in batch.to_pylist():
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                points = np.frombuffer(r["points"], f"i{r['width']}").reshape(len(ids), r["dim"])
                at = np.flatnonzero((ids % every == 0) & (ids != NULL_ID))
                yield from rows.table(ANCHOR, [(r["tree"], int(i), int(ids[i]), int(labels[i]), points[i].tolist()) for i in at]).to_batches()

    return trees.select("tree", "dim", "width", "ids", "labels", "points").mapInArrow(run, ANCHOR)


def _packed(queries: DataFrame, size: int) -> DataFrame:
    """Anchors with ``ps`` (array of struct of id and score) as blocks (schema ``QUERY``), in order of their label."""
    n = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["label", "a_tree", "a_at"]
    dealt = queries.repartitionByRange(n, *keys).sortWithinPartitions(*keys)

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in rows.sliced(batches):
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size).to_pydict()
                points = np.zeros((len(part["values"]), max(map(len, part["values"]))), np.int64)
                most = max(map(len, part["ps"]))
                p_id, p_score = (np.full((len(points), most), NULL_ID) for _ in range(2))
                known = np.zeros(p_id.shape, bool)
                for i, (v, ps) in enumerate(zip(part["values"], part["ps"])):
                    points[i, :len(v)] = v
                    for j, p in enumerate(ps):
                        p_id[i, j], p_score[i, j], known[i, j] = p["id"], p["score"], True
                col = lambda c: np.array(part[c], np.int64).tobytes()
                yield rows.table(QUERY, [(block, points.shape[1], sorted(set(part["label"])), col("a_tree"), col("a_at"), col("anchor_id"), col("label"), points.tobytes(),
                                          p_id.tobytes(), p_score.tobytes() + known.tobytes())]).to_batches()[0]
                block += 1

    return dealt.mapInArrow(run, QUERY)


def _searched(pairs: DataFrame, k: int, window: tuple[int, int] | None) -> DataFrame:
    """The best ``k`` rows that a task finds for each query of its pairs of query block and tree, and each window."""

    def opened(r: dict) -> tuple[Search, dict]:
        col = {c: np.frombuffer(r[c], np.int64) for c in ("q_tree", "q_at", "q_id", "q_label", "p_id")}
        n = len(col["q_id"])
        size = 8 * len(col["p_id"])
        col["p_score"] = np.frombuffer(r["p_score"][:size], np.int64)
        known = np.frombuffer(r["p_score"][size:], bool).reshape(n, -1)
        if window:
            score = col["p_score"].reshape(n, -1)
            low = np.where(known, share(score, window[0], True), NULL_ID)
            high = np.where(known, share(score, window[1], False), -NULL_ID)
        else:
            low, high = np.full((n, 1), -NULL_ID - 1), np.full((n, 1), NULL_ID)
        return Search(np.frombuffer(r["q_points"], np.int64).reshape(n, r["q_dim"]), col["q_label"], low, high, k, window is None), col

    def found(search: Search, col: dict) -> pa.RecordBatch:
        w = search.low.shape[1]
        q, place = search.cell // w, search.cell % w
        p = [col[c][search.cell] if window else np.zeros(len(q), np.int64) for c in ("p_id", "p_score")]
        return rows.table(FOUND, columns=[pa.array(x) for x in (col["q_tree"][q], col["q_at"][q], col["q_id"][q], place, *p, search.ids, search.score)]).to_batches()

    def run(batches):
        trees, searches = OrderedDict(), OrderedDict()
        for batch in rows.sliced(batches):
            for r in batch.to_pylist():
                if r["tree"] not in trees:
                    trees[r["tree"]] = Tree(r)
                    if len(trees) > SHARD_TREES:
                        trees.popitem(last=False)
                if r["block"] not in searches:
                    searches[r["block"]] = opened(r)
                    if len(searches) > OPEN:
                        yield from found(*searches.popitem(last=False)[1])
                search, col = searches[r["block"]]
                search.visit(trees[r["tree"]], np.where(col["q_tree"] == r["tree"], col["q_at"], -1))
        for s in searches.values():
            yield from found(*s)

    return pairs.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("a_tree", "a_at", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(df: DataFrame, *, every: int = 100, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), scale: int = 256,
         block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores, for ``participants`` as ``df``.

    ``window`` holds the hundredths of the positive's score between which a negative's lies.
    """
    trees = build(df, scale=scale, block=block)
    n_trees = max(trees.count(), 1)
    n_shards = max(min(n_trees, 64), -(-n_trees // SHARD_TREES))
    trees = trees.withColumn("shard", F.pmod(F.xxhash64("tree"), F.lit(n_shards)))
    asked = rows.stored(anchors(trees, every))

    held = trees.select("tree", "shard", F.explode("held").alias("label"))
    blocks = rows.stored(_packed(asked.withColumn("ps", F.array().cast("array<struct<id: bigint, score: bigint>>")), queries))
    ways = blocks.select("block", F.explode("q_held").alias("label")).join(held, "label").select("block", "tree", "shard").distinct()
    there = blocks.join(ways, "block").repartition(n_shards, "shard")
    pairs = there.join(trees.repartition(n_shards, "shard"), ["shard", "tree"])
    best = _ranked(_searched(pairs, positives, None), positives)
    best = best.groupBy("a_tree", "a_at").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("ps")) \
        .select("a_tree", "a_at", F.transform("ps", lambda p: F.struct(p["id"].alias("id"), p["score"].alias("score"))).alias("ps"))

    blocks = rows.stored(_packed(asked.join(best, ["a_tree", "a_at"]), queries))
    everywhere = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long")))).repartition(n_shards, "shard")
    pairs = everywhere.join(trees.repartition(n_shards, "shard"), "shard")
    got = _ranked(_searched(pairs, negatives, window), negatives)
    known = lambda c: F.when(F.col(c) != int(NULL_ID), F.col(c)).alias(c)
    return got.withColumnRenamed("id", "negative_id").select("anchor_id", known("positive_id"), F.col("rank").cast("int").alias("rank"), known("negative_id"),
                                                             "positive_score", F.col("score").alias("negative_score"))


def op11(spark, sf_dir: str) -> DataFrame:
    df = participants(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return mine(df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS rid
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, list_dot_product(a.v, e.v)::BIGINT AS s
  FROM e AS a, e WHERE a.vec_id % 100 = 0 AND a.rid <> e.rid),
p AS (SELECT *, row_number() OVER (PARTITION BY arid ORDER BY s DESC, vec_id NULLS LAST) AS k FROM s WHERE same QUALIFY k <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.arid, p.k ORDER BY s.s DESC, s.vec_id NULLS LAST)::INTEGER AS rank, s.vec_id AS negative_id,
  p.s AS positive_score, s.s AS negative_score
FROM p JOIN s ON p.arid = s.arid AND NOT s.same AND 30 * p.s <= 100 * s.s AND 100 * s.s <= 90 * p.s
QUALIFY rank <= 10
"""
