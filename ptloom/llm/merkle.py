"""Operator 12, Merkle dataset manifest: incremental witnesses over aligned blocks.

Every row is a leaf.  The leaves of a group, in order, are dealt to aligned
blocks of ``ARITY ** HEIGHT``; a task appends the leaves of one block to a
``Forest``, whose open subtrees hold the partial witnesses of the leaves
below them: a node that joins an open run extends the witness of every leaf
below its neighbours, and of its own leaves, by one digest.  The root of a
block is a further append one round up, where the block roots of a group are
appended in the same way until one node is left, and the nodes of the groups
are appended at last.  A leaf's witness is its own in the block, then that of
its block, and so on up to the root, joined on block numbers; no task sees more
than a block, and no row more than its path.

A digest is lowercase hex SHA-256 where it is an input or a result, and 32
bytes in between.  A witness is a chain of steps (place in the run, number of
others, their digests).

Cases: null fields are ``-``, so they differ from empty ones; null groups and
null ids come first; rows of one id are ordered by their leaves, and equal rows
are interchangeable, so each has its own place and witness; a group of one leaf
has that leaf as its node; an empty table gives no rows; texts of any length
are hashed inside the JVM; further columns, whatever their names, do not take part.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import rows
from ptloom.operators.joins import checked_broadcast
from ptloom.operators.ordered import join_null_safe, row_number_in_group

ARITY, HEIGHT = 3, 7
SIZE = 32


def combine(digests: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


class Forest:
    """Streaming append: the open runs by level, each node with its leaves' way up."""

    def __init__(self, arity: int = ARITY):
        self.arity, self.open, self.leaves = arity, [[]], []

    def append(self, digest: bytes) -> None:
        node = self._join(0, digest)
        self.leaves.append(node)
        self._close_full(0)

    def _join(self, level: int, digest: bytes) -> dict:
        """The node beside its earlier neighbours; they see it, and it sees them and all that follow, through their shared run."""
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        node = {"digest": digest, "run": run, "at": len(run), "up": None}
        run.append(node)
        return node

    def _close(self, level: int) -> None:
        run = self.open[level]
        self.open[level] = []
        parent = self._join(level + 1, combine([n["digest"] for n in run]))
        for n in run:
            n["up"] = parent

    def _close_full(self, level: int) -> None:
        while len(self.open[level]) == self.arity:
            self._close(level)
            level += 1

    def root(self, height: int | None = None) -> bytes:
        """Close the open runs from below: up to ``height``, or till one node is left."""
        level = 0
        while level < height if height is not None else any(self.open[level + 1:]) or len(self.open[level]) > 1:
            if level == len(self.open):
                raise ValueError("a block holds more leaves than its height allows")
            if self.open[level]:
                self._close(level)
            level += 1
        return self.open[level][0]["digest"]

    def witnesses(self) -> list[bytes]:
        """Of each leaf in order: its steps up to the node that is left."""
        known: dict[int, bytes] = {}

        def steps(node: dict) -> bytes:
            key = id(node)
            if key not in known:
                known[key] = b"" if node["up"] is None else (
                    bytes([node["at"], len(node["run"]) - 1]) + b"".join(n["digest"] for n in node["run"] if n is not node) + steps(node["up"]))
            return known[key]

        return [steps(n) for n in self.leaves]


def unpacked(witness: bytes):
    """The steps of a witness: place in the run and the others' digests, left to right."""
    i = 0
    while i < len(witness):
        at, n = witness[i], witness[i + 1]
        yield at, [witness[i + 2 + SIZE * j:i + 2 + SIZE * (j + 1)] for j in range(n)]
        i += 2 + SIZE * n


def fold(digest: bytes, witness: bytes) -> bytes:
    """The root that a leaf and a witness lead to."""
    for at, others in unpacked(witness):
        digest = combine([*others[:at], digest, *others[at:]])
    return digest


def proof_digest(witness: bytes) -> str:
    return hashlib.sha256("".join(d.hex() for _, others in unpacked(witness) for d in others).encode()).hexdigest()


def leaf(*fields: Column) -> Column:
    """SHA-256 (hex) of the fields: byte count, colon, value; a null is a dash."""
    return F.sha2(F.concat(*[
        F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in fields]), 256)


def _blocks(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """One round over nodes (g, pos, digest, ...): the nodes with ``block`` and ``witness``, and the blocks as nodes (g, pos, digest)."""
    size = ARITY ** height
    totals = checked_broadcast(nodes.groupBy("g").agg(F.count(F.lit(1)).alias("total")))
    dealt = join_null_safe(nodes.withColumn("block", F.floor(F.col("pos") / size)), totals, ["g"])
    kept = [c for c in dealt.columns if c != "total"]
    schema = T.StructType([*[dealt.schema[c] for c in kept], T.StructField("witness", T.BinaryType()), T.StructField("root", T.BinaryType())])

    def appended(part: pa.Table) -> pa.Table:
        part = part.sort_by("pos")
        forest = Forest()
        for d in part.column("digest").to_pylist():
            forest.append(d)
        root = forest.root(height if part.column("total")[0].as_py() > size else None)
        return rows.table(schema, columns=[*[part.column(c) for c in kept], forest.witnesses(), [root if i == 0 else None for i in range(len(part))]])

    got = rows.stored(dealt.groupBy("g", "block").applyInArrow(appended, schema))
    return got.drop("root"), got.where(F.col("root").isNotNull()).select("g", F.col("block").alias("pos"), F.col("root").alias("digest"))


def _rise(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """All rounds: the nodes with the witness up to their group's last node, and the groups' last nodes (g, digest)."""
    here, above = _blocks(nodes, height)
    if here.agg(F.max("block")).first()[0]:
        upper, tops = _rise(above, height)
        upper = checked_broadcast(upper.select("g", F.col("pos").alias("block"), F.col("witness").alias("upper")))
        here = join_null_safe(here, upper, ["g", "block"]).withColumn("witness", F.concat("witness", "upper")).drop("upper")
    else:
        tops = above.select("g", "digest")
    return here.drop("block"), tops


def manifest(leaves: DataFrame, group: str, order: str, *, digest: str = "leaf", height: int = HEIGHT) -> DataFrame:
    """``leaves`` with ``subroot`` and ``root`` (hex) and ``witness`` (binary) of each row.

    ``digest`` names the column of hex leaves; ``group`` and ``order`` place
    them.  Keep the table narrow: it is sorted.
    """
    src = leaves.select(F.col(group).alias("g"), F.col(order).alias("o"), F.unhex(digest).alias("digest"), F.struct(*leaves.columns).alias("row"))
    nodes = row_number_in_group(src, ["g"], ["o", "digest"], out_col="pos").withColumn("pos", F.col("pos") - 1).drop("o")
    here, tops = _rise(nodes, height)
    ranked = row_number_in_group(tops.withColumn("one", F.lit(0)), ["one"], ["g"], out_col="pos") \
        .select(F.col("one").alias("g"), F.col("pos") - 1, "digest", F.col("g").alias("name")).toDF("g", "pos", "digest", "name")
    groups, last = _rise(ranked, height)
    root = last.select(F.lower(F.hex("digest"))).first()
    groups = groups.select(F.col("name").alias("g"), F.lower(F.hex("digest")).alias("subroot"), F.col("witness").alias("upper"))
    full = join_null_safe(here, checked_broadcast(groups), ["g"])
    return full.select(F.col("row.*"), "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), F.concat("witness", "upper").alias("witness"))


def verified(df: DataFrame, leaf_col: str, witness: str = "witness", root: str = "root") -> DataFrame:
    """``df`` as struct ``row`` with ``res`` (proof_sha256, folded_root, verified): the leaf in ``leaf_col`` folded along its witness."""
    out = T.StructType([T.StructField("proof_sha256", T.StringType()), T.StructField("folded_root", T.StringType()), T.StructField("verified", T.BooleanType())])

    def run(texts, extra):
        folded = [fold(bytes.fromhex(x.decode()), w).hex() for x, w in zip(texts, extra["w"])]
        return {"proof_sha256": [proof_digest(w) for w in extra["w"]], "folded_root": folded, "verified": [a == b for a, b in zip(folded, extra["r"])]}

    return rows.map_texts(df, df[leaf_col].cast("binary"), run, out, extra={"w": df[witness], "r": df[root]})


def op12(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ident, text = F.col("doc_id"), F.col("text")
    tampered = F.when(F.crc32(ident.cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    leaves = docs.select("doc_id", "source", leaf(ident, F.col("source"), F.col("lang"), F.col("n_chars"), text).alias("leaf"),
                         leaf(ident, F.col("source"), F.col("lang"), F.col("n_chars"), tampered).alias("seen"))
    made = manifest(leaves, "source", "doc_id")
    got = verified(made, "seen")
    return got.select("row.doc_id", "row.leaf", "row.subroot", "row.root", "res.proof_sha256", "res.folded_root", "res.verified")


def _oracle(levels: int = 14, source_levels: int = 9) -> str:
    """Each level as a table of runs, and each leaf's walk through them; up to 3^14 leaves of a source and 3^9 sources."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END"
    h = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), text]) + ")"
    sql = [f"""crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
crc AS (
  SELECT DISTINCT doc_id AS cid, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(doc_id::VARCHAR)), lambda j: ascii((doc_id::VARCHAR)[j + 1])::BIGINT)),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS crc FROM documents, crc_table),
hashed AS (
  SELECT doc_id, source, {h(field('text'))} AS leaf, CASE WHEN crc % 2 = 0 THEN {h(field("replace(text, chr(10), '')"))} ELSE {h(field('text'))} END AS seen
  FROM documents LEFT JOIN crc ON doc_id IS NOT DISTINCT FROM cid),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
a0 AS (SELECT g, pos, leaf AS h FROM placed),
w0 AS (SELECT *, row_number() OVER () AS rid, seen AS cur, '' AS proof FROM placed)"""]

    def step(a: str, w: str, g: str, k: int) -> str:
        return f"""{a}r{k} AS (SELECT {g} AS g, p, n, list(h ORDER BY pos) AS hs FROM (SELECT *, pos // 3 AS p, count(*) OVER (PARTITION BY g) AS n FROM {a}{k}) GROUP BY 1, 2, 3),
{a}{k + 1} AS (SELECT g, p AS pos, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {a}r{k}),
{w}{k + 1} AS (
  SELECT x.* REPLACE (x.pos // 3 AS pos,
    CASE WHEN n = 1 THEN cur ELSE sha256(array_to_string(hs[:pos % 3], '') || cur || array_to_string(hs[pos % 3 + 2:], '')) END AS cur,
    CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(hs[:pos % 3], '') || array_to_string(hs[pos % 3 + 2:], '') END AS proof)
  FROM {w}{k} x JOIN {a}r{k} r ON {"x.g = r.g" if w == "w" else "r.g = 0"} AND x.pos // 3 = r.p)"""

    sql += [step("a", "w", "g", k) for k in range(levels)]
    sql.append(f"b0 AS (SELECT 0 AS g, g - 1 AS pos, h FROM a{levels})")
    sql.append(f"v0 AS (SELECT w.* REPLACE (w.g - 1 AS pos), a.h AS subroot FROM w{levels} w JOIN a{levels} a USING (g))")
    sql += [step("b", "v", "g", k) for k in range(source_levels)]
    return "WITH " + ",\n".join(sql) + f"""
SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = b.h AS verified FROM v{source_levels}, b{source_levels} b"""


ORACLE = _oracle()
