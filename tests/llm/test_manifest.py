"""Operator 12 against a plain tree built level by level."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ptloom.llm import merkle

from .conftest import texts


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_tree(leaves):
    """The last node, and each leaf's list of (place, others)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i in range(len(leaves)):
            run, mine = level[at[i] // 3 * 3:at[i] // 3 * 3 + 3], at[i] % 3
            paths[i].append((mine, run[:mine] + run[mine + 1:]))
            at[i] //= 3
        level = [sha("".join(level[j:j + 3])) for j in range(0, len(level), 3)]
    return level[0], paths


def plain(rows):
    """rows: (order, group, leaf, seen) -> one result of each."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([r[2] for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[2]))]) for g in order}
    root, above = plain_tree([trees[g][0] for g in order])
    out = []
    for g, up in zip(order, above):
        for r, path in zip(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[2])), trees[g][1]):
            cur = r[3]
            for mine, others in path + up:
                cur = sha("".join([*others[:mine], cur, *others[mine:]]))
            out.append((r[0], r[2], trees[g][0], root, sha("".join(x for _, o in path + up for x in o)), cur, cur == root))
    return out


def key(r):
    return tuple(map(str, r))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 27, 28, 80])
def test_forest_is_the_plain_tree(n):
    forest = merkle.Forest()
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    for d in leaves:
        forest.append(d)
    root, paths = plain_tree([d.hex() for d in leaves])
    assert forest.root().hex() == root
    for d, w, path in zip(leaves, forest.witnesses(), paths):
        assert merkle.fold(d, w).hex() == root
        assert [(a, [o.hex() for o in others]) for a, others in merkle.unpacked(w)] == path


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest_over_blocks_of_several_heights(llm, height):
    rows = [(i if i % 11 else None, ["a", "b", None, "", "é"][min(i % 7, 4)], sha(str(i // 2)), sha(str(i))) for i in range(120)]
    df = llm.createDataFrame(rows, "doc_id long, source string, leaf string, seen string").repartition(7)
    got = merkle.verified(merkle.manifest(df, "source", "doc_id", height=height), "seen")
    mine = [tuple(r) for r in got.select("row.doc_id", "row.leaf", "row.subroot", "row.root", "res.*").collect()]
    want = plain(rows)
    # rows alike in id and leaf are interchangeable, their tampered leaves are not: compare what does not depend on which is which
    assert sorted((r[:5] for r in mine), key=key) == sorted((r[:5] for r in want), key=key)
    same = merkle.verified(merkle.manifest(df, "source", "doc_id", height=height), "leaf")
    assert {tuple(r) for r in same.select("res.verified", "row.root").collect()} == {(True, want[0][3])}


def test_leaves_and_tampering(llm, docs, none, tmp_path):
    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    table = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "s").when(F.col("doc_id") % 3 == 1, "t"))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op12(llm, str(tmp_path)).collect()
    rows = []
    for r in table.collect():
        seen = r.text
        if r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
            seen = r.text.replace("\n", "")
        rows.append((r.doc_id, r.source, *["".join([sha("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, x))))]) for x in (r.text, seen)]))
    assert sorted(map(tuple, got), key=key) == sorted(plain(rows), key=key)
    assert {r.verified for r in got} == {True, False} or all(a[2] == a[3] for a in rows)
    none.write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert merkle.op12(llm, f"{tmp_path}/empty").count() == 0
