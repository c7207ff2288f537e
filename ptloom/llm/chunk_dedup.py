"""Operator 5, substring deduplication by content-defined chunks.

A gear hash rolls over the last 16 bytes.  A text is cut before a word (or
a character of three or four bytes) where the hash is the least among the
``REACH`` possible cuts on either side.  So chunks are longer than
``REACH`` words, have no fixed places, and fall into step again right after an
insertion.  A chunk of more than ``LONG`` bytes (text without spaces, a run
of equal words) is cut again, before any character where the hash is least
within ``NEAR`` bytes; among equal values, as in a periodic run, at the first
and at each that lies ``2 * NEAR`` bytes after the last cut, so always at the
same phase of the period.  Chunks are known by a 64-bit digest.  A chunk whose digest an
earlier document (smaller id) holds is a copy; runs of copies of ``min_bytes``
or more are removed, the first document keeps them.

Each cell of documents sends its distinct digests, with the first holder, to
the buckets they fall into; a bucket answers with the first holder overall of
digests that several documents hold.  A digest that very many documents hold
is one entry per cell.

Cases: null and empty texts have no chunks and stay as they are; a null id
counts as the last; rows that share an id never remove from each other; ties cannot
arise, since the smaller id keeps; an empty table gives none; extra columns are
carried.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import arrays, rows

REACH = 3
#: bytes of a chunk beyond which it is cut before characters, where the hash is least within ``NEAR`` bytes on either side
LONG, NEAR = 256, 32
MIN_BYTES = 100
_WINDOW = 16
_GEAR = (arrays.mix(np.arange(256, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_GEAR[0] = 0


def inner_cuts(flat: np.ndarray, h: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Cuts before characters inside a long chunk."""
    far = np.iinfo(np.int64).max
    place = (flat[lo:hi] & 0xC0) != 0x80
    value = np.where(place, h[lo - 1:hi - 1], far)
    edge = np.full(NEAR, far)
    low = np.lib.stride_tricks.sliding_window_view(np.concatenate((edge, value, edge)), NEAR).min(axis=1)
    before, after = low[:hi - lo], low[NEAR + 1:]
    least = place & (value <= before) & (value <= after)
    least[0] = False
    out, last = [], 0
    for at, first in zip(np.flatnonzero(least).tolist(), (value < before)[least].tolist()):
        if first or at - last >= 2 * NEAR:
            out.append(lo + at)
            last = at
    return np.array(out, np.int64)


def chunk(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and end within the owner, and digest of every chunk, in order; the chunks of a text make it up."""
    pad = b"\0" * _WINDOW  # adds nothing to a gear hash, so no text feels the one before it
    flat = np.frombuffer(pad + b"".join(t + pad for t in texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(np.concatenate(([_WINDOW], sizes[:-1] + _WINDOW))) if len(texts) else np.zeros(0, np.int64)
    h = _GEAR[flat]
    for s in (1, 2, 4, 8):
        h[s:] += h[:-s] << np.uint32(s)
    place = (arrays.NOT_SPACE[flat[1:]] & ~arrays.NOT_SPACE[flat[:-1]]) | (flat[1:] >= 0xE3)
    at = np.flatnonzero(place) + 1  # a cut may lie before this byte
    own = np.searchsorted(begin, at, "right") - 1
    at, own = at[at > begin[own]], own[at > begin[own]]
    value = h[at - 1].astype(np.int64)
    gap = np.full(len(at) + 2 * REACH * len(texts), np.iinfo(np.int64).max)  # texts apart, REACH on either side
    spot = np.arange(len(at)) + REACH * (2 * own + 1)
    gap[spot] = value
    least = np.ones(len(at), bool)
    for j in range(1, REACH + 1):
        least &= (value < gap[spot - j]) & (value <= gap[spot + j])
    full = np.flatnonzero(sizes > 0)
    owner, starts, ends = _spans(np.concatenate((full, own[least])), np.concatenate((begin[full], at[least])), begin + sizes)
    long = np.flatnonzero(ends - starts > LONG)
    if len(long):
        more = [inner_cuts(flat, h, lo, hi) for lo, hi in zip(starts[long].tolist(), ends[long].tolist())]
        owner, starts, ends = _spans(np.concatenate((owner, np.repeat(owner[long], [len(x) for x in more]))), np.concatenate((starts, *more)), begin + sizes)
    return owner, starts - begin[owner], ends - begin[owner], arrays.span_hashes(flat, starts, ends)


def _spans(owner: np.ndarray, starts: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and end of the chunks that start there, in order."""
    order = np.argsort(starts, kind="stable")
    starts, owner = starts[order], owner[order]
    last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
    ends = np.where(last, text_ends[owner], np.append(starts[1:], 0)) if len(owner) else starts
    return owner, starts, ends


def _chunks(texts: list[bytes]):
    got = [chunk(texts[lo:hi]) for lo, hi in arrays.chunks(texts)]
    base = [lo for lo, _ in arrays.chunks(texts)]
    parts = [(o + b, s, e, d) for b, (o, s, e, d) in zip(base, got)]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]


_SENT = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("cell", T.IntegerType()), T.StructField("digests", T.BinaryType()),
                      T.StructField("first", T.BinaryType()), T.StructField("several", T.BinaryType())])
_REPLY = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("digests", T.BinaryType()), T.StructField("first", T.BinaryType())])


def _send(n_buckets: int):
    def fn(t):
        ids = t.column("id").to_numpy()
        owner, _, _, digest = _chunks(t.column("text").to_pylist())
        order = np.lexsort((ids[owner], digest))
        digest, ident = digest[order], ids[owner][order]
        first = np.flatnonzero(np.append(True, digest[1:] != digest[:-1])) if len(digest) else np.zeros(0, int)
        last = np.append(first[1:], len(digest)) - 1
        several = (ident[last] != ident[first]).astype(np.uint8)
        cell = t.column("cell")[0].as_py()
        sent = rows.packed(rows.by_bucket(digest[first], n_buckets), n_buckets, [digest[first], ident[first], several])
        return rows.table(_SENT, [(b, cell, *cols) for b, cols in sent])

    return fn


def _answer(t):
    cells = np.repeat(t.column("cell").to_numpy(), [len(x.as_py()) // 8 for x in t.column("digests")])
    digest, first, several = (rows.joined(t.column(c).to_pylist(), k) for c, k in (("digests", np.uint64), ("first", np.int64), ("several", np.uint8)))
    order = np.lexsort((first, digest))
    digest, first, several, cells = digest[order], first[order], several[order], cells[order]
    start = np.flatnonzero(np.append(True, digest[1:] != digest[:-1]))
    size = np.diff(np.append(start, len(digest)))
    least = np.repeat(first[start], size)
    told = (np.repeat(np.maximum.reduceat(first, start), size) > least) | (several > 0)
    told &= (first > least) | (several > 0)
    known, index = np.unique(cells[told], return_inverse=True)
    sent = rows.packed(index, len(known), [digest[told], least[told]])
    return rows.table(_REPLY, [(int(known[i]), *cols) for i, cols in sent])


def _apply(result, min_bytes: int):
    def fn(docs, reply):
        texts = docs.column("text").to_pylist()
        ids = docs.column("id").to_numpy()
        owner, start, end, digest = _chunks(texts)
        known, first = (rows.joined(reply.column(c).to_pylist(), k) for c, k in (("digests", np.uint64), ("first", np.int64)))
        order = np.argsort(known)
        known, first = known[order], first[order]
        copy = np.zeros(len(owner), bool)
        if len(known) and len(owner):
            at = np.minimum(np.searchsorted(known, digest), len(known) - 1)
            copy = (known[at] == digest) & (first[at] < ids[owner])
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        out = []
        for i, text in enumerate(texts):
            lo, hi = int(bounds[i]), int(bounds[i + 1])
            a, z = arrays.runs(copy[lo:hi])
            spans = [(int(start[lo + x]), int(end[lo + y - 1])) for x, y in zip(a, z)]
            spans = [s for s in spans if s[1] - s[0] >= min_bytes]
            cuts = [0, *(x for s in spans for x in s), len(text)]
            out.append((hi - lo, sum(z - a for a, z in spans), len(spans), b"".join(text[cuts[j]:cuts[j + 1]] for j in range(0, len(cuts), 2))))
        res = rows.table(RESULT, out).to_struct_array()
        return rows.table(result, columns=[docs.column("row"), res])

    return fn


RESULT = T.StructType([T.StructField("n_chunks", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                       T.StructField("kept", T.BinaryType())])


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, row: list[str] | None = None) -> DataFrame:
    """Columns ``row`` and ``res``: chunks, bytes and spans removed, and the remaining bytes of each document."""
    n_cells, n_buckets = rows.parts(docs)
    cells = rows.in_cells(docs, id_col, text_col, n_cells, row)
    result = T.StructType([cells.schema["row"], T.StructField("res", RESULT)])
    sent = cells.groupBy("cell").applyInArrow(_send(n_buckets), _SENT)
    reply = sent.groupBy("bucket").applyInArrow(_answer, _REPLY)
    return cells.groupBy("cell").cogroup(reply.groupBy("cell")).applyInArrow(_apply(result, min_bytes), result)


def op5(spark, sf_dir: str) -> DataFrame:
    """What is removed and kept of every whole text."""
    got = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), row=["doc_id"])
    return got.select("row.doc_id", "res.n_chunks", (F.length("res.kept") + F.col("res.n_removed")).alias("n_bytes"), "res.n_removed", "res.n_spans",
                      F.sha2("res.kept", 256).alias("kept_sha256"))


def shorten(docs: DataFrame, *, text_col: str = "text", **kw) -> DataFrame:
    """The documents without their copied spans; a document of which nothing but ASCII white space is left goes."""
    got = dedup(docs, text_col=text_col, **kw)
    cut = F.col("res.n_removed") > 0
    left = got.where(~cut | F.col("res.kept").cast("string").rlike(r"[^\x20\x09-\x0D]"))
    return left.select(*[F.when(cut, F.col("res.kept").cast("string")).otherwise(F.col(f"row.`{c}`")).alias(c) if c == text_col else F.col(f"row.`{c}`")
                         for c in docs.columns])
