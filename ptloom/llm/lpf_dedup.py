"""Operator 3, exact substring deduplication by longest-previous-factor arrays.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id; texts are judged as they came in.

Suffixes that can share ``length`` bytes are brought together by anchors: of
the ``length - GRAM + 1`` grams of ``GRAM`` bytes in a window of ``length``
bytes, the one with the least hash (the first of them) is the window's anchor.  Equal
windows have equal anchors, and the windows with one anchor are consecutive, so they
make one *segment* of at most ``2 * length - GRAM`` bytes.

1. Cells of documents send their distinct anchors to buckets; a bucket
   answers with those that several documents hold.
2. Cells send the segments of shared anchors (compressed), equal ones once
   with their first document.  A bucket puts equal segments together, sorts the window
   suffixes of the distinct segments of an anchor, takes longest common
   prefixes of neighbours in that order, and with the previous and the next smaller document
   in suffix order the longest previous factor of each window start.  A factor of ``length``
   removes the window.
3. Cells apply the answers.

An anchor of more than ``HOT`` documents in all is dealt over buckets by window instead, each
window a segment of its own, so that a passage that very many documents hold in
many surroundings does not meet in one bucket.

Cases: null and empty texts, and texts below ``length`` bytes, lose nothing;
rows that share an id never remove from each other; a null id counts as the
greatest; repeats inside one document stay; an empty table gives none; extra
columns are carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import arrays, rows

LENGTH = 50
GRAM = 16
HOT = 20_000
_U8 = np.uint64


def anchors(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int):
    """Segments of the texts in ``text``: owner, start of the first window, number of windows, anchor hash."""
    reach = length - GRAM + 1
    n = len(text) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U8)
    at = np.arange(len(text) - GRAM + 1)
    h = arrays.span_hashes(text, at, at + GRAM)
    # least hash of each window of ``reach`` grams, by doubling
    low, width = h, 1
    while 2 * width <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < reach:
        low = np.minimum(low[: len(low) - (reach - width)], low[reach - width:])
    own = np.searchsorted(starts, np.arange(n), "right") - 1
    inside = np.arange(n) + length <= starts[own] + sizes[own]
    # a run of windows with one anchor at one place: where the least hash changes, or its first place leaves the window
    first = np.zeros(n, bool)
    first[0] = True
    first[1:] = (low[1:] != low[:-1]) | (h[: n - 1] == low[:-1]) | ~inside[:-1] | (own[1:] != own[:-1])
    begin = np.flatnonzero(first & inside)
    edge = np.flatnonzero(first | ~inside)
    stop = np.append(edge, n)[np.searchsorted(edge, begin, "right")]
    return own[begin], begin, stop - begin, low[begin]


def _segments(texts: list[bytes], length: int):
    """Segments of many texts: owner, start in the owner, windows, anchor, and content hash."""
    out = []
    for lo, hi in arrays.chunks(texts):
        part = texts[lo:hi]
        flat = np.frombuffer(b"".join(part), np.uint8)
        sizes = np.array([len(t) for t in part], np.int64)
        full = np.flatnonzero(sizes)
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        own, begin, windows, anchor = anchors(flat, starts[full], sizes[full], length)
        own = full[own] if len(own) else own
        content = arrays.span_hashes(flat, begin, begin + windows + length - 1)
        out.append((own + lo, begin - starts[own], windows, anchor, content))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, _U8)] * 2


_SENT = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("cell", T.IntegerType()), T.StructField("anchor", T.BinaryType()), T.StructField("docs", T.BinaryType())])
_SHARED = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("anchor", T.BinaryType()), T.StructField("hot", T.BinaryType())])
_SEGMENTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("cell", T.IntegerType())]
                         + [T.StructField(c, T.BinaryType()) for c in ("first", "size", "anchor", "bytes")])
_VERDICT = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("content", T.BinaryType()), T.StructField("least", T.BinaryType()), T.StructField("mask", T.BinaryType())])
RESULT = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])


def _send(n_buckets: int, length: int):
    def fn(t):
        ids = t.column("id").to_numpy()
        owner, _, _, anchor, _ = _segments(t.column("text").to_pylist(), length)
        order = np.lexsort((ids[owner], anchor))
        anchor, ident = anchor[order], ids[owner][order]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (ident[1:] != ident[:-1]))[: len(anchor)]
        anchor = anchor[new]
        start = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.zeros(0, np.int64)
        count = np.minimum(np.diff(np.append(start, len(anchor))), 65535).astype(np.uint16)
        cell = t.column("cell")[0].as_py()
        sent = rows.packed(rows.by_bucket(anchor[start], n_buckets), n_buckets, [anchor[start], count])
        return rows.table(_SENT, [(b, cell, *cols) for b, cols in sent])

    return fn


def _share(hot: int):
    def fn(t):
        cells = np.repeat(t.column("cell").to_numpy(), [len(x.as_py()) // 8 for x in t.column("anchor")])
        anchor, count = rows.joined(t.column("anchor").to_pylist(), _U8), rows.joined(t.column("docs").to_pylist(), np.uint16)
        order = np.argsort(anchor, kind="stable")
        anchor, count, cells = anchor[order], count[order].astype(np.int64), cells[order]
        start = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        total = np.repeat(np.add.reduceat(count, start), np.diff(np.append(start, len(anchor))))
        told = total > 1
        known, index = np.unique(cells[told], return_inverse=True)
        sent = rows.packed(index, len(known), [anchor[told], (total[told] > hot).astype(np.uint8)])
        return rows.table(_SHARED, [(int(known[i]), *cols) for i, cols in sent])

    return fn


def _wanted(texts: list[bytes], reply, length: int):
    """The segments of shared anchors (those of hot ones window by window): owner, start, windows, routing hash, content hash."""
    owner, start, windows, anchor, content = _segments(texts, length)
    shared, hot = (rows.joined(reply.column(c).to_pylist(), k) for c, k in (("anchor", _U8), ("hot", np.uint8)))
    order = np.argsort(shared)
    shared, hot = shared[order], hot[order]
    if not len(shared) or not len(owner):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(_U8), none.astype(_U8)
    at = np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)
    keep = shared[at] == anchor
    split = keep & (hot[at] > 0)
    plain = keep & ~split
    parts = [(owner[plain], start[plain], windows[plain], anchor[plain], content[plain])]
    if split.any():
        times = windows[split]
        own = np.repeat(owner[split], times)
        begin = np.repeat(start[split], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        h = np.concatenate([arrays.span_hashes(np.frombuffer(texts[o], np.uint8), begin[own == o], begin[own == o] + length) for o in np.unique(own).tolist()])
        parts.append((own, begin, np.ones(len(own), np.int64), h, h))
    return [np.concatenate(x) for x in zip(*parts)]


def _ask(n_buckets: int, length: int):
    def fn(docs, reply):
        texts, ids = docs.column("text").to_pylist(), docs.column("id").to_numpy()
        owner, start, windows, route, content = _wanted(texts, reply, length)
        order = np.lexsort((ids[owner], content))
        first = order[np.append(True, content[order][1:] != content[order][:-1])] if len(order) else order
        cell = docs.column("cell")[0].as_py()
        out = []
        bucket = rows.by_bucket(route[first], n_buckets)
        first = first[np.argsort(bucket, kind="stable")]
        bucket = np.sort(bucket, kind="stable")
        for b in np.unique(bucket).tolist():
            own = first[np.searchsorted(bucket, b, "left"):np.searchsorted(bucket, b, "right")]
            size = (windows[own] + length - 1).astype(np.uint16)
            data = b"".join(texts[o][s:s + n] for o, s, n in zip(owner[own].tolist(), start[own].tolist(), size.tolist()))
            out.append((b, cell, ids[owner[own]].tobytes(), size.tobytes(), route[own].astype(np.uint32).tobytes(), pa.compress(data, "zstd", asbytes=True)))
        return rows.table(_SEGMENTS, out)

    return fn


def previous_smaller(doc: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each rank the nearest rank before it of a smaller document (-1: none), and the common prefix with it.

    ``lcp[r]`` is the common prefix of ranks r - 1 and r.  All ranks jump at
    once: whatever lies between a rank and its present candidate is no
    smaller, so a candidate that is not smaller passes on its own one.
    """
    n = len(doc)
    cand, low = np.arange(n) - 1, lcp.copy()
    todo = np.flatnonzero((cand >= 0) & (low > 0))
    while True:
        todo = todo[(cand[todo] >= 0) & (low[todo] > 0)]
        todo = todo[doc[cand[todo]] >= doc[todo]]
        if not len(todo):
            break
        c = cand[todo]
        low[todo] = np.minimum(low[todo], low[c])
        cand[todo] = cand[c]
    return np.where(low > 0, cand, -1), np.where(cand >= 0, low, 0)


def longest_previous_factor(suffix: np.ndarray, group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Longest prefix of each row of bytes that a row of the same group and a smaller document has too."""
    n, length = suffix.shape
    if not n:
        return np.zeros(0, np.int64)
    wide = np.zeros((n, -(-length // 8) * 8), np.uint8)
    wide[:, :length] = suffix
    words = wide.view(">u8").astype(_U8)
    order = np.lexsort((*words.T[::-1], group))
    s, g, d = suffix[order], group[order], doc[order]
    lcp = np.zeros(n, np.int64)
    for lo in range(1, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        same = np.concatenate((s[lo:hi] == s[lo - 1:hi - 1], np.zeros((hi - lo, 1), bool)), axis=1)
        lcp[lo:hi] = np.where(g[lo:hi] == g[lo - 1:hi - 1], same.argmin(axis=1), 0)
    _, before = previous_smaller(d, lcp)
    # the next smaller one is the previous smaller one of the reversed order
    _, after = previous_smaller(d[::-1], np.concatenate(([0], lcp[:0:-1])))
    out = np.empty(n, np.int64)
    out[order] = np.maximum(before, after[::-1])
    return out


def _judge(length: int):
    def fn(t):
        sizes = [np.frombuffer(x, np.uint16) for x in t.column("size").to_pylist()]
        size = np.concatenate(sizes)
        cells = np.repeat(t.column("cell").to_numpy(), [len(x) for x in sizes])
        first, anchor = (rows.joined(t.column(c).to_pylist(), k) for c, k in (("first", np.int64), ("anchor", np.uint32)))
        texts = [pa.decompress(x, int(n.sum()), "zstd", asbytes=True) for x, n in zip(t.column("bytes").to_pylist(), sizes)]
        content = np.concatenate([arrays.span_hashes(np.frombuffer(x, np.uint8), (e := np.cumsum(n, dtype=np.int64)) - n, e) for x, n in zip(texts, sizes)])
        text = np.frombuffer(b"".join(texts), np.uint8)
        del texts
        begin = np.cumsum(size, dtype=np.int64) - size
        # equal segments are one, of their first document
        order = np.lexsort((first, content))
        start = np.flatnonzero(np.append(True, content[order][1:] != content[order][:-1]))
        lead = order[start]
        index = np.empty(len(order), np.int64)
        index[order] = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(order))))
        windows = size[lead].astype(np.int64) - length + 1
        mask = np.zeros(len(lead), _U8)
        # the suffixes of anchors with several distinct segments, a range of anchors at a time
        kinds, kind = np.unique(anchor[lead], return_inverse=True)
        several = np.bincount(kind)[kind] > 1
        todo = np.flatnonzero(several)
        todo = todo[np.argsort(kind[todo], kind="stable")]
        edges = np.flatnonzero(np.append(True, kind[todo][1:] != kind[todo][:-1])) if len(todo) else np.zeros(0, np.int64)
        upto = np.append(np.cumsum(windows[todo]) - windows[todo], windows[todo].sum())
        lo = 0
        edges = np.append(edges, len(todo))
        for e in range(1, len(edges)):
            if upto[edges[e]] - upto[lo] >= 200_000 or e == len(edges) - 1:
                own = todo[lo:edges[e]]
                seg = np.repeat(own, windows[own])
                offset = np.arange(len(seg)) - np.repeat(np.cumsum(windows[own]) - windows[own], windows[own])
                suffix = text[(begin[lead[seg]] + offset)[:, None] + np.arange(length)]
                long = longest_previous_factor(suffix, kind[seg], first[lead[seg]]) >= length
                np.bitwise_or.at(mask, seg[long], _U8(1) << offset[long].astype(_U8))
                lo = int(edges[e])
        # what later documents than the first lose of a segment is all of it; the first one loses the masked windows
        least, lost = first[lead][index], mask[index]
        told = (least < first) | (lost > 0)
        known, at = np.unique(cells[told], return_inverse=True)
        sent = rows.packed(at, len(known), [content[told], least[told], lost[told]])
        return rows.table(_VERDICT, [(int(known[i]), *cols) for i, cols in sent])

    return fn


def _apply(length: int, result: T.StructType):
    def fn(key, docs, extra):
        texts, ids = docs.column("text").to_pylist(), docs.column("id").to_numpy()
        reply = extra.filter(extra.column("anchor").is_valid())
        verdict = extra.filter(extra.column("content").is_valid())
        owner, start, windows, _, content = _wanted(texts, reply, length)
        known, least, mask = (rows.joined(verdict.column(c).to_pylist(), k) for c, k in (("content", _U8), ("least", np.int64), ("mask", _U8)))
        order = np.argsort(known)
        known, least, mask = known[order], least[order], mask[order]
        # the first document of a segment: here, unless the bucket knows an earlier one
        own_id = ids[owner]
        kinds, kind = np.unique(content, return_inverse=True)
        before = np.full(len(kinds), rows.NULL_ID)
        np.minimum.at(before, kind, own_id)
        lost = np.zeros(len(kinds), _U8)
        if len(known):
            at = np.minimum(np.searchsorted(known, kinds), len(known) - 1)
            hit = known[at] == kinds
            before, lost = np.where(hit, least[at], before), np.where(hit, mask[at], lost)
        out = []
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1)) if len(owner) and (np.diff(owner) >= 0).all() else None
        by_owner = None if bounds is not None else {o: np.flatnonzero(owner == o) for o in np.unique(owner).tolist()}
        for i, text in enumerate(texts):
            own = np.arange(bounds[i], bounds[i + 1]) if bounds is not None else by_owner.get(i, np.zeros(0, np.int64))
            gone = np.zeros(len(text) + 1, np.int32)
            for j in own.tolist():
                a, w = int(start[j]), int(windows[j])
                if before[kind[j]] < own_id[j]:
                    gone[a] += 1
                    gone[a + w + length - 1] -= 1
                elif lost[kind[j]]:
                    m = int(lost[kind[j]])
                    while m:
                        k = (m & -m).bit_length() - 1
                        gone[a + k] += 1
                        gone[a + k + length] -= 1
                        m &= m - 1
            if len(own):
                a, z = arrays.runs(np.cumsum(gone[:-1]) > 0)
                cuts = [0, *np.column_stack((a, z)).ravel().tolist(), len(text)]
                out.append((int((z - a).sum()), len(a), b"".join(text[cuts[j]:cuts[j + 1]] for j in range(0, len(cuts), 2))))
            else:
                out.append((0, 0, text))
        return rows.table(result, columns=[docs.column("row"), rows.table(RESULT, out).to_struct_array()])

    return fn


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT, row: list[str] | None = None) -> DataFrame:
    """Columns ``row`` and ``res``: bytes and spans removed, and the remaining bytes of each document."""
    if not GRAM < length <= 64 + GRAM - 1:
        raise ValueError("length must fit the window masks")
    n_cells, n_buckets = rows.parts(docs)
    cells = rows.in_cells(docs, id_col, text_col, n_cells, row)
    result = T.StructType([cells.schema["row"], T.StructField("res", RESULT)])
    sent = cells.groupBy("cell").applyInArrow(_send(n_buckets, length), _SENT)
    shared = rows.stored(sent.groupBy("bucket").applyInArrow(_share(hot), _SHARED))
    asked = cells.groupBy("cell").cogroup(shared.groupBy("cell")).applyInArrow(_ask(n_buckets, length), _SEGMENTS)
    verdict = asked.groupBy("bucket").applyInArrow(_judge(length), _VERDICT)
    none = F.lit(None).cast("binary")
    both = shared.select("cell", "anchor", "hot", none.alias("content"), none.alias("least"), none.alias("mask")) \
        .unionByName(verdict.select("cell", none.alias("anchor"), none.alias("hot"), "content", "least", "mask"))
    return cells.groupBy("cell").cogroup(both.groupBy("cell")).applyInArrow(_apply(length, result), result)


def op3(spark, sf_dir: str) -> DataFrame:
    """What is removed and kept of every whole text."""
    got = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), row=["doc_id"])
    return got.select("row.doc_id", (F.length("res.kept") + F.col("res.n_removed")).alias("n_bytes"), "res.n_removed", "res.n_spans",
                      F.sha2("res.kept", 256).alias("kept_sha256"))


def shorten(docs: DataFrame, *, text_col: str = "text", **kw) -> DataFrame:
    """The documents without the repeated strings (what is left of a cut character becomes U+FFFD)."""
    got = dedup(docs, text_col=text_col, **kw)
    cut = F.col("res.n_removed") > 0
    return got.select(*[F.when(cut, F.make_valid_utf8(F.col("res.kept").cast("string"))).otherwise(F.col(f"row.`{c}`")).alias(c) if c == text_col else F.col(f"row.`{c}`")
                        for c in docs.columns])
