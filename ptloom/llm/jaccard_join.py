"""Operator 10, n-gram Jaccard join: size-aware, heavy and light.

A document's set holds its distinct word shingles.  Documents of equal sets
are a class; only classes are joined.

*Light* sets, of up to ``B`` shingles, list all subsets of the overlap that a
pair of two given sizes needs: sets of sizes a <= b link only if they share
``c = ceil(need * (a + b))`` shingles, so they meet at a key made of a, b
and the shared subset of size c.  *Heavy* sets meet in inverted lists: at a
threshold t two sets link only if they share one of their first
``n - ceil(t * n) + 1`` shingles in any order common to all sets, here rare
shingles first by a counting sketch of fixed size.  Sets that can partner with both
sides do both.  ``B`` minimises the estimated number of list entries plus
list scans, from the sizes and shingle counts that Spark has counted.

A list is never expanded to pairs.  First each list links its members to a
leader: within a task, then task leaders among each other, so a list of very
many members reaches its bucket as one entry per task.  The links are
verified on the whole sets and give components.  Then only lists that still
span several components matter: members outside a list's largest component
are compared with all members of other components.  A large list is dealt to cells of two
blocks of about ``BLOCK`` members, and a bucket compares the members of its cells in numpy, by size, by
place in the order and by parity bitmaps of about half a bit for each shingle, which bound how much two sets differ; only
pairs that pass leave the bucket and are verified on their whole sets, so texts that share lists but are not
similar write no pairs.  Any linked pair shares a list, so
it is either in one component already or compared here: no link between
components is lost.

Cases: null and empty texts, and texts of white space, have the empty set,
link with nothing and are their own component; texts of fewer words than a
shingle are one shingle; rows that share an id are documents of that id; a
null id never names a component that has another id; an empty table gives
none; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import arrays, rows

SHINGLE = 5
THRESHOLD = (80, 100)  # intersection * 100 >= union * 80
SLOTS = 1 << 22
_BLOCK = 1 << 15
MAX_LIGHT = 14
#: members of a block of a large list, and pairs that a bucket holds at a time
BLOCK, PAIRS = 1024, 1 << 20
_U8 = np.uint64


def overlap(a: int, b: int) -> int:
    """Shingles that sets of these sizes must share to link."""
    num, den = THRESHOLD
    return -(-num * (a + b) // (num + den))


def compatible(a: int, b: int) -> bool:
    return overlap(a, b) <= min(a, b)


class Sets:
    """The shingle sets of some texts: hashes sorted within each text, bounds, sizes and signatures."""

    def __init__(self, texts: list[bytes | None], k: int = SHINGLE):
        words = arrays.Words(texts, arrays.NOT_SPACE, lower=True)
        first, h = words.windows(k)
        own = words.owner[first]
        for short in range(1, k):
            f, g = words.windows(short)
            whole = words.counts[words.owner[f]] == short
            own, h = np.concatenate((own, words.owner[f[whole]])), np.concatenate((h, g[whole]))
        order = np.lexsort((h, own))
        own, h = own[order], h[order]
        new = np.append(True, (h[1:] != h[:-1]) | (own[1:] != own[:-1]))[: len(h)]
        self.owner, self.hashes = own[new], h[new]
        self.bounds = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        self.sizes = np.diff(self.bounds)
        total = np.zeros(len(self.hashes) + 1, _U8)
        np.cumsum(arrays.mix(self.hashes ^ _U8(0x5851F42D4C957F2D)), out=total[1:])
        self.sig = arrays.mix(total[self.bounds[1:]] - total[self.bounds[:-1]] + self.sizes.astype(_U8))


    def bitmaps(self) -> list[bytes]:
        """Per set the parity of its shingles in each of a power of two of places, about half as many as shingles."""
        places = 1 << np.clip(np.ceil(np.log2(np.maximum(self.sizes, 1) / 2)), 6, 12).astype(np.int64)
        begin = np.cumsum(places) - places
        spot = begin[self.owner] + ((self.hashes >> _U8(20)).astype(np.int64) & (places[self.owner] - 1))
        odd = np.packbits(np.bincount(spot, minlength=int(places.sum())).astype(np.uint8) & 1, bitorder="little")
        return [odd[b // 8:(b + n) // 8].tobytes() for b, n in zip(begin.tolist(), places.tolist())]


def _digest(text):
    """SHA-256 of a text; null has one of its own."""
    return F.coalesce(F.sha2(text.cast("binary"), 256), F.lit(""))


def members(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``sig`` (the class; null for the empty set) and ``bits``, a row for each document; its text's ``digest`` if asked for."""
    def fn(texts, _):
        parts = [Sets(texts[lo:hi]) for lo, hi in arrays.chunks(texts)]
        sizes = np.concatenate([np.zeros(0, np.int64), *(p.sizes for p in parts)])
        sig = np.concatenate([np.zeros(0, _U8), *(p.sig for p in parts)]).view(np.int64)
        return {"n": sizes, "sig": pa.array(sig, mask=sizes == 0), "bits": [x for p in parts for x in p.bitmaps()]}

    names = ["doc_id", "digest"] if digest else ["doc_id"]
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), *([_digest(docs[text_col]).alias("digest")] if digest else []))
    got = rows.map_texts(src, "text", fn, T.StructType([T.StructField("n", T.LongType()), T.StructField("sig", T.LongType()), T.StructField("bits", T.BinaryType())]), row=names)
    return got.select(*[f"row.{c}" for c in names], F.col("res.n").alias("n_shingles"), "res.sig", "res.bits")


def sketch(texts: DataFrame) -> np.ndarray:
    """Counters of all shingles by hash, and as last block the numbers of sets of each small size; of fixed size."""
    n_blocks = SLOTS // _BLOCK + 1

    def count(batches):
        total = np.zeros(n_blocks * _BLOCK, np.uint32)
        for batch in rows.sliced(batches):
            part = batch.column(0).to_pylist()
            for lo, hi in arrays.chunks(part):
                s = Sets(part[lo:hi])
                np.add.at(total, (s.hashes & _U8(SLOTS - 1)).astype(np.int64), 1)
                total[SLOTS:] += np.bincount(np.minimum(s.sizes, _BLOCK - 1), minlength=_BLOCK).astype(np.uint32)
        for b in range(n_blocks):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([total[b * _BLOCK:(b + 1) * _BLOCK].tobytes()], pa.binary())], names=["block", "counts"])

    def add(batches):  # one row at a time: memory does not grow with the number of tasks
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[b] = held.get(b, 0) + np.frombuffer(c, np.uint32).astype(np.int64)
        for b, c in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([c.tobytes()], pa.binary())], names=["block", "counts"])

    kind = "block int, counts binary"
    out = np.zeros(n_blocks * _BLOCK, np.int64)
    got = texts.mapInArrow(count, kind).repartition(rows.parts(texts)[1], "block").mapInArrow(add, kind).toArrow()  # of fixed size, in one job
    for b, c in zip(got.column(0).to_pylist(), got.column(1)):
        out[b * _BLOCK:(b + 1) * _BLOCK] = np.frombuffer(c.as_buffer(), np.int64)
    return out


def _subset_sizes(n: int, b: int) -> list[tuple[int, int, int]]:
    """Keys (a, b, subset size) under which a light set of size n meets other light sets."""
    return [(min(n, m), max(n, m), overlap(n, m)) for m in range(1, b + 1) if compatible(n, m)]


def boundary(counts: np.ndarray) -> int:
    """Size up to which sets are light: least estimated list entries plus scanned list members."""
    shingles, sizes = counts[:SLOTS].astype(float), counts[SLOTS:]
    total = max(shingles.sum(), 1.0)
    length = max(1.0, float((shingles**2).sum() / total - total / SLOTS))  # of the list that a shingle is in, without the sketch's noise
    best, cost = 0, None
    for b in range(MAX_LIGHT + 1):
        light = sum(int(sizes[n]) * sum(comb(n, c) for _, _, c in _subset_sizes(n, b)) for n in range(1, b + 1))
        heavy = sum(int(sizes[n]) * (n // 5 + 1) * (1 + length) for n in range(1, MAX_LIGHT + 3) if n * 5 > b * 4)
        if cost is None or light + heavy < cost:
            best, cost = b, light + heavy
    return best


def keys(s: Sets, counts: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """List entries: key, index of the set, rank (the least rank leads a list), and place of a shingle in the order."""
    out_key, out_set, out_rank, out_place = [np.zeros(0, _U8)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.uint16)]
    # heavy: the rarest shingles; sets of common shingles lead, as they are the ones that edited copies derive from
    seen = counts[(s.hashes & _U8(SLOTS - 1)).astype(np.int64)]
    order = np.lexsort((s.hashes, seen, s.owner))
    place = np.arange(len(order)) - s.bounds[s.owner]
    num, den = THRESHOLD
    prefix = s.sizes - -(-num * s.sizes // den) + 1
    take = (place < prefix[s.owner]) & (s.sizes[s.owner] * den > b * num)
    common = arrays.sum_by(np.log2(1.0 + seen), s.bounds) / np.maximum(s.sizes, 1)
    out_key.append(arrays.mix(s.hashes[order][take] ^ _U8(0x2545F4914F6CDD1D)))
    out_set.append(s.owner[take])
    out_place.append(np.minimum(place[take], 65535).astype(np.uint16))
    out_rank.append((65535 - np.minimum(common * 1000, 65535)).astype(np.uint16)[s.owner[take]])
    # light: sums of the hashes of all subsets of the needed size, by what they leave out
    element = arrays.mix(s.hashes ^ _U8(0x14057B7EF767814F))
    for n in range(1, b + 1):
        sets = np.flatnonzero(s.sizes == n)
        if not len(sets):
            continue
        rows_ = element[s.bounds[sets][:, None] + np.arange(n)]
        total = rows_.sum(axis=1, dtype=_U8)
        for lo, hi, c in _subset_sizes(n, b):
            out = np.array(list(combinations(range(n), n - c)), np.int64).reshape(comb(n, c), n - c)
            key = arrays.mix((total[:, None] - rows_[:, out].sum(axis=2, dtype=_U8)) + _U8(lo * 1_000_003 + hi * 97 + 1)).ravel()
            out_key.append(key)
            out_set.append(np.repeat(sets, len(out)))
            out_rank.append(np.full(len(key), n, np.uint16))
            out_place.append(np.zeros(len(key), np.uint16))
    return np.concatenate(out_key), np.concatenate(out_set), np.concatenate(out_rank), np.concatenate(out_place)


def _lead(key: np.ndarray, rank: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, rank and signature; and for each ordered entry the position of its list's leader."""
    order = np.lexsort((sig, rank, key))
    k = key[order]
    start = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return order, np.repeat(start, np.diff(np.append(start, len(k))))


_ENTRIES = T.StructType([T.StructField("bucket", T.IntegerType())] + [T.StructField(c, T.BinaryType()) for c in ("key", "sig", "n", "place", "rank", "led")])
_LISTS = T.StructType([T.StructField("list", T.LongType()), T.StructField("sig", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("place", T.IntegerType()),
                       T.StructField("leader", T.LongType()),
                       T.StructField("leader_n", T.IntegerType())])


def lists(texts: DataFrame, counts: np.ndarray, b: int) -> DataFrame:
    """Lists of two sets or more: ``list``, ``sig``, ``n``, ``place`` and the leader that each member is compared with."""
    n_buckets = rows.parts(texts)[1]
    shared = texts.sparkSession.sparkContext.broadcast(np.minimum(counts[:SLOTS], 2**32 - 1).astype(np.uint32))

    def emit(batches):
        held = [[np.zeros(0, _U8)], [np.zeros(0, _U8)], *([np.zeros(0, np.uint16)] for _ in range(3))]
        seen: set[int] = set()

        def send():
            key, sig, n, rank, place = (np.concatenate(h) for h in held)
            for h in held:
                del h[1:]
            seen.clear()
            order, lead = _lead(key, rank, sig)
            key, sig, n, rank, place = key[order], sig[order], n[order], rank[order], place[order]
            own = np.arange(len(key)) == lead
            several = np.bincount(lead, minlength=len(lead))[lead] > 1
            led = np.where(own, np.where(several, 1, 0), 2).astype(np.uint8)
            # a leader goes to its list's bucket, 1 if it has followers here; followers' rows go anywhere, with their leader
            bucket = np.where(own, rows.by_bucket(key, n_buckets), rows.by_bucket(sig, n_buckets))
            lead_col = np.where(own, rank.astype(_U8), sig[lead])
            n_col = np.where(own, n.astype(np.uint32), (n.astype(np.uint32) << np.uint32(16)) | n[lead].astype(np.uint32))
            for at, cols in rows.packed(bucket, n_buckets, [key, sig, n_col, place, led]):
                part = bucket == at
                follower = led[part] == 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int32()), pa.array([cols[0]]), pa.array([cols[1]]), pa.array([cols[2]]), pa.array([cols[3]]),
                     pa.array([rank[part][~follower].tobytes() + lead_col[part][follower].tobytes()]), pa.array([cols[4]])], names=_ENTRIES.names)

        size = 0
        for batch in rows.sliced(batches):
            part = batch.column(0).to_pylist()
            for lo, hi in arrays.chunks(part):
                s = Sets(part[lo:hi])
                key, own, rank, place = keys(s, shared.value, b)
                new = np.zeros(len(s.sig), bool)
                for i, x in enumerate(s.sig.tolist()):
                    if x not in seen:
                        seen.add(x)
                        new[i] = True
                keep = new[own]
                for h, x in zip(held, (key[keep], s.sig[own[keep]], np.minimum(s.sizes[own[keep]], 65535).astype(np.uint16), rank[keep], place[keep])):
                    h.append(x)
                size += int(keep.sum())
                if size > 1_000_000:
                    yield from send()
                    size = 0
        yield from send()
        pa.default_memory_pool().release_unused()

    def meet(t):
        led = rows.joined(t.column("led").to_pylist(), np.uint8)
        key, sig, n, place = (rows.joined(t.column(c).to_pylist(), k) for c, k in (("key", _U8), ("sig", _U8), ("n", np.uint32), ("place", np.uint16)))
        ranks, leaders = [np.zeros(0, np.uint16)], [np.zeros(0, _U8)]
        for blob, flags in zip(t.column("rank").to_pylist(), t.column("led").to_pylist()):
            k = 2 * int((np.frombuffer(flags, np.uint8) != 2).sum())
            ranks.append(np.frombuffer(blob[:k], np.uint16))
            leaders.append(np.frombuffer(blob[k:], _U8))
        follow = led == 2
        out = [(key[follow], sig[follow], n[follow] >> np.uint32(16), place[follow], np.concatenate(leaders), n[follow] & np.uint32(0xFFFF))]
        key, sig, n, place, led, rank = key[~follow], sig[~follow], n[~follow], place[~follow], led[~follow], np.concatenate(ranks)
        order, lead = _lead(key, rank, sig)
        key, sig, n, place, led = key[order], sig[order], n[order], place[order], led[order]
        # one entry for each set: tasks may have sent the same set
        new = np.append(True, (key[1:] != key[:-1]) | (sig[1:] != sig[:-1]))[: len(key)]
        distinct = np.bincount(lead, weights=new, minlength=len(lead))[lead] > 1
        any_led = np.bincount(lead, weights=led, minlength=len(lead))[lead] > 0
        keep = new & (distinct | any_led)
        out.append((key[keep], sig[keep], n[keep], place[keep], sig[lead][keep], n[lead][keep]))
        key, sig, n, place, leader, leader_n = (np.concatenate(x) for x in zip(*out))
        return rows.table(_LISTS, columns=[key.view(np.int64), sig.view(np.int64), n.astype(np.int32), place.astype(np.int32), leader.view(np.int64), leader_n.astype(np.int32)])

    return texts.mapInArrow(emit, _ENTRIES).groupBy("bucket").applyInArrow(meet, _LISTS)


FILTER_BITS = 1 << 26


def _bloom(ids: DataFrame) -> np.ndarray:
    """Bitmap of ``FILTER_BITS`` bits of the ids: of fixed size, so more ids only let more documents pass."""
    part = 1 << 15
    spot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = ids.select(spot.alias("spot")).groupBy(F.shiftright("spot", 15).alias("block")).agg(F.collect_set((F.col("spot") % part).cast("int")).alias("at"))

    def pack(batches):
        for batch in batches:
            out = []
            for at in batch.column(1):
                bits = np.zeros(part, np.uint8)
                bits[at.values.to_numpy()] = 1
                out.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["block", "bits"])

    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    got = words.mapInArrow(pack, "block long, bits binary").toArrow()  # of fixed size, in one job
    for b, x in zip(got.column(0).to_pylist(), got.column(1)):
        bits[b * part // 8:(b + 1) * part // 8] = np.frombuffer(x.as_buffer(), np.uint8)
    return bits


def whole_sets(docs: DataFrame, wanted: DataFrame, classes: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """``sig`` and ``hashes`` (packed, sorted) of the wanted classes, from their documents of least id.

    A bitmap of fixed size keeps most other documents from being read into sets at all.
    """
    ids = classes.join(wanted, "sig", "left_semi").select(F.coalesce("least", F.lit(int(rows.NULL_ID))).alias("id"))
    shared = docs.sparkSession.sparkContext.broadcast(_bloom(ids))
    ident = F.coalesce(docs[id_col].cast("long"), F.lit(int(rows.NULL_ID)))
    src = docs.select(F.pmod(F.xxhash64(ident), F.lit(FILTER_BITS)).alias("spot"), docs[text_col].cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            spot = batch.column(0).to_numpy()
            batch = batch.filter(pa.array((shared.value[spot >> 3] >> (spot & 7)) & 1 == 1, pa.bool_()))
            for piece in rows.sliced([batch]):
                s = Sets(piece.column(1).to_pylist())
                hashes = [s.hashes[a:z].tobytes() for a, z in zip(s.bounds[:-1].tolist(), s.bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(s.sig.view(np.int64)), pa.array(hashes, pa.binary())], names=["sig", "hashes"])

    return src.mapInArrow(run, "sig long, hashes binary").join(wanted, "sig", "left_semi").dropDuplicates(["sig"])


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose bitmaps do not rule out a link: each place where they differ is a shingle that only one set has."""
    both = pairs.join(classes.select(F.col("sig").alias("a"), F.col("n_shingles").alias("n"), F.col("bits").alias("x")), "a") \
        .join(classes.select(F.col("sig").alias("b"), F.col("n_shingles").alias("m"), F.col("bits").alias("y")), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for n, x, m, y in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4).to_pylist(), batch.column(5)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
                size = min(len(x), len(y))
                differ = np.bitwise_xor.reduce(np.concatenate((x, y)).reshape(-1, size), axis=0)
                keep.append(int(np.bitwise_count(differ).sum()) <= n + m - 2 * overlap(n, m) and compatible(n, m))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "n", "x", "m", "y").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose whole sets reach the threshold."""
    num, den = THRESHOLD
    both = pairs.join(sets.select(F.col("sig").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("sig").alias("b"), F.col("hashes").alias("y")), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), _U8) for v in (x, y))
                shared = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
                keep.append(den * shared >= num * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _size_fits(a: str, b: str):
    """Sizes can link; a size of 65535 stands for that or more."""
    num, den = THRESHOLD
    small, large = F.least(a, b).cast("long"), F.greatest(a, b).cast("long")
    return (large * num <= small * den) | (large == 65535)


def components(edges: DataFrame) -> DataFrame:
    """``sig`` and ``root``, the least of its component, by alternating large and small stars."""
    def settled(e):  # stars only: each node is below one other at most, and that one below none
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(e.select("v", F.lit(0), F.lit(1)))
        return ends.groupBy("x").agg(F.sum("below").alias("b"), F.max("above").alias("a")).where("b > 1 OR (b = 1 AND a = 1)").isEmpty()

    def hub(e):  # the least of each node and its neighbours
        return e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))

    e = rows.stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not settled(e):
        sym = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = sym.join(hub(sym), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = hub(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = rows.stored(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    return e.select(F.col("u").alias("sig"), F.col("v").alias("root")).union(e.select(F.col("v").alias("sig"), F.col("v").alias("root")).distinct())


def _fits(n: np.ndarray, place: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the members ``a`` and ``b`` can link by their sizes, and by what is left of their sets behind the places where they meet first."""
    num, den = THRESHOLD
    x, y, total = n[a], n[b], num * (n[a] + n[b])
    reach = ((x - place[a]) * (num + den) >= total) & ((y - place[b]) * (num + den) >= total)
    return (num * np.maximum(x, y) <= den * np.minimum(x, y)) & (reach | (np.maximum(place[a], place[b]) == 65535))


class Bitmaps:
    """Parity bitmaps of some sets; those of two sizes, one double the other, are compared at the smaller size."""

    def __init__(self, bits: list[bytes]):
        self.size = np.array([len(x) for x in bits], np.int64)
        self.row, self.at_size = np.zeros(len(bits), np.int64), {}
        for size in np.unique(self.size).tolist():
            own = np.flatnonzero(self.size == size)
            self.row[own] = np.arange(len(own))
            self.at_size[size] = np.frombuffer(b"".join(bits[i] for i in own.tolist()), np.uint8).reshape(len(own), size)
        self.half = {size // 2: x[:, :size // 2] ^ x[:, size // 2:] for size, x in self.at_size.items()}

    def _at(self, size: int, sets: np.ndarray) -> np.ndarray:
        """The bitmaps of the sets at this size, of sets of this or the double one."""
        out = np.empty((len(sets), size), np.uint8)
        whole = self.size[sets] == size
        out[whole] = self.at_size[size][self.row[sets[whole]]]
        if not whole.all():
            out[~whole] = self.half[size][self.row[sets[~whole]]]
        return out

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places in which the bitmaps of each pair differ; 0 where their sizes are further apart."""
        out = np.zeros(len(a), np.int64)
        low, high = np.minimum(self.size[a], self.size[b]), np.maximum(self.size[a], self.size[b])
        for size in np.unique(low).tolist():
            pairs = np.flatnonzero((low == size) & (high <= 2 * size))
            step = max(1, (8 << 20) // size)
            for i in range(0, len(pairs), step):
                part = pairs[i:i + step]
                out[part] = np.bitwise_count(self._at(size, a[part]) ^ self._at(size, b[part])).sum(axis=1, dtype=np.int64)
        return out


def _compare(t):
    """Pairs ``a``, ``b`` of the cells of a bucket that sizes, places and bitmaps do not rule out."""
    num, den = THRESHOLD
    col = {c: t.column(c).to_numpy() for c in ("list", "few", "x", "y", "block", "sig", "n_shingles", "place", "root")}
    inner = col["few"] & (col["x"] == col["y"])  # both sides of these cells are the same block
    right = np.where(col["few"], col["block"] != col["x"], t.column("is_main").to_numpy()) & ~inner
    order = np.lexsort((right, col["y"], col["x"], col["few"], col["list"]))
    col, inner, right = {c: x[order] for c, x in col.items()}, inner[order], right[order]
    bitmaps = Bitmaps(t.column("bits").take(pa.array(order)).to_pylist())
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in ("list", "few", "x", "y"):
        new[1:] |= col[c][1:] != col[c][:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(order)))
    n_right = np.add.reduceat(right.astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    n_left = size - n_right
    same = inner[start]
    right_at = np.where(same, start, start + n_left)
    n_right = np.where(same, n_left, n_right)
    left = np.flatnonzero(~right)
    cell = np.cumsum(new)[left] - 1
    count = n_right[cell]
    n, place = col["n_shingles"].astype(np.int64), col["place"].astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    total = np.cumsum(count)
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS, "right")))
        k = count[lo:hi]
        a = np.repeat(left[lo:hi], k)
        b = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + np.repeat(right_at[cell[lo:hi]], k)
        keep = (col["root"][a] != col["root"][b]) & (~inner[a] | (a < b)) & _fits(n, place, a, b)
        a, b = a[keep], b[keep]
        need = -(-num * (n[a] + n[b]) // (num + den))
        keep = (need <= np.minimum(n[a], n[b])) & (bitmaps.differ(a, b) <= n[a] + n[b] - 2 * need)
        found.append((col["sig"][a[keep]], col["sig"][b[keep]]))
        lo = hi
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    pairs = np.unique(np.column_stack((np.minimum(a, b), np.maximum(a, b))), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def across(mixed: DataFrame, classes: DataFrame, n_buckets: int, block: int = BLOCK) -> DataFrame:
    """Pairs ``a``, ``b`` of members (list, sig, place, root) of one list in different components, that sizes, places and bitmaps allow."""
    sizes = mixed.groupBy("list", "root").agg(F.count(F.lit(1)).alias("k")).groupBy("list").agg(
        F.max_by("root", F.struct("k", "root")).alias("main"), F.max("k").alias("n_main"), F.sum("k").alias("n_all"))
    m = mixed.join(sizes, "list").withColumn("is_main", F.col("root") == F.col("main"))
    blocks = lambda k: F.greatest(F.ceil(k / block), F.lit(1)).cast("int")
    m = m.withColumn("n_few", blocks(F.col("n_all") - F.col("n_main"))).withColumn("n_main", blocks(F.col("n_main")))
    m = m.withColumn("block", F.pmod(F.xxhash64("sig"), F.when(F.col("is_main"), F.col("n_main")).otherwise(F.col("n_few"))).cast("int"))
    cell = lambda few, x, y: F.struct(F.lit(few).alias("few"), x.cast("int").alias("x"), y.cast("int").alias("y"))
    upto = lambda k: F.sequence(F.lit(0), k - 1)
    own = F.col("block")
    cells = F.when(F.col("is_main"), F.transform(upto(F.col("n_few")), lambda k: cell(False, k, own))).otherwise(F.concat(
        F.transform(upto(F.col("n_few")), lambda k: cell(True, F.least(k, own), F.greatest(k, own))), F.transform(upto(F.col("n_main")), lambda k: cell(False, own, k))))
    m = m.select("list", "sig", "place", "root", "is_main", "block", F.explode(cells).alias("c")).select("list", "sig", "place", "root", "is_main", "block", "c.*")
    m = m.join(classes.select("sig", "n_shingles", "bits"), "sig")
    return m.withColumn("bucket", F.pmod(F.xxhash64("list", "few", "x", "y"), F.lit(n_buckets))).groupBy("bucket").applyInArrow(_compare, "a long, b long")


def links(docs: DataFrame, classes: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Edges ``a``, ``b`` that connect every component: stars of the components that the first links give, and the later links."""
    texts = docs.select(docs[text_col].cast("binary").alias("text"))

    def confirmed(pairs):
        pairs = rows.stored(pairs)
        wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
        return rows.stored(verify(pairs, rows.stored(whole_sets(docs, wanted, classes, id_col=id_col, text_col=text_col))))

    counts = sketch(texts)
    found = rows.stored(lists(texts, counts, boundary(counts)))
    one = confirmed(plausible(found.where((F.col("sig") != F.col("leader")) & _size_fits("n", "leader_n"))
                              .select(F.least("sig", "leader").alias("a"), F.greatest("sig", "leader").alias("b")).distinct(), classes))
    # lists that still span components: members outside the largest one against all others
    first_roots = components(one)
    part = found.groupBy("list", "sig").agg(F.first("place").alias("place")) \
        .join(first_roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    spans = part.groupBy("list").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("list")
    mixed = rows.stored(part.join(spans, "list", "left_semi"))
    pairs = across(mixed, classes, rows.parts(docs)[1], block).distinct()
    return first_roots.select(F.col("sig").alias("a"), F.col("root").alias("b")).union(confirmed(pairs))


def _rooted(docs: DataFrame, *, id_col: str, text_col: str, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """The members, and ``sig``, ``least`` (id) and ``root`` of each class."""
    who = rows.stored(members(docs, id_col=id_col, text_col=text_col, digest=digest))
    classes = rows.stored(who.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits")))
    group = components(links(docs, classes, id_col=id_col, text_col=text_col))
    return who, classes.select("sig", "least").join(group, "sig", "left").withColumn("root", F.coalesce("root", "sig"))


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``: a row for each document."""
    who, rooted = _rooted(docs, id_col=id_col, text_col=text_col)
    name = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("sig", "component_id")
    return who.join(name, "sig", "left").select("doc_id", "n_shingles", F.coalesce(F.when(F.col("sig").isNotNull(), F.col("component_id")), F.col("doc_id")).alias("component_id"))


def op10(spark, sf_dir: str) -> DataFrame:
    """Components of near copies over the whole table."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that of the least id (a null id is the greatest), then of the least digest of its text.

    Of rows that share both, one stays, by a hash of the whole row.  Rows
    without words are no copies of others: one stays for each id, and one of those that have no id.
    """
    who, rooted = _rooted(docs, id_col=id_col, text_col=text_col, digest=True)
    key = F.struct(F.coalesce("doc_id", F.lit(int(rows.NULL_ID))).alias("id"), F.col("digest"))
    first = who.where("sig IS NOT NULL").groupBy("sig").agg(F.min(key).alias("key")).join(rooted, "sig").groupBy("root").agg(F.min("key").alias("key")).select("key.*")
    blank = who.where("sig IS NULL").groupBy("doc_id").agg(F.min(key).alias("key")).select("key.*")
    whole = F.struct(*[docs[c] for c in docs.columns])
    tie = F.xxhash64(*[docs[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()])
    once = docs.groupBy(F.coalesce(docs[id_col].cast("long"), F.lit(int(rows.NULL_ID))).alias("id"), _digest(docs[text_col]).alias("digest")).agg(F.min_by(whole, tie).alias("row"))
    return once.join(first.union(blank), ["id", "digest"], "left_semi").select("row.*")
