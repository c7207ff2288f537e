"""Operator 2, benchmark decontamination: hash set of normalised test n-grams, scan, verify, remove.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII
characters.  A window is ``n`` consecutive words of a benchmark item; an item
of fewer words (but not none) is one window.  The windows of a block of items
are hashed into sorted arrays and broadcast; a document's word windows are
looked up in them and every hit is verified word by word.

The broadcast is bounded: a benchmark of up to ``block_bytes`` of text is
broadcast as its windows.  A larger one is broadcast as a bitmap of the hashes of its windows (16
bits for each, ``MAX_BITS`` at most); one scan of the documents marks the windows that may be in it, and only
these travel, with their words, to the buckets of a join with the benchmark's windows, which verifies them and names the items.  Documents
without a marked window do not travel.

Cases: null or empty text has no words and is never contaminated; items
without words match nothing; items with equal windows all count; repeated
item ids count once; an item with a null id marks words but is not counted;
no items at all leave every document clean; extra columns are carried.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import arrays, rows

#: bits of the bitmap of a large benchmark, 128 MB
MAX_BITS = 1 << 30

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType(), False)),
    T.StructField("hit_words", T.ArrayType(T.LongType(), False)),
    T.StructField("clean_text", T.BinaryType()),
])


class NgramIndex:
    """The windows of some items: per window length, sorted distinct hashes and where each occurs."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], n: int):
        self.ids = [i for i, _ in items]
        words = arrays.Words([t for _, t in items], arrays.ALNUM, lower=True)
        self.words = [words.word(i) for i in range(len(words.starts))]
        self.lengths: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for size in np.unique(np.minimum(words.counts, n)).tolist():
            if size:
                first, h = words.windows(size)
                own = words.owner[first]
                keep = np.flatnonzero((words.counts[own] == size) | (size == n))
                keep = keep[np.argsort(h[keep], kind="stable")]
                keys, at = np.unique(h[keep], return_index=True)
                self.lengths.append((size, keys, np.append(at, len(keep)), first[keep], own[keep]))

    def hits(self, words: arrays.Words):
        """Per hit: first word, window length and items; hashes find it, the words themselves confirm it."""
        for size, keys, at, first, own in self.lengths:
            begin, h = words.windows(size)
            if not len(begin) or not len(keys):
                continue
            where = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            for i in np.flatnonzero(keys[where] == h).tolist():
                k, b = int(where[i]), int(begin[i])
                text = [words.word(b + j) for j in range(size)]
                found = {int(own[o]) for o in range(at[k], at[k + 1]) if self.words[first[o]:first[o] + size] == text}
                if found:
                    yield b, size, found


def _found(texts: list[bytes | None], hits) -> dict[str, list]:
    """The result columns; ``hits`` gives the first word, the length and the items of every hit of some words, the texts from a given one on."""
    out: dict[str, list] = {k: [] for k in RESULT.names}
    for lo, hi in arrays.chunks(texts):
        words = arrays.Words(texts[lo:hi], arrays.ALNUM, lower=True)
        mask = np.zeros(len(words.starts), bool)
        items: list[set[str]] = [set() for _ in range(hi - lo)]
        for b, size, found in hits(words, lo):
            mask[b:b + size] = True
            items[words.owner[b]].update(i for i in found if i is not None)
        n_hit = arrays.sum_by(mask.astype(np.int64), words.first)
        for i in range(hi - lo):
            own = slice(words.first[i], words.first[i + 1])
            text = texts[lo + i]
            if n_hit[i]:  # cut the runs of hit words, up to the next word that stays
                a, z = arrays.runs(mask[own])
                at = np.append(words.starts[own], words.text_starts[i + 1] - 1) - words.text_starts[i]
                cut = np.concatenate(([0], np.ravel(np.column_stack((at[a], at[z]))), [len(text)]))
                text = b"".join(text[cut[j]:cut[j + 1]] for j in range(0, len(cut), 2))
            out["clean_text"].append(text)
            out["hit_words"].append(np.flatnonzero(mask[own]))
            out["items"].append(sorted(items[i]))
        out["n_words"].extend(words.counts.tolist())
        out["n_hit"].extend(n_hit.tolist())
    return out


def scan(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
         n: int = 13, block_bytes: int = 4 << 20, row: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (the document's) and ``res``: words, hit words, items found, text without hit spans."""
    spark = docs.sparkSession
    item = benchmark.select(benchmark[item_col].cast("string").alias("id"), benchmark[item_text_col].cast("binary").alias("text")) \
        .where("length(text) > 0").distinct()
    total = item.agg(F.sum(F.length("text"))).first()[0] or 0
    if total > block_bytes:
        return _bucketed(docs, item, n, text_col=text_col, row=row)
    part = item.toArrow().to_pydict()
    index = spark.sparkContext.broadcast(NgramIndex(list(zip(part["id"], map(bytes, part["text"]))), n))
    return rows.map_texts(docs, text_col, lambda texts, _: _found(texts, lambda words, _: [
        (b, size, [index.value.ids[o] for o in found]) for b, size, found in index.value.hits(words)]), RESULT, row=row)


GRAM = T.StructType([T.StructField("hash", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("gram", T.BinaryType())])
MARKED = T.StructType([T.StructField("at", T.ArrayType(T.LongType(), False)), T.StructField("grams", T.ArrayType(GRAM, False))])


def _gram(words: arrays.Words, at: int, size: int) -> bytes:
    return b" ".join(words.word(at + j) for j in range(size))


def windows(items: DataFrame, n: int) -> DataFrame:
    """``id``, ``hash``, ``size`` and ``gram`` (its words) of every window of the items (id, text), each once."""
    def fn(texts, _):
        out: list[list] = [[] for _ in texts]
        for lo, hi in arrays.chunks(texts):
            words = arrays.Words(texts[lo:hi], arrays.ALNUM, lower=True)
            for size in np.unique(np.minimum(words.counts, n)).tolist():
                if size:
                    first, h = words.windows(size)
                    own = words.owner[first]
                    for i in np.flatnonzero((words.counts[own] == size) | (size == n)).tolist():
                        out[lo + int(own[i])].append({"hash": int(h[i].astype(np.int64)), "size": size, "gram": _gram(words, int(first[i]), size)})
        return {"grams": out}

    got = rows.map_texts(items, "text", fn, T.StructType([T.StructField("grams", T.ArrayType(GRAM))]), row=["id"])
    return got.select("row.id", F.explode("res.grams").alias("g")).select("id", "g.*").distinct()


def _spots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash in a bitmap of ``bits``."""
    h = hashes.view(np.int64)
    return h & (bits - 1), (h >> 32) & (bits - 1)


def bitmap(grams: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the places of all hashes, gathered as blocks of fixed size."""
    part = min(bits, 1 << 15)
    spot = F.explode(F.array(F.col("hash").bitwiseAND(bits - 1), F.shiftright("hash", 32).bitwiseAND(bits - 1))).alias("spot")
    blocks = grams.select(spot).groupBy(F.floor(F.col("spot") / part).alias("block")).agg(F.collect_set((F.col("spot") % part).cast("int")).alias("at"))

    def pack(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for at in batch.column(1):
                own = np.zeros(part, np.uint8)
                own[at.values.to_numpy()] = 1
                out.append(np.packbits(own, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["block", "bits"])

    out = np.zeros(bits // 8, np.uint8)
    got = blocks.mapInArrow(pack, "block long, bits binary").toArrow()  # of fixed size, whatever the benchmark
    for b, x in zip(got.column(0).to_pylist(), got.column(1)):
        out[b * part // 8:(b + 1) * part // 8] = np.frombuffer(x.as_buffer(), np.uint8)
    return out


def _bucketed(docs: DataFrame, items: DataFrame, n: int, *, text_col: str, row: list[str] | None) -> DataFrame:
    """``scan`` for a benchmark of any size."""
    grams = rows.stored(windows(items, n))
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())
    bits = min(MAX_BITS, max(1 << 16, 1 << (16 * max(grams.count(), 1) - 1).bit_length()))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(grams.select("hash").distinct(), bits))

    def mark(texts, _):
        seen = lambda spot: (shared.value[spot >> 3] >> (spot & 7)) & 1 == 1
        at, found = [[] for _ in texts], [[] for _ in texts]
        for lo, hi in arrays.chunks(texts):
            words = arrays.Words(texts[lo:hi], arrays.ALNUM, lower=True)
            for size in sizes:
                begin, h = words.windows(size)
                x, y = _spots(h, bits)
                for i in np.flatnonzero(seen(x) & seen(y)).tolist():
                    b = int(begin[i])
                    own = int(words.owner[b])
                    at[lo + own].append(b - int(words.first[own]))
                    found[lo + own].append({"hash": int(h[i].astype(np.int64)), "size": size, "gram": _gram(words, b, size)})
        return {"at": at, "grams": found}

    src = docs.select(F.struct(*[docs[c] for c in (row or docs.columns)]).alias("row"), docs[text_col].cast("binary").alias("text"))
    marked = rows.stored(rows.map_texts(src, "text", mark, MARKED, row=["row", "text"]).select("row.*", "res").withColumn("key", F.monotonically_increasing_id()))
    asked = marked.where(F.size("res.at") > 0).select("key", F.explode(F.arrays_zip(F.col("res.at").alias("at"), F.col("res.grams").alias("g"))).alias("m")).select("key", "m.at", "m.g.*")
    hits = asked.join(grams, ["hash", "size", "gram"]).groupBy("key").agg(
        F.collect_set(F.struct("at", "size")).alias("places"), F.collect_set("id").alias("items"))  # of one document, as many as its windows
    none = marked.where(F.size("res.at") == 0).select("row", "text", F.lit(None).cast("array<struct<at: bigint, size: int>>").alias("places"), F.lit(None).cast("array<string>").alias("items"))
    some = marked.where(F.size("res.at") > 0).join(hits, "key", "left").select("row", "text", "places", "items")

    def fn(texts, extra):
        def hits(words, lo):
            for i in range(words.n_texts):
                for p in extra["places"][lo + i] or ():
                    yield int(words.first[i]) + p["at"], p["size"], extra["items"][lo + i]

        return _found(texts, hits)

    both = none.unionByName(some)
    return rows.map_texts(both, "text", fn, RESULT, row=["row"], extra={"places": both["places"], "items": both["items"]}).select("row.row", "res")


def contaminated(share: int = 20):
    """The rule: any hit, and at least one word in ``share`` hit."""
    return (F.col("res.n_hit") > 0) & (F.lit(share) * F.col("res.n_hit") >= F.col("res.n_words"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return scan(docs, benchmark, **kw).where(~contaminated()).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """All documents, the hit spans cut from their texts (texts without hits stay as they are, null included)."""
    got = scan(docs, benchmark, text_col=text_col, **kw)
    return got.select(*[(F.when(F.col("res.n_hit") > 0, F.col("res.clean_text").cast("string")).otherwise(F.col(f"row.`{c}`")) if c == text_col
                         else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op2(spark, sf_dir: str) -> DataFrame:
    """Contract digest over the whole tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), row=["doc_id"])
    return got.select("row.doc_id", "res.n_words", "res.n_hit", F.size("res.items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "res.items"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(0), ' ', 'g'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, d.n FROM doc_windows d JOIN item_windows USING (n, win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS s FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
