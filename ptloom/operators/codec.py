"""In-row encoding and decoding (FN-9 .. FN-11, V-23): a text's ids are an array in its own row.

A tokenizer reaches the tasks as a broadcast table of proven size: one entry
for each character of the vocabulary (at most 1,114,112 code points) and one for each learned merge.  Texts are looked up
there a slice of an Arrow batch at a time, so no row is made for a character,
nothing is shuffled or joined, and nothing is regrouped by an id.

Cases: a null text has null ids and null ids a null text; an empty text has no ids; a
character outside the vocabulary has a null id, which decoding skips; rows of one id stay rows of their own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ptloom.session import ship_package

CODE_POINTS = 0x110000
#: bytes of texts or ids that a task holds as numpy arrays at a time
SLICE = 4 << 20
#: distinct words whose ids a task keeps
WORDS_KEPT = 200_000
SPACE = " \\t\\n\\x0B\\f\\r"
#: longest word; a longer run without white space is cut after so many characters, from its start
WORD_CHARS = 256
PIECES = re.compile(rf"[^{SPACE}]{{1,{WORD_CHARS}}}|[{SPACE}]")
WORDS = re.compile(rf"[^{SPACE}]{{1,{WORD_CHARS}}}")
#: bytes that Spark hands a Python worker at a time; a batch's ids take four times those of its texts, and several copies of them live at once
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """The package on the workers' path, and batches of at most ``BATCH_BYTES``, so that a worker's memory does not grow with the texts of a task."""
    ship_package(spark)
    now = re.fullmatch(r"(-?\d+)b?", spark.conf.get(BATCH_SETTING))
    if not now or not 0 < int(now[1]) <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


def _places(texts: pa.Array) -> np.ndarray:
    """Byte offsets of the texts, of strings with 32-bit or 64-bit offsets."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    return np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets, bytes and code points of the texts."""
    at = _places(texts)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.empty(0, np.uint8)
    return at, data, np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)


def _sliced(fn: Callable[[pa.Array], pa.Array], col: pa.Array) -> pa.Array:
    """``fn`` over slices of about ``SLICE`` bytes, one row at least."""
    lists = pa.types.is_list(col.type) or pa.types.is_large_list(col.type)
    at = np.asarray(col.offsets) if lists else _places(col)
    part = (at[:-1] - at[0]).astype(np.int64) // (SLICE // (8 if lists else 1))
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(col)]
    return pa.concat_arrays([fn(col.slice(lo, hi - lo)) for lo, hi in zip(edges, edges[1:])])


_ARROW = {"array<int>": pa.list_(pa.int32()), "string": pa.string(), "array<string>": pa.list_(pa.string()), "bigint": pa.int64()}
ROUND_TRIP = "struct<n_tokens:bigint,n_merged:bigint,id_sum:bigint,same:boolean>"
_ARROW[ROUND_TRIP] = pa.struct([("n_tokens", pa.int64()), ("n_merged", pa.int64()), ("id_sum", pa.int64()), ("same", pa.bool_())])


def _udf(fn: Callable[[pa.Array], pa.Array], kind: str) -> Callable[[Column], Column]:
    """``fn`` as a column function; ``arrow`` of it is ``fn``, for functions that go on in the same worker."""
    empty = pa.array([], _ARROW[kind])
    made = F.arrow_udf(lambda col: _sliced(fn, col) if len(col) else empty, kind)
    made.arrow = fn
    return made


def char_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(ch, n): the characters of the texts counted within each task, a row for a character of a task; no row is made for an occurrence."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CODE_POINTS, np.int64)
        for batch in batches:
            texts = batch.column(0)
            part = (_places(texts)[:-1] - _places(texts)[:1]).astype(np.int64) // SLICE
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
            for lo, hi in zip(edges, edges[1:]):
                found = np.bincount(_codes(texts.slice(lo, hi - lo))[2]) if hi > lo else np.zeros(0, np.int64)
                counts[:len(found)] += found
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([chr(c) for c in seen.tolist()], pa.string()), pa.array(counts[seen])], ["ch", "n"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "ch string, n bigint")


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(w, n): the words of the texts counted within each task, ``WORDS_KEPT`` distinct ones or a few more at a time."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["w", "n"])

        for batch in batches:
            for text in batch.column(0):
                words.update(WORDS.findall(text.as_py() or ""))
                if len(words) >= WORDS_KEPT:
                    yield told()
                    words.clear()
        yield told()

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "w string, n bigint")


def collect_vocabulary(vocab: DataFrame) -> tuple[list[str], list[int]]:
    """Characters and ids of a vocabulary ``(ch, id)``; refuses one that is no character vocabulary."""
    rows = vocab.select("ch", "id").limit(CODE_POINTS + 1).collect()
    if len(rows) > CODE_POINTS or any(len(r.ch) != 1 for r in rows):
        raise ValueError("a character vocabulary has at most one entry for each code point")
    return [r.ch for r in rows], [r.id for r in rows]


def char_encoder(spark: SparkSession, chars: list[str], ids: list[int]) -> Callable[[Column], Column]:
    """text -> array<int>, an id for each character."""
    small_batches(spark)
    points = np.array([ord(c) for c in chars], np.int64)
    dense = np.full(int(points.max(initial=-1)) + 2, -1, np.int32)  # the last entry stands for all greater code points
    dense[points] = ids
    table = spark.sparkContext.broadcast(dense)

    def run(texts: pa.Array) -> pa.Array:
        at, data, codes = _codes(texts)
        starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        known = table.value
        got = known[np.minimum(codes, len(known) - 1)]
        return pa.ListArray.from_arrays(pa.array(starts[at - at[0]].astype(np.int32)), pa.array(got, mask=got < 0), mask=texts.is_null())

    return _udf(run, "array<int>")


class _Kept(dict):
    """Results of ``fn``, at most ``WORDS_KEPT`` of them."""

    def __init__(self, fn: Callable[[str], list]):
        self.fn = fn

    def __missing__(self, word: str) -> list:
        if len(self) >= WORDS_KEPT:
            self.clear()
        got = self[word] = self.fn(word)
        return got

    def __reduce__(self):
        return _Kept, (self.fn,)


def bpe_encoder(spark: SparkSession, chars: list[str], ids: list[int], merges: list[tuple[str, str]]) -> Callable[[Column], Column]:
    """text -> array<int>: in each word the pair of the lowest rank is merged, all of its places from the left, until none is left.

    ``merges`` are in order of rank; ``merged_ids`` gives their ids.  A word is encoded once for the rows of a task, and its ids
    are put where it occurs; white space is encoded character by character.
    """
    small_batches(spark)
    known = dict(zip(chars, ids)) | merged_ids(ids, merges)
    shared = spark.sparkContext.broadcast(({m: r for r, m in reversed(list(enumerate(merges)))}, known))

    def encoded(word: str) -> list:
        ranks, known = shared.value
        symbols = list(word)
        while len(symbols) > 1:
            rank, best = min((ranks.get(p, len(ranks) + len(known)), p) for p in zip(symbols, symbols[1:]))
            if best not in ranks:
                break
            out, i = [], 0
            while i < len(symbols):
                two = i + 1 < len(symbols) and symbols[i] == best[0] and symbols[i + 1] == best[1]
                out.append(best[0] + best[1] if two else symbols[i])
                i += 1 + two
            symbols = out
        return [known.get(s) for s in symbols]

    words = _Kept(encoded)

    def run(texts: pa.Array) -> pa.Array:
        out, at = [], [0]
        for text in texts.to_pylist():
            out.extend(chain.from_iterable(map(words.__getitem__, PIECES.findall(text or ""))))
            at.append(len(out))
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out, pa.int32()), mask=texts.is_null())

    return _udf(run, "array<int>")


def merged_ids(ids: list[int], merges: list[tuple[str, str]]) -> dict[str, int]:
    """Ids of the merged symbols, after those of the characters; a symbol that two merges make has the id of the first."""
    first = max(ids, default=-1) + 1
    return {a + b: first + r for r, (a, b) in reversed(list(enumerate(merges)))}


def _strings(tokens: dict[str, int]) -> tuple[pa.Array, pa.Array]:
    return pa.array(list(tokens), pa.string()), pa.array(list(tokens.values()), pa.int32())


def decoder(spark: SparkSession, tokens: dict[str, int]) -> Callable[[Column], Column]:
    """array<int> -> text; ``tokens`` maps a token to its id; unknown ids are skipped."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(_strings(tokens))

    def run(ids: pa.Array) -> pa.Array:
        strings, known = shared.value
        flat = ids.flatten()
        at = pc.index_in(flat, value_set=known, skip_nulls=True)
        kept = np.concatenate(([0], np.cumsum(at.is_valid().to_numpy(zero_copy_only=False))))
        offsets = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))))
        lists = pa.ListArray.from_arrays(pa.array(kept[offsets].astype(np.int32)), strings.take(at.drop_null()))
        return pc.if_else(ids.is_valid(), pc.binary_join(lists, ""), pa.scalar(None, pa.string()))

    return _udf(run, "string")


def id_totals(spark: SparkSession, least: int) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """array<int> -> bigint, twice: the sum of the ids (null where one is), and the number of those from ``least`` on."""
    small_batches(spark)

    def per_list(ids: pa.Array, values: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        at = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)))).astype(np.int64)
        return upto[at[1:]] - upto[at[:-1]]

    def parts(ids: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat = ids.flatten()
        return pc.fill_null(flat, 0).to_numpy(zero_copy_only=False), flat.is_null().to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)

    def total(ids: pa.Array) -> pa.Array:
        values, unknown, none = parts(ids)
        return pa.array(per_list(ids, values), mask=none | (per_list(ids, unknown) > 0))

    def from_least(ids: pa.Array) -> pa.Array:
        values, unknown, none = parts(ids)
        return pa.array(per_list(ids, (values >= least) & ~unknown), mask=none)

    return _udf(total, "bigint"), _udf(from_least, "bigint")


def round_trip(encode: Callable[[Column], Column], decode: Callable[[Column], Column], id_sum: Callable[[Column], Column], n_from: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """text -> ``ROUND_TRIP``: a text's ids are made, decoded and counted by the four functions in one worker, so that no ids go through the JVM; ``same`` is null-safe."""
    to_ids, to_text, total, from_least = (f.arrow for f in (encode, decode, id_sum, n_from))

    def run(texts: pa.Array) -> pa.Array:
        ids = to_ids(texts)
        back = to_text(ids)
        same = pc.or_(pc.fill_null(pc.equal(back, texts.cast(back.type)), False), pc.and_(back.is_null(), texts.is_null()))
        return pa.StructArray.from_arrays([pc.list_value_length(ids).cast(pa.int64()), from_least(ids), total(ids), same], fields=list(_ARROW[ROUND_TRIP]))

    return _udf(run, ROUND_TRIP)


def token_strings(spark: SparkSession, tokens: dict[str, int]) -> Callable[[Column], Column]:
    """array<int> -> array<string> (FN-11): the token at each place, null for an unknown id."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(_strings(tokens))

    def run(ids: pa.Array) -> pa.Array:
        strings, known = shared.value
        offsets = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))))
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), strings.take(pc.index_in(ids.flatten(), value_set=known, skip_nulls=True)), mask=ids.is_null())

    return _udf(run, "array<string>")
