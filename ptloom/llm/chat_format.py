r"""Operator 13, chat formatting: columnar byte assembly.

Turns are range-partitioned by conversation and turn, so a conversation that
holds a third of all rows is dealt over many tasks.  A task assembles a slice
of turns at a time: segment lengths (header, role, line feed, content,
footer), their cumulative offsets and scatter indices are numpy arrays, and
headers and contents are copied by them into one Arrow buffer that is
allocated once.  The buffer is cut at conversation borders without a copy; each cut is a *piece*
with the spans of the loss mask, and the pieces of a conversation, in the
order of (part, seq), are its formatted text.

The template is ``<|im_start|>role\ncontent<|im_end|>\n``.  A text that holds
a control string (of this template or of other common ones) gets one backslash after the string's
first character, and so does one that already has backslashes there;
reading takes one off, so every text comes back as it was.  Roles are escaped in the
same way after their backslashes and line feeds were written as ``\\`` and ``\n``.

``read_back`` streams the pieces of a conversation in order through one task,
as a SHA-256 of the whole has to; it keeps one piece at a time, not the conversation.

Cases: null texts and null roles are empty; rows are ordered by turn (null first), ties by
role and then by the MD5 of the text; repeated rows are turns of their own; a null conv_id is a conversation; an empty table
gives no pieces; a very long text is copied as one run of bytes (a row of its own slice, without scatter indices); further columns, whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import rows

HEAD, SEP, TAIL = b"<|im_start|>", b"\n", b"<|im_end|>\n"
#: first character, and what may follow it in a control string
CONTROLS = {"<": [r"\|im_start\|>", r"\|im_end\|>", r"\|endoftext\|>", "s>", "/s>", "<SYS>>", "</SYS>>"], "[": [r"INST\]", r"/INST\]"]}
CONTROL = "(?:" + "|".join(rf"{re.escape(c)}\\*(?:{'|'.join(rest)})" for c, rest in CONTROLS.items()) + ")"
#: by first character: it, the backslashes after it, and the rest of a control string
_PARTS = [(rf"({re.escape(c)})", r"(\\*)", rf"((?:{'|'.join(rest)}))") for c, rest in CONTROLS.items()]
_ESCAPED = [re.compile(rf"{first}\\{more}{rest}".encode()) for first, more, rest in _PARTS]
#: texts above this many bytes are copied as a run, the others by scatter indices
LONG = 1 << 16
CONTINUATION = bytes(range(0x80, 0xC0))

PIECE = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
    T.StructField("n_turns", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("formatted", T.BinaryType()),
    T.StructField("loss_start", T.ArrayType(T.LongType())), T.StructField("loss_end", T.ArrayType(T.LongType())),
])
READ = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
])


def escaped(texts: pa.Array) -> pa.Array:
    """One more backslash after the first character of every control string; Arrow kernels, no row is looked at."""
    for parts in _PARTS:
        texts = pc.replace_substring_regex(texts, pattern="".join(parts), replacement=r"\1\\\2\3")
    return texts


def unescaped(text: bytes) -> bytes:
    if b"\\" in text:
        for pattern in _ESCAPED:
            text = pattern.sub(rb"\1\2\3", text)
    return text


def escaped_roles(roles: pa.Array) -> pa.Array:
    return escaped(pc.replace_substring(pc.replace_substring(roles, pattern="\\", replacement="\\\\"), pattern="\n", replacement="\\n"))


def unescaped_role(role: bytes) -> bytes:
    return re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], unescaped(role)) if b"\\" in role else role


def _bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large binary column and its offsets, from 0."""
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[at[0]:at[-1]] if col.buffers()[2] is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return data, at - at[0]


def _place(out: np.ndarray, data: np.ndarray, at: np.ndarray, to: np.ndarray) -> None:
    """Item i of ``data`` goes to ``out`` from ``to[i]`` on."""
    size = np.diff(at)
    for i in np.flatnonzero(size > LONG).tolist():
        out[to[i]:to[i] + size[i]] = data[at[i]:at[i + 1]]
    short = np.where(size > LONG, 0, size)
    step = np.cumsum(short) - short
    within = np.arange(int(short.sum())) - np.repeat(step, short)
    out[within + np.repeat(to, short)] = data[within + np.repeat(at[:-1], short)]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """The turns one after the other in one buffer: buffer, start of each turn (and the end), start and end of each content."""
    (role, role_at), (text, text_at) = _bytes(roles), _bytes(texts)
    n = len(roles)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 1], lengths[:, 2], lengths[:, 3], lengths[:, 4] = len(HEAD), np.diff(role_at), len(SEP), np.diff(text_at), len(TAIL)
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(n, 5)
    total = int(ends[-1]) if n else 0
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, np.uint8)
    for k, mark in ((0, HEAD), (2, SEP), (4, TAIL)):
        out[starts[:, k, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    _place(out, role, role_at, starts[:, 1])
    _place(out, text, text_at, starts[:, 3])
    return buffer, np.append(starts[:, 0], total), starts[:, 3], starts[:, 3] + lengths[:, 3]


def _pieces(conv: pa.Array, roles: pa.Array, texts: pa.Array, part: int, seq: int) -> pa.RecordBatch:
    buffer, turn_at, lo, hi = assemble(escaped_roles(roles), escaped(texts))
    known = conv.is_valid().to_numpy(zero_copy_only=False)
    ids = pc.fill_null(conv, 0).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (known[1:] != known[:-1]))))
    ends = np.append(first[1:], len(conv))
    out = np.frombuffer(buffer, np.uint8)
    cut = np.append(turn_at[first], turn_at[-1])
    n_chars = np.add.reduceat((out & 0xC0) != 0x80, cut[:-1], dtype=np.int64)
    formatted = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(cut.astype(np.int32)), buffer])
    learnt = np.flatnonzero(pc.equal(roles, pa.scalar(b"assistant", roles.type)).to_numpy(zero_copy_only=False))
    piece = np.searchsorted(first, learnt, "right") - 1
    spans = np.concatenate(([0], np.cumsum(np.bincount(piece, minlength=len(first))))).astype(np.int32)
    return rows.table(PIECE, columns=[
        conv.take(pa.array(first)), pa.array(np.full(len(first), part, np.int32)), pa.array(seq + np.arange(len(first))), pa.array((ends - first).astype(np.int64)),
        pa.array(n_chars), formatted, *[pa.ListArray.from_arrays(pa.array(spans), pa.array(x[learnt] - cut[piece])) for x in (lo, hi)]]).combine_chunks().to_batches()[0]


def format_chats(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The pieces of all conversations (schema ``PIECE``); the spans of the loss mask, the assistants' contents, are bytes of the piece."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = turns.select(turns[conv].cast("long").alias("c"), F.coalesce(turns[role].cast("binary"), F.lit(b"")).alias("r"),
                       F.coalesce(turns[text].cast("binary"), F.lit(b"")).alias("t"), turns[turn].alias("k"))
    keys = ["c", "k", "r", "h"]
    src = src.withColumn("h", F.md5("t")).repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("c", "r", "t")

    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for batch in rows.sliced(batches):
            wide = [batch.column(i).cast(pa.large_binary()) for i in (1, 2)]
            got = _pieces(batch.column(0), *wide, part, seq)
            seq += got.num_rows
            yield got

    return src.mapInArrow(run, PIECE)


def turns_of(formatted: bytes):
    """(role, text) of each turn of a piece, as they were before formatting."""
    for turn in formatted.split(TAIL)[:-1]:
        if not turn.startswith(HEAD):
            raise ValueError("a turn without its header")
        role, content = turn[len(HEAD):].split(SEP, 1)
        yield unescaped_role(role), unescaped(content)


def read_back(pieces: DataFrame) -> DataFrame:
    """Of each conversation: turns, their digest, characters and digest under the loss mask, characters of the formatted text."""
    order = ["conv_id", "part", "seq"]
    src = pieces.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "formatted", "loss_start", "loss_end")

    class Reader:
        def __init__(self, conv):
            self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
            self.n_turns = self.loss_chars = self.n_chars = 0

        def add(self, formatted, spans):
            for role, text in turns_of(formatted):
                self.turns.update(role + b"\n" + text + b"\n")
                self.n_turns += 1
            for lo, hi in spans:
                text = unescaped(formatted[lo:hi])
                self.loss.update(text)
                self.loss_chars += len(text.translate(None, CONTINUATION))
            self.n_chars += len(formatted.translate(None, CONTINUATION))

        def row(self):
            return self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.n_chars

    def run(batches):
        reader = None
        for batch in rows.sliced(batches):
            done = []
            for conv, formatted, lo, hi in zip(*[c.to_pylist() for c in batch.columns]):
                if reader is None or reader.conv != conv:
                    done += [reader.row()] if reader else []
                    reader = Reader(conv)
                reader.add(formatted, zip(lo, hi))
            yield from rows.table(READ, done).to_batches()
        yield from rows.table(READ, [reader.row()] if reader else []).to_batches()

    return src.mapInArrow(run, READ)


def op13(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return read_back(rows.stored(format_chats(turns.unionByName(probe))))


ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, replace(replace(coalesce(role, ''), '\', '\\'), chr(10), '\n') AS shown FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]', unnest(['user', 'assistant']))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({len(HEAD) + len(SEP) + len(TAIL)} + length(shown) + length(text) + len(regexp_extract_all(shown, '{CONTROL}')) + len(regexp_extract_all(text, '{CONTROL}')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
