"""Operator 8, byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file is read once on the driver and broadcast (a vocabulary is of
fixed size; files above ``MAX_RANK_BYTES`` are refused).  Long texts are cut
at boundaries where the splitting pattern always cuts: before a space or
line feed that follows a character other than white space.  No alternative of the
pattern reaches across such a place, so the pieces encode to the same ids.
The pattern matches a run of white space up to its last character (all of it at the end of a text) as one
piece; a run of ``RUN_CHARS`` or more, on which the library's matcher would recurse, is handed over as that piece.
Decoding joins the raw bytes of the ids, so any ids decode.

Cases: null and empty texts have no ids and decode to no bytes; special
tokens are ordinary text; very long texts are encoded in parts, long runs of any one kind of character too; equal and repeated rows
are rows of their own; extra columns are carried.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import rows

MAX_RANK_BYTES = 64 << 20
PIECE_CHARS = 1 << 16
RUN_CHARS = 4096
_CUT = re.compile(r"(?<=\S)[ \n]")
#: fixed values: the characters of the Unicode property White_Space, which the pattern's \s stands for
_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")
_encodings: dict[tuple[str, bytes], object] = {}


def load_ranks(path: str) -> bytes:
    """The bytes of a rank file, of at most ``MAX_RANK_BYTES``."""
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"rank file of more than {MAX_RANK_BYTES} bytes")
    return data


def encoding(ranks: bytes, pattern: str):
    """The tiktoken encoding, built once per worker."""
    import hashlib

    import tiktoken

    key = (pattern, hashlib.sha256(ranks).digest())
    if key not in _encodings:
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                            mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs})
    return _encodings[key]


def pieces(text: str, size: int = PIECE_CHARS):
    """The text in parts of about ``size`` characters, cut at safe boundaries only."""
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def encode_text(enc, text: str) -> list[int]:
    if len(text) < RUN_CHARS:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for m in _RUN.finditer(text):
        if m.end() - m.start() >= RUN_CHARS:
            end = m.end() if m.end() == len(text) else m.end() - 1
            for part in pieces(text[at:m.start()]):
                ids.extend(enc.encode_ordinary(part))
            ids.extend(enc._encode_single_piece(text[m.start():end]))
            at = end
    for part in pieces(text[at:]):
        ids.extend(enc.encode_ordinary(part))
    return ids


def _lists(parts: list, kind) -> pa.Array:
    """One Arrow list array from many number lists, by way of flat numpy arrays."""
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))).astype(np.int32)
    flat = np.concatenate([np.asarray(p, kind) for p in parts]) if parts else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(docs: DataFrame, ranks: bytes, pattern: str, *, text_col: str = "text", row: list[str] | None = None) -> DataFrame:
    """Columns ``row`` and ``res.ids`` (array of int)."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def fn(texts, _):
        enc = encoding(shared.value, pattern)
        ids = _lists([encode_text(enc, (t or b"").decode("utf-8", "replace")) for t in texts], np.int32)
        return {"ids": ids.cast(pa.list_(pa.field("element", pa.int32(), False)))}

    return rows.map_texts(docs, text_col, fn, T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]), row=row)


def decode(df: DataFrame, ranks: bytes, pattern: str, *, ids_col: str = "ids", row: list[str] | None = None) -> DataFrame:
    """Columns ``row`` and ``res.decoded`` (binary) of an array column of ids; null ids give null."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def fn(_, extra):
        enc = encoding(shared.value, pattern)
        return {"decoded": [None if x is None else enc.decode_bytes(x) for x in extra["ids"]]}

    return rows.map_texts(df, F.lit(None), fn, T.StructType([T.StructField("decoded", T.BinaryType())]), row=row, extra={"ids": df[ids_col]})


def round_trip(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text", row: list[str] | None = None) -> DataFrame:
    """Columns ``row``, ``ids`` and ``decoded``, the bytes that the ids decode to, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(path))

    def fn(texts, _):
        enc = encoding(shared.value, pattern)
        ids = [encode_text(enc, (t or b"").decode("utf-8", "replace")) for t in texts]
        decoded = [enc.decode_bytes(x) for x in ids]
        return {"ids": _lists(ids, np.int32).cast(pa.list_(pa.field("element", pa.int32(), False))), "decoded": decoded}

    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("decoded", T.BinaryType(), False)])
    return rows.map_texts(docs, text_col, fn, kind, row=row).select("row", "res.ids", "res.decoded")


def digests(docs: DataFrame, row: list[str]) -> DataFrame:
    """Contract digest: ids and decoded bytes of every whole text, hashed."""
    import public_tokenizers

    got = round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, row=row)
    return got.select("row.*", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op8(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
