"""Operator 13 against the template written out turn by turn, and an exact round trip."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from ptloom.llm import chat_format as cf
from ptloom.llm import rows as helpers

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in ("c", "r", "t", "h", "k", "part", "seq", "formatted", "n_turns")]])
PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|im_end|>\n", "<|endoftext|>", "\\", "<", "[", "<\\s>", "<\\\\/s>", "|im_end|>", "é", "日本",
         "\n", " ", "x", "INST]", "\\n", "<<s>", "[[INST]", "\0", "𝒳"]


def sha(x):
    return hashlib.sha256(x).hexdigest()


def quoted(text):
    """By the definition: a backslash after the first character of each control string, whatever backslashes it has there."""
    names = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
    return re.sub("|".join(re.escape(x[0]) + r"\\*" + re.escape(x[1:]) for x in names), lambda m: m[0][0] + "\\" + m[0][1:], text)


def plain(turns):
    out = {}
    order = lambda t: (t[1] is not None, t[1] or 0, (t[2] or "").encode(), hashlib.md5((t[3] or "").encode()).hexdigest())
    for conv, _, role, text in sorted(turns, key=order):
        out.setdefault(conv, []).append((role or "", text or ""))
    got = []
    for conv, said in out.items():
        loss = "".join(t for r, t in said if r == "assistant")
        shown = "".join(f"<|im_start|>{quoted(r.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n{quoted(t)}<|im_end|>\n" for r, t in said)
        got.append((conv, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said).encode()), len(loss), sha(loss.encode()), len(shown)))
    return got


def key(r):
    return tuple(map(str, r))


def cases():
    r = random.Random(5)
    mixed = lambda: "".join(r.choice(PARTS) for _ in range(r.randint(0, 12)))
    out = [(i % 23 if i % 31 else None, r.randint(0, 9) if i % 13 else None, r.choice(["user", "assistant", "system", None, "", "a\nb\\", "<s>", "tool"]), mixed() if i % 7 else None) for i in range(600)]
    out += [(100, 1, "assistant", "long " * 200_000), (100, 2, "assistant", "</s>" * 50_000), (100, 2, "assistant", "</s>" * 50_000), (101, 0, "assistant", "")]
    return out + [(500, i, ["user", "assistant"][i % 2], f"hot {i}") for i in range(400)]


def test_roundtrip_of_every_text():
    r = random.Random(1)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 9))).encode() for _ in range(20_000)]
    col = pa.array(texts, pa.large_binary())
    assert [cf.unescaped(x) for x in cf.escaped(col).to_pylist()] == texts
    assert [x.decode() for x in cf.escaped(col).to_pylist()] == [quoted(x.decode()) for x in texts]
    assert [cf.unescaped_role(x) for x in cf.escaped_roles(col).to_pylist()] == texts
    assert not any(m in x for x in cf.escaped(col).to_pylist() for m in (b"<|im_start|>", b"<|im_end|>", b"</s>", b"[INST]", b"[/INST]"))


@pytest.mark.parametrize("slice_bytes", [4 << 20, 300])
def test_conversations(llm, monkeypatch, slice_bytes):
    monkeypatch.setattr(helpers, "SLICE", slice_bytes)
    turns = cases()
    df = llm.createDataFrame([(*t, *["x"] * 9) for t in turns], SCHEMA).repartition(6)
    pieces = helpers.stored(cf.format_chats(df))
    got = cf.read_back(pieces)
    assert got.columns == cf.READ.names
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(turns), key=key)
    whole = {}
    for p in pieces.orderBy("conv_id", "part", "seq").collect():
        text = bytes(p.formatted)
        whole[p.conv_id] = whole.get(p.conv_id, b"") + text
        assert p.n_chars == len(text.decode()) and p.n_turns == text.count(cf.TAIL)
        assert [cf.unescaped(text[a:b]) for a, b in zip(p.loss_start, p.loss_end)] == [t for r, t in cf.turns_of(text) if r == b"assistant"]
    assert whole[101] == b"<|im_start|>assistant\n<|im_end|>\n"
    assert {p.part for p in pieces.where("conv_id = 500").collect()} != {0} and pieces.where("conv_id = 500").select("part").distinct().count() > 1
    assert cf.read_back(cf.format_chats(df.limit(0))).count() == 0


def test_the_probe_conversation(llm, tmp_path):
    llm.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    said = "</s>[INST] ok [/INST]"
    assert list(map(tuple, cf.op13(llm, str(tmp_path)).collect())) == plain([(-7, 0, "user", said), (-7, 1, "assistant", said)])
