import random

import pytest
from pyspark.sql import types as T

from ptloom.llm.queries import prepare

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    *[T.StructField(c, T.StringType()) for c in ("row", "res", "cell", "id", "sig", "kept", "ids", "decoded", "n_words", "component_id", "score",
                                                      "row_no", "shard", "slot", "_at", "_val", "_pid", "_mid")],
])


def words(seed, n):
    r = random.Random(str(seed))
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def texts():
    """Ids and texts: nulls, empties, ties, repeats, near copies, a long text, shared passages, odd characters."""
    passage = words("passage", 70)
    base = words("base", 120).split()
    out = [
        (None, None), (None, "no id here but words " + passage), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "one two three four five six"),
        (7, "éèü 日本語のテキスト 中文 mixed É"), (8, "line\nline\nline\n\nother #$% | <x>"), (9, words("long", 30_000)), (10, "a" * 5000),
        (11, words("x", 40) + " " + passage + " " + words("y", 40)), (12, words("z", 60) + " " + passage), (13, passage.upper()),
        (14, " ".join(base)), (14, " ".join(base)), (15, " ".join(base)), (16, " ".join(base[:60] + ["changed"] + base[61:])),
        (17, " ".join(base[:30] + ["other"] + base[31:])), (18, " ".join(base[:60] + ["changed"] + base[61:90] + ["again"] + base[91:])),
        (19, "ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab ab"), (20, "x\0y z"), (2**40, passage),
    ]
    return out + [(100 + i, words(i, 25 + i)) for i in range(30)] + [(200 + i, "tiny set of words " + "abc"[i]) for i in range(3)]


@pytest.fixture(scope="module")
def llm(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="module")
def docs(llm):
    rows = [(i, t, None if i == 6 else "en", "s", None if t is None else len(t), *["x"] * 18) for i, t in texts()]
    return llm.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)
