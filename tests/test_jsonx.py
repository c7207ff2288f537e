import json

from pyspark.sql import functions as F

from ptloom.functions import jsonx
from ptloom.functions.text import strip_ws

# JSON strictness edge strings (FIXTURES §2) plus ordinary values.
EDGE = [
    '{"a":1}',
    '  {"a": [1, 2, {"b": null}]}  ',
    '[1,2]',
    '5',
    '"x"',
    'null',
    'true',
    "{'a':1}",
    '{a:1}',
    '{"a":01}',
    '{"a":1,}',
    '[1,]',
    'NaN',
    '{"a":1}]  [{"b":2}',
    '{"a":1} tail',
    ' {"a":1}',
    '{"a":"x\ny"}',
    '{"id": "x"',
    '',
    '{"tool": "a", "arguments": {',
    '{"k": "é ü 中"}',
    '1 2',
]


def _python_ok(s):
    try:
        json.loads(s)
        return True
    except (ValueError, TypeError):
        return False


def test_strict_json_matches_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(EDGE)], "i int, s string")
    out = jsonx.with_strict_json(df, "s", "j").select("i", "j_ok").collect()
    got = {r.i: r.j_ok for r in out}
    for i, s in enumerate(EDGE):
        expected = _python_ok(s)
        if s == "NaN":
            expected = False  # strict RFC JSON: NaN rejected on purpose
        assert got[i] == expected, (s, got[i])


def test_json_type_and_keys(spark):
    rows = [('{"tool":"a","arguments":{}}',), ('[1]',), ('"s"',), ('3.5',), ('null',), ('{"tool":null}',)]
    df = spark.createDataFrame(rows, "s string")
    df = jsonx.with_strict_json(df, "s", "j")
    out = df.select(
        jsonx.json_type(F.col("j_v")).alias("t"),
        jsonx.has_key(F.col("j_v"), "tool").alias("has_tool"),
        jsonx.object_size(jsonx.get_field(F.col("j_v"), "arguments")).alias("n_args"),
    ).collect()
    assert [r.t for r in out] == ["object", "array", "string", "number", "null", "object"]
    assert [r.has_tool for r in out] == [True, False, False, False, False, True]
    assert out[0].n_args == 0


def test_strip_matches_python(spark):
    vals = ["  a ", "　b ", "\tc\n", "\x1cd\x1f", "e", "", "   "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(strip_ws(F.col("s"))).collect()]
    assert got == [v.strip() for v in vals]


def test_duplicate_keys_follow_python(spark):
    # with the recommended setting, a repeated key is valid JSON and the last value wins
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "true"
    df = spark.createDataFrame([('{"a":1,"a":2}',)], "s string")
    r = jsonx.with_strict_json(df, "s", "j").select("j_ok", F.try_variant_get("j_v", "$.a", "int").alias("a")).collect()[0]
    assert r.j_ok is True and r.a == json.loads('{"a":1,"a":2}')["a"]
