"""Scorer edges against a plain-Python statement of the scoring rules."""

import json
import re
import string

from pyspark.sql import functions as F

from ptloom.operators import evaluate as ev

EDGES = ["5", '"use tool"', '["tool"]', "null", "", '{"tool":null,"arguments":{"x":1}}',
         '{"tool":"a","arguments":[1]}', '{"tool":"a","arguments":{"x":1}}', '  {"tool":"b","arguments":{}}  ',
         "I will do it", '{"tool": "a"', None]


def brute(output, expected, compat):
    r = dict(is_valid_json=False, has_tool_key=False, tool_correct=False, has_arguments=False)
    if output is None:
        return r
    try:
        obj = json.loads(output.strip())
    except ValueError:
        return r
    r["is_valid_json"] = True
    if isinstance(obj, dict):
        if "tool" in obj:
            r["has_tool_key"] = True
            r["tool_correct"] = obj["tool"] == expected
        if isinstance(obj.get("arguments"), dict):
            r["has_arguments"] = len(obj["arguments"]) > 0
    elif compat and isinstance(obj, (list, str)) and "tool" in obj:
        r["has_tool_key"] = True
    return r


def score(r):
    return round(0.4 * r["is_valid_json"] + 0.2 * r["has_tool_key"] + 0.3 * r["tool_correct"] + 0.1 * r["has_arguments"], 2)


def _run(spark, compat):
    df = spark.createDataFrame([(i, o, "a") for i, o in enumerate(EDGES)], "i int, output string, expected_tool string")
    return {r.i: r for r in ev.score(ev.evaluate_output(df, compat=compat)).collect()}


def test_scores_match_rules(spark):
    for compat in (False, True):
        got = _run(spark, compat)
        for i, o in enumerate(EDGES):
            exp = brute(o, "a", compat)
            r = got[i]
            assert {k: r[k] for k in exp} == exp, (o, compat)
            assert r.score == score(exp), (o, compat)


def test_compat_quirk_scores(spark):
    got = _run(spark, True)
    assert got[EDGES.index('["tool"]')].score == 0.6
    assert got[EDGES.index('"use tool"')].score == 0.6
    assert _run(spark, False)[EDGES.index('["tool"]')].score == 0.4


def test_exact_arguments_canonical(spark):
    df = spark.createDataFrame(
        [('{"tool":"u","arguments":{"to_unit":"mi","value":5}}', '{"value":5,"to_unit":"mi"}', "u"),
         ('{"tool":"u","arguments":{"value":6}}', '{"value":5}', "u")],
        "output string, expected_arguments string, expected_tool string")
    r = ev.exact_arguments(ev.evaluate_output(df)).select("args_exact").collect()
    assert [x.args_exact for x in r] == [True, False]


def test_text_stats(spark):
    df = spark.createDataFrame([("a b c a b c",), ("x",)], "t string")
    r = ev.text_stats(df, "t").collect()
    assert abs(r[0].repetition - (1 - 3 / 4)) < 1e-12 and r[1].repetition == 0.0


def test_text_stats_split_a_text_once_and_match_plain_python(spark):
    texts = ["a b a b a b", "A b\na B\ra b a", "x", "x y z", "x y z x y z", " \t ", "", None, "Bob: hi\nAnn: ho\n\nno: x!", "\xa0é　É é é 😀 😀 😀 😀,", "{\"tool\": \"a\"}\r\n\x0b\f.", "Sure: \nX1: y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for n in (1, 2, 3):
        stats = ev.text_stats(df, "t", n=n)
        # the n-grams' lambda must not split the text again for each n-gram
        assert stats._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1
        assert stats.columns == ["i", "t", "n_words", "repetition", "n_line_breaks", "n_speaker_lines", "punct_share"]
        for r in stats.where("t IS NOT NULL").collect():
            w = [x for x in re.split(r"[ \t\n\x0b\f\r]+", r.t.lower()) if x]
            g = [tuple(w[k:k + n]) for k in range(len(w) - n + 1)]
            assert (r.n_words, r.repetition) == (len(w), 1 - len(set(g)) / len(g) if g else 0.0), (r.t, n)
            assert r.n_line_breaks == r.t.count("\n") and r.n_speaker_lines == len(re.findall(r"(?:^|[\n\r])[A-Z][A-Za-z]*:", r.t))
            assert r.punct_share == (sum(c in string.punctuation for c in r.t) / len(r.t) if r.t else 0.0)
        none = stats.where("t IS NULL").first()
        assert (none.repetition, none.n_line_breaks, none.punct_share) == (0.0, None, 0.0)
