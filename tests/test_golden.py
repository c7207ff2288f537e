"""Golden expectations re-typed from the reference's published figures."""

import json

from pyspark.sql import functions as F

from ptloom import constants as K
from ptloom.operators import build, classify, split, validate

# The reference's toy SFT items (expression, answer) and JSON-validator texts.
CALC_ITEMS = [
    ("17 * 23", "391"),
    ("(48 + 12) / 5", "12"),
    ("144 ** 0.5", "12"),
    ("99 - 37", "62"),
    ("8 * (7 + 6)", "104"),
    ("1000 / 25", "40"),
]
JSON_TEXTS = [
    '{"name": "Ada", "age": 20}',
    '{"tool": "calculator", "arguments": {"expression": "2+2"}}',
    "{name: Ada, age: 20}",
    "[1, 2, 3]",
]

# Preference prompt templates (prompt, argument, tool) and unit conversions.
RAW_EXAMPLES = [
    ("Calculate 17 * 23.", "17 * 23", "calculator"),
    ("What is 144 / 12?", "144 / 12", "calculator"),
    ("Compute the square root of 256.", "sqrt(256)", "calculator"),
    ("What is 2 to the power of 10?", "2 ** 10", "calculator"),
    ("Evaluate 3.14 * 5 * 5.", "3.14 * 5 * 5", "calculator"),
    ("What is (100 - 37) * 2?", "(100 - 37) * 2", "calculator"),
    ("Calculate 1000 / 8.", "1000 / 8", "calculator"),
    ("What is 99 + 1?", "99 + 1", "calculator"),
    ("What is the weather in Paris?", "Paris", "weather"),
    ("Tell me the weather in Tokyo.", "Tokyo", "weather"),
    ("How is the weather in New York?", "New York", "weather"),
    ("Get the weather for London.", "London", "weather"),
    ("What's the weather like in Sydney?", "Sydney", "weather"),
    ("Check weather for Berlin.", "Berlin", "weather"),
    ('Translate "Hello, world!" to Spanish.', "Hello, world!", "translate"),
    ('Translate "Good morning" to French.', "Good morning", "translate"),
    ('Translate "Thank you very much" to Japanese.', "Thank you very much", "translate"),
    ('Translate "I love programming" to German.', "I love programming", "translate"),
    ('Translate "Where is the library?" to Chinese.', "Where is the library?", "translate"),
    ("Search for the latest news on AI.", "latest news on AI", "search"),
    ("Look up information about quantum computing.", "quantum computing", "search"),
    ("Find recent papers on large language models.", "recent papers large language models", "search"),
    ("Search for Python tutorials for beginners.", "Python tutorials for beginners", "search"),
]
UNIT_EXAMPLES = [
    ("Convert 100 kilometers to miles.", 100, "km", "miles"),
    ("How many pounds is 70 kilograms?", 70, "kg", "pounds"),
    ("Convert 32 degrees Fahrenheit to Celsius.", 32, "Fahrenheit", "Celsius"),
    ("Convert 5 liters to gallons.", 5, "liters", "gallons"),
    ("How many inches is 2 meters?", 2, "meters", "inches"),
    ("Convert 1000 milliliters to cups.", 1000, "milliliters", "cups"),
]
ARG_KEY = {name: keys[0] for name, _, keys in K.TOOLS}


def _sft_records(spark):
    calc = spark.createDataFrame([(i + 1, e, a) for i, (e, a) in enumerate(CALC_ITEMS)], "i int, e string, a string")
    js = spark.createDataFrame([(i + 1, t) for i, t in enumerate(JSON_TEXTS)], "i int, t string")
    c = calc.select(build.sft_calculator_record(F.col("i"), F.col("e"), F.col("a")).alias("r"))
    j = js.select(build.sft_json_validator_record(F.col("i"), F.col("t")).alias("r"))
    return c.unionByName(j).select("r.*")


def test_sft_builder_validates_and_splits(spark):
    recs = _sft_records(spark)
    lines = recs.select("id", F.to_json(F.struct("id", "messages", "meta")).alias("value"))
    v = validate.validate_chat(lines)
    s = validate.chat_summary(v).collect()[0]
    assert (s.n_checked, s.n_errors, s.verdict) == (10, 0, "OK")
    assert sorted(r.id for r in recs.collect())[:2] == ["sft_calc_001", "sft_calc_002"]
    # absent answer stays absent in the JSON line (null fields dropped)
    line = lines.where(F.col("id") == "sft_json_001").collect()[0].value
    assert '"answer"' not in line and '"task":"json_validator"' in line
    sp = split.exact_split(lines.select("id"), "id", K.CHAT_VAL_RATIO, rounding="half_even")
    counts = {r.split: r["count"] for r in sp.groupBy("split").count().collect()}
    assert counts == {"train": 8, "val": 2}


def _toolcalls(spark):
    rows = [(f"t{i}", p, tool, json.dumps({ARG_KEY[tool]: arg}, separators=(",", ":")))
            for i, (p, arg, tool) in enumerate(RAW_EXAMPLES)]
    rows += [(f"u{i}", p, "unit_convert", json.dumps({"value": v, "from_unit": f, "to_unit": t}, separators=(",", ":")))
             for i, (p, v, f, t) in enumerate(UNIT_EXAMPLES)]
    df = spark.createDataFrame(rows, "key string, prompt string, tool string, arguments_json string")
    return df.withColumn("chosen", build.tool_call_json(F.col("tool"), F.col("arguments_json")))


def test_preference_builder_counts(spark):
    pairs = build.expand_pairs(_toolcalls(spark))
    assert pairs.count() == 174
    c = classify.classify_rejected(pairs, "rejected")
    dist = {r.rejected_type: r["count"] for r in c.groupBy("rejected_type").count().collect()}
    assert dist == {"non_json": 58, "wrong_key_name": 29, "wrong_tool_name": 29, "empty_arguments": 29, "invalid_json": 29}
    sp = split.exact_split(pairs.select("pair_id"), "pair_id", K.PREFERENCE_VAL_RATIO, rounding="floor")
    counts = {r.split: r["count"] for r in sp.groupBy("split").count().collect()}
    assert counts == {"train": 157, "val": 17}
    # every built record validates with zero errors and warnings
    recs = build.preference_record(pairs)
    lines = recs.select(build.preference_json_line(recs).alias("value"))
    v = validate.validate_preference(lines)
    tot = v.agg(F.sum("n_errors"), F.sum("n_warnings")).collect()[0]
    assert (tot[0], tot[1]) == (0, 0)


def test_wrong_tool_is_never_own_tool(spark):
    pairs = build.expand_pairs(_toolcalls(spark)).where(F.col("variant") == 3)
    for r in pairs.select("tool", "rejected").collect():
        assert json.loads(r.rejected)["tool"] != r.tool


def test_unknown_tool_report(spark):
    df = spark.createDataFrame([("weather",), ("teleport",), ("search",)], "tool string")
    out = [r.tool for r in build.check_tools(df, build.tool_registry(spark)).collect()]
    assert out == ["teleport"]
