"""Derived inputs computed from the driver tables (same definitions as the SQL twins).

Only integers and strings go into generated text; every pseudo-random choice
is a seeded md5 of a key, so the data is identical on any cluster layout.
All builders are narrow projections over the scans, except ``chat`` (one
shuffle on ``conv_id``) and ``runlog`` (skew-safe ordered numbering).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ptloom import constants as K
from ptloom.functions.hashing import hex8_to_long, ratio_threshold_hex, seeded_hash, seeded_hex
from ptloom.operators import build
from ptloom.operators.ordered import row_number_in_group
from ptloom.sources.tables import Tables

TOOLCALL_COLS = ["key", "prompt", "tool", "arguments_json", "answer"]


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def toolcalls(t: Tables) -> DataFrame:
    """Tool-call prompts from five tables, one tool each (P-1/P-3/P-12, U-2)."""
    o = t.orders
    factor = F.pmod(F.col("o_orderkey"), F.lit(97)) + 2
    expr = F.concat(_s("o_custkey"), F.lit(" * "), _s(factor))
    calc = o.select(
        F.concat(F.lit("calculator-"), _s("o_orderkey")).alias("key"),
        F.concat(F.lit("Calculate "), expr, F.lit(".")).alias("prompt"),
        F.lit("calculator").alias("tool"),
        F.to_json(F.struct(expr.alias("expression"))).alias("arguments_json"),
        _s(F.col("o_custkey") * factor).alias("answer"),
    )
    n = t.nation
    weather = n.select(
        F.concat(F.lit("weather-"), _s("n_nationkey")).alias("key"),
        F.concat(F.lit("What is the weather in "), F.col("n_name"), F.lit("?")).alias("prompt"),
        F.lit("weather").alias("tool"),
        F.to_json(F.struct(F.col("n_name").alias("city"))).alias("arguments_json"),
        F.lit(None).cast("string").alias("answer"),
    )
    p = t.part
    search = p.select(
        F.concat(F.lit("search-"), _s("p_partkey")).alias("key"),
        F.concat(F.lit("Search for "), F.col("p_name"), F.lit(".")).alias("prompt"),
        F.lit("search").alias("tool"),
        F.to_json(F.struct(F.col("p_name").alias("query"))).alias("arguments_json"),
        F.lit(None).cast("string").alias("answer"),
    )
    r = t.region
    translate = r.select(
        F.concat(F.lit("translate-"), _s("r_regionkey")).alias("key"),
        F.concat(F.lit('Translate "'), F.col("r_name"), F.lit('" to French.')).alias("prompt"),
        F.lit("translate").alias("tool"),
        F.to_json(F.struct(F.col("r_name").alias("text"))).alias("arguments_json"),
        F.lit(None).cast("string").alias("answer"),
    )
    c = t.customer
    unit = c.select(
        F.concat(F.lit("unit_convert-"), _s("c_custkey")).alias("key"),
        F.concat(F.lit("Convert "), _s("c_custkey"), F.lit(" kilometers to miles.")).alias("prompt"),
        F.lit("unit_convert").alias("tool"),
        F.to_json(
            F.struct(F.col("c_custkey").alias("value"), F.lit("km").alias("from_unit"), F.lit("miles").alias("to_unit"))
        ).alias("arguments_json"),
        F.lit(None).cast("string").alias("answer"),
    )
    u = calc.unionByName(weather).unionByName(search).unionByName(translate).unionByName(unit)
    return u.withColumn("chosen", build.tool_call_json(F.col("tool"), F.col("arguments_json")))


def pairs(t: Tables) -> DataFrame:
    """toolcalls × six rejected variants (P-10) with ``pair_id``."""
    return build.expand_pairs(toolcalls(t))


def preference_split_file(key_col: str = "key", ratio: float = K.PREFERENCE_VAL_RATIO) -> F.Column:
    """Group-safe file assignment by prompt key (L-5): all pairs of a prompt together."""
    h = F.substring(seeded_hex(F.col(key_col)), 1, 8)
    return F.when(h < F.lit(ratio_threshold_hex(ratio)), "preference_val.jsonl").otherwise("preference_train.jsonl")


def chat(t: Tables) -> DataFrame:
    """conversations → one record per conversation, messages ordered by turn (P-15).

    The only shuffle is the group by ``conv_id``; the record *is* the group,
    so its size is that of one conversation.
    """
    from ptloom.operators.chat import turns_to_records

    return turns_to_records(t.conversations)


# damage kinds of raw chat lines, by pmod(seeded hash, 13)
CHAT_DAMAGE_MOD = 13


def raw_chat_lines(t: Tables) -> DataFrame:
    """Chat records as JSONL text with every damage kind present (SRC-1 .. SRC-4, V-1 .. V-10).

    0 truncated, 1 blank line, 2 user role renamed 'bot', 3 numeric id,
    4 trailing text, 5 wrapped in an array, 6 empty messages, 7 first content
    blank, 8 assistant tool call cut short, 9 blank id; others intact.
    """
    from ptloom.sources.textio import as_text_lines

    rid = F.concat(F.lit("conv-"), _s("conv_id"))
    # the damage kind is computed once, in its own projection
    c = chat(t).select("conv_id", "messages", rid.alias("line_id"),
                       F.pmod(seeded_hash(F.lit("raw"), rid), F.lit(CHAT_DAMAGE_MOD)).alias("damage"))
    d = F.col("damage")
    m = F.col("messages")
    msgs = (
        F.when(d == 6, F.array().cast("array<struct<role:string,content:string>>"))
        .when(d == 7, F.transform(m, lambda x, i: F.struct(x["role"].alias("role"),
                                                           F.when(i == 0, F.lit(" ")).otherwise(x["content"]).alias("content"))))
        .when(d == 8, F.transform(m, lambda x: F.struct(x["role"].alias("role"),
                                                        F.when(x["role"] == "assistant", F.lit('{"tool": "calculator", "arguments": {'))
                                                        .otherwise(x["content"]).alias("content"))))
        .when(d == 2, F.transform(m, lambda x: F.struct(F.when(x["role"] == "user", F.lit("bot")).otherwise(x["role"]).alias("role"),
                                                        x["content"].alias("content"))))
        .otherwise(m)
    )
    meta = F.struct(F.lit("chat").alias("task"))
    idv = F.when(d == 9, F.lit(" ")).otherwise(F.col("line_id"))
    js = F.when(d == 3, F.to_json(F.struct(F.col("conv_id").alias("id"), msgs.alias("messages"), meta.alias("meta")))).otherwise(
        F.to_json(F.struct(idv.alias("id"), msgs.alias("messages"), meta.alias("meta")))
    )
    line = (
        F.when(d == 0, F.expr("left(_js, length(_js) - 1)"))
        .when(d == 1, F.lit("   "))
        .when(d == 4, F.concat(F.col("_js"), F.lit(" tail")))
        .when(d == 5, F.concat(F.lit("["), F.col("_js"), F.lit("]")))
        .otherwise(F.col("_js"))
    )
    return as_text_lines(c.select("line_id", "damage", js.alias("_js")), line, ["line_id", "damage"])


PAIR_DAMAGE_MOD = 11


def _damaged_pair(p: DataFrame) -> tuple[DataFrame, F.Column]:
    """``p`` with ``damage`` and the record text ``_js`` beside its own columns, and the line made from them."""
    msg_t = "array<struct<role:string,content:string>>"
    p = build.preference_record(p).withColumn("damage", F.pmod(seeded_hash(F.lit("rawpair"), F.col("pair_id")), F.lit(PAIR_DAMAGE_MOD)))
    d = F.col("damage")
    chosen = (
        F.when(d == 3, F.array().cast(msg_t))
        .when(d == 5, F.array(build.message("bot", F.col("chosen"))))
        .otherwise(F.col("chosen_messages"))
    )
    rejected = (
        F.when(d == 4, F.array(build.message("assistant", F.col("chosen"))))
        .when(d == 6, F.array(build.message("assistant", F.lit(" "))))
        .otherwise(F.col("rejected_messages"))
    )
    js = F.when(
        d == 2, F.to_json(F.struct(F.col("prompt_messages").alias("prompt"), chosen.alias("chosen")))
    ).otherwise(
        F.to_json(F.struct(F.col("prompt_messages").alias("prompt"), chosen.alias("chosen"), rejected.alias("rejected")))
    )
    line = (
        F.when(d == 0, F.expr("left(_js, length(_js) - 1)"))
        .when(d == 1, F.lit("  "))
        .otherwise(F.col("_js"))
    )
    return p.withColumn("_js", js), line


def raw_pair_lines(t: Tables) -> DataFrame:
    """Preference records as JSONL text, two files, with damage of the kinds below (V-11 .. V-17).

    0 truncated, 1 blank line, 2 'rejected' missing, 3 empty chosen list,
    4 rejected equals chosen, 5 chosen role 'bot', 6 blank rejected content;
    others intact; not_object, not_list and message_not_object do not occur.
    ``file`` is the group-safe split of the prompt key.
    """
    from ptloom.sources.textio import as_text_lines

    p, line = _damaged_pair(pairs(t))
    keep = ["line_id", "tool", "damage", "file"]
    return as_text_lines(
        p.select(F.col("pair_id").alias("line_id"), "tool", "damage", preference_split_file("key").alias("file"), "_js"), line, keep
    )


def raw_pair_keys(t: Tables) -> DataFrame:
    """What the lines of ``raw_pair_lines`` are made from, a short row for each, so that lines can be put in order before they are made."""
    return pairs(t).select(F.col("pair_id").alias("line_id"), preference_split_file("key").alias("file"), "key", "variant", "prompt", "tool", "arguments_json")


def lines_of_keys(keys: DataFrame) -> DataFrame:
    """``keys`` (rows of ``raw_pair_keys``, with any more columns) with their line as ``value``; a projection, the order of rows stays."""
    chosen = build.tool_call_json(F.col("tool"), F.col("arguments_json"))
    p = keys.select("*", F.col("line_id").alias("pair_id"), chosen.alias("chosen"))
    rejected = build.rejected_text(F.col("variant"), F.col("key"), F.col("tool"), F.col("arguments_json"), F.col("chosen"))
    p, line = _damaged_pair(p.withColumn("rejected", rejected))
    return p.select(*[F.col(f"`{c}`") for c in keys.columns], line.alias("value"))


def chat_rule_lines(t: Tables) -> DataFrame:
    """Chat lines with the damage that ``raw_chat_lines`` lacks (V-4 .. V-6), by pmod(seeded hash, 9).

    0 a text, 1 a null, 2 a message without a role, 3 one with a numeric role or 4 a
    numeric content before the messages, 5 an object in place of the list, 6 a null line object; others intact.
    """
    from ptloom.sources.textio import as_text_lines

    rid = F.concat(F.lit("conv-"), _s("conv_id"))
    c = chat(t).select(rid.alias("line_id"), F.to_json("messages").alias("_m"), F.pmod(seeded_hash(F.lit("chatrule"), rid), F.lit(9)).alias("damage"))
    first = {0: '"a text"', 1: "null", 2: '{"content": "no role"}', 3: '{"role": 7, "content": "x"}', 4: '{"role": "user", "content": 5}'}
    msgs = F.when(F.col("damage") == 5, F.lit('{"role": "user", "content": "x"}'))
    for d, x in first.items():
        msgs = msgs.when(F.col("damage") == d, F.concat(F.lit(f"[{x}, "), F.expr("substring(_m, 2)")))
    line = F.when(F.col("damage") == 6, F.lit("null")).otherwise(F.concat(F.lit('{"id": "'), F.col("line_id"), F.lit('", "messages": '), msgs.otherwise(F.col("_m")), F.lit("}")))
    return as_text_lines(c, line, ["line_id", "damage"])


#: a long text without the key of a tool (extra_text_pollution)
LONG_OBJECT = '{"note": "' + "many words " * 20 + '"}'


def pref_rule_lines(t: Tables) -> DataFrame:
    """Preference lines with the damage that ``raw_pair_lines`` lacks (V-12 .. V-14, V-17), by pmod(seeded hash, 13).

    0 a list at the top, 1 chosen a text, 2 a text in chosen, 3 rejected content a number, 4 prompt without role, 5 chosen without
    content, 6 chosen by a user, 7 prompt by an assistant (both wrong under strict roles only), 8 rejected a long object without
    a tool, 9 a short one, 10 rejected null; others intact.
    """
    from ptloom.sources.textio import as_text_lines

    p = build.preference_record(pairs(t)).select(
        F.col("pair_id").alias("line_id"), F.to_json("prompt_messages").alias("_p"), F.to_json("chosen_messages").alias("_c"), F.to_json("rejected_messages").alias("_r"),
        F.pmod(seeded_hash(F.lit("prefrule"), F.col("pair_id")), F.lit(13)).alias("damage"), preference_split_file("key").alias("file"))
    d = F.col("damage")
    said = lambda role, text: F.to_json(F.array(build.message(role, F.lit(text))))
    prompt = F.when(d == 4, F.lit('[{"content": "x"}]')).when(d == 7, said("assistant", "x")).otherwise(F.col("_p"))
    chosen = F.when(d == 1, F.lit('"a text"')).when(d == 2, F.lit('["a text"]')).when(d == 5, F.lit('[{"role": "assistant"}]')).when(d == 6, said("user", "x")).otherwise(F.col("_c"))
    rejected = F.when(d == 3, F.lit('[{"role": "assistant", "content": 5}]')).when(d == 8, said("assistant", LONG_OBJECT)).when(
        d == 9, said("assistant", '{"a": 1}')).when(d == 10, F.lit("null")).otherwise(F.col("_r"))
    js = F.concat(F.lit('{"prompt": '), prompt, F.lit(', "chosen": '), chosen, F.lit(', "rejected": '), rejected, F.lit("}"))
    return as_text_lines(p.select("line_id", "damage", "file", js.alias("_js")), F.when(d == 0, F.concat(F.lit("["), F.col("_js"), F.lit("]"))).otherwise(F.col("_js")), ["line_id", "damage", "file"])


MODELS = [("base", 3), ("tuned", 7)]  # model name, chosen share in tenths


def outputs(t: Tables) -> DataFrame:
    """Model outputs: (base, tuned) × toolcalls; chosen text or one rejected variant.

    The pick is an md5 bucket of ``model|key``; the tuned model gets the
    chosen answer more often.  No join: a model's outputs are a projection of
    the tool calls, which makes only the text that is picked.
    """
    tc = toolcalls(t)
    return reduce(DataFrame.unionByName, [_outputs_of(tc, m, s) for m, s in MODELS])


def _outputs_of(tc: DataFrame, model: str, share: int) -> DataFrame:
    """The outputs of one model; variant 0 is the chosen text, picked before any text is made."""
    h = seeded_hex(F.lit(model), F.col("key"))
    pick = (F.pmod(hex8_to_long(h, 9), F.lit(6)) + 1).cast("int")
    d = tc.select("*", F.when(F.pmod(hex8_to_long(h, 1), F.lit(10)) < share, 0).otherwise(pick).alias("_pick"))
    rejected = build.rejected_text(F.col("_pick"), F.col("key"), F.col("tool"), F.col("arguments_json"), F.col("chosen"))
    return d.select(
        F.lit(model).alias("model"),
        F.col("key").alias("prompt_id"),
        "prompt",
        F.when(F.col("_pick") == 0, F.col("chosen")).otherwise(rejected).alias("output"),
        F.col("tool").alias("expected_tool"),
        F.col("arguments_json").alias("expected_arguments"),
        "answer",
    )


def runlog(t: Tables) -> DataFrame:
    """Training log from events: run = event_type, split by event_id parity,
    step = row number by (ts, event_id) inside the run (skew-safe), loss = value."""
    e = t.events.select("event_id", "ts", "event_type", "value")
    numbered = row_number_in_group(e, ["event_type"], ["ts", "event_id"], out_col="step")
    return numbered.select(
        F.col("event_type").alias("run_id"),
        F.when(F.pmod(F.col("event_id"), F.lit(2)) == 0, "train").otherwise("val").alias("split"),
        F.col("step").cast("bigint").alias("step"),
        F.col("value").alias("loss"),
        (F.pmod(F.col("event_id"), F.lit(50)) + 440).cast("double").alias("ms"),
        "event_id",
    )


def gpu_log(t: Tables) -> DataFrame:
    """GPU usage log from events: stage = event_type, hours and price from keys."""
    e = t.events
    return e.select(
        F.col("event_type").alias("stage"),
        F.concat(F.lit("gpu-"), _s(F.pmod(F.col("user_id"), F.lit(3)))).alias("gpu"),
        (F.pmod(F.col("user_id"), F.lit(8)) + 1).cast("double").alias("hours"),
        (F.pmod(F.col("event_id"), F.lit(5)) + 1).cast("double").alias("price"),
    )


def logprobs(t: Tables) -> DataFrame:
    """Policy / reference log-probs of chosen and rejected from embeddings elements 1-4."""
    e = t.embeddings
    el = lambda i: (-F.abs(F.element_at("embedding", i).cast("double")))
    return e.select(
        F.col("vec_id").alias("pair_id"),
        "label",
        el(1).alias("policy_chosen"),
        el(2).alias("policy_rejected"),
        el(3).alias("ref_chosen"),
        el(4).alias("ref_rejected"),
    )


def doc_split(ratio: float = 0.1) -> F.Column:
    h = F.substring(seeded_hex(F.col("doc_id").cast("string")), 1, 8)
    return F.when(h < F.lit(ratio_threshold_hex(ratio)), "val").otherwise("train")
