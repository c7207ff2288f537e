"""Record builders (P-1 .. P-14, J-3, J-4, U-1, U-2).

Tool calls are JSON text.  Payloads are always serialised with ``to_json``;
the only concatenation is the fixed envelope around already-serialised JSON,
and every string placed in it goes through ``json_string`` (JSON escaping by
``to_json``), so the result is valid JSON whatever the input text holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ptloom import constants as K
from ptloom.functions import jsonx
from ptloom.functions.hashing import seeded_hash
from ptloom.operators.joins import checked_broadcast


def json_string(c: Column) -> Column:
    """JSON string literal of a text column (quotes and escapes by to_json); null gives JSON null."""
    arr = F.to_json(F.array(c))
    return F.substring(arr, F.lit(2), F.char_length(arr) - 2)


def tool_call_json(tool: Column, args_json: Column) -> Column:
    """``{"tool": <tool>, "arguments": <args>}`` (P-3) from a JSON arguments text; null gives JSON null."""
    return F.concat(F.lit('{"tool":'), json_string(tool), F.lit(',"arguments":'), F.coalesce(args_json, F.lit("null")), F.lit("}"))


def tool_registry(spark: SparkSession) -> DataFrame:
    """The tool registry as a five-row dimension table (J-3)."""
    return spark.createDataFrame(
        [(name, desc, keys) for name, desc, keys in K.TOOLS],
        "tool string, description string, arg_keys array<string>",
    )


def check_tools(df: DataFrame, registry: DataFrame, tool_col: str = "tool") -> DataFrame:
    """Rows whose tool is not in the registry (the reference's KeyError), as a report."""
    return df.join(checked_broadcast(registry.select(F.col("tool").alias(tool_col))), tool_col, "left_anti")


def wrong_tool_choice(key: Column, tool: Column, tools: list[str] | None = None, seed: int = K.SEED) -> Column:
    """One other tool name, picked by a seeded hash of the key (J-4 / P-6).

    The candidate list is the registry literal filtered by ``t <> tool``;
    no join is needed for a registry of fixed size.
    """
    names = F.array(*[F.lit(t) for t in (tools or K.TOOL_NAMES)])
    others = F.filter(names, lambda t: ~t.eqNullSafe(tool))
    pick = F.pmod(seeded_hash(key, F.lit("wrong_tool"), seed=seed), F.size(others)) + 1
    return F.when(F.size(others) > 0, F.element_at(others, pick.cast("int")))


def rejected_texts(key: Column, tool: Column, args_json: Column, chosen: Column, seed: int = K.SEED) -> list[Column]:
    """The six rejected answers of one prompt (P-4 .. P-9), a column each.

    1 prose with a seeded number, 2 wrong key names, 3 another tool, 4 prose
    around the correct JSON, 5 empty arguments, 6 truncated JSON.  Null
    arguments are JSON null; only variant 3 can be null (no other tool).
    """
    args_json = F.coalesce(args_json, F.lit("null"))
    chosen = F.coalesce(chosen, tool_call_json(tool, args_json))
    rnd = F.pmod(seeded_hash(key, F.lit("prose"), seed=seed), K.RANDOM_INT_HIGH - K.RANDOM_INT_LOW + 1) + K.RANDOM_INT_LOW
    prose = F.format_string(K.REJECT_PROSE_TEMPLATE, rnd)
    wrong_key = F.concat(F.lit('{"function":'), json_string(tool), F.lit(',"params":'), args_json, F.lit("}"))
    other = wrong_tool_choice(key, tool, seed=seed)
    wrong_tool = F.when(other.isNotNull(), tool_call_json(other, args_json))
    extra = F.concat(F.lit(K.REJECT_EXTRA_TEXT_PREFIX), chosen, F.lit(K.REJECT_EXTRA_TEXT_SUFFIX))
    empty_args = tool_call_json(tool, F.lit("{}"))
    truncated = F.concat(F.lit('{"tool": "'), F.coalesce(tool, F.lit("")), F.lit('", "arguments": {'))
    return [prose, wrong_key, wrong_tool, extra, empty_args, truncated]


def rejected_text(
    variant: Column, key: Column, tool: Column, args_json: Column, chosen: Column, seed: int = K.SEED
) -> Column:
    """The answer of ``rejected_texts`` that ``variant`` (1 to 6) numbers; the others are not made."""
    out = F.lit(None).cast("string")
    for i, text in reversed(list(enumerate(rejected_texts(key, tool, args_json, chosen, seed=seed), 1))):
        out = F.when(variant == i, text).otherwise(out)
    return out


def rejected_variants(
    key: Column, tool: Column, args_json: Column, chosen: Column, seed: int = K.SEED
) -> Column:
    """The answers of ``rejected_texts`` as array<struct<variant,text>>."""
    texts = rejected_texts(key, tool, args_json, chosen, seed=seed)
    # named_struct keeps the field names even next to a generator in one projection
    return F.array(*[F.named_struct(F.lit("variant"), F.lit(i + 1), F.lit("text"), t) for i, t in enumerate(texts)])


def expand_pairs(toolcalls: DataFrame, seed: int = K.SEED) -> DataFrame:
    """One tool call → up to six (chosen, rejected) pairs (P-10, P-12).

    Input columns: key, prompt, tool, arguments_json, chosen.  Output adds
    ``variant``, ``rejected`` and ``pair_id = key || '-' || variant``.
    Narrow: a ``Generate`` after the scan, no shuffle; it makes numbers only, and a pair makes the one text it has.
    """
    variants = [F.lit(i + 1) for i in range(K.N_REJECTED_VARIANTS)]
    no_other = wrong_tool_choice(F.col("key"), F.col("tool"), seed=seed).isNull()
    v = F.when(no_other, F.array(*[x for i, x in enumerate(variants, 1) if i != 3])).otherwise(F.array(*variants))
    rejected = rejected_text(F.col("variant"), F.col("key"), F.col("tool"), F.col("arguments_json"), F.col("chosen"), seed=seed)
    return toolcalls.select("*", F.explode(v).alias("variant")).select(
        "*", rejected.alias("rejected"), F.concat_ws("-", F.col("key"), F.col("variant").cast("string")).alias("pair_id"))


def message(role: Column | str, content: Column) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), content.alias("content"))


def preference_record(
    df: DataFrame,
    prompt: str = "prompt",
    chosen: str = "chosen",
    rejected: str = "rejected",
    system_prompt: str | None = K.PREFERENCE_SYSTEM_PROMPT,
) -> DataFrame:
    """Messages-form preference record (P-11): prompt/chosen/rejected arrays."""
    prompt_msgs = [message("user", F.col(prompt))]
    if system_prompt is not None:
        prompt_msgs.insert(0, message("system", F.lit(system_prompt)))
    return df.withColumns(
        {
            "prompt_messages": F.array(*prompt_msgs),
            "chosen_messages": F.array(message("assistant", F.col(chosen))),
            "rejected_messages": F.array(message("assistant", F.col(rejected))),
        }
    )


def preference_json_line(df: DataFrame) -> Column:
    """The JSONL line of a messages-form record (SRC-6 form)."""
    return F.to_json(
        F.struct(
            F.col("prompt_messages").alias("prompt"),
            F.col("chosen_messages").alias("chosen"),
            F.col("rejected_messages").alias("rejected"),
        )
    )


def string_to_messages_form(df: DataFrame) -> DataFrame:
    """String-form preference (id, prompt, chosen, rejected) → messages form (P-14)."""
    return df.select(
        "id",
        F.array(message("user", F.col("prompt"))).alias("prompt_messages"),
        F.array(message("assistant", F.col("chosen"))).alias("chosen_messages"),
        F.array(message("assistant", F.col("rejected"))).alias("rejected_messages"),
    )


def sft_calculator_record(idx: Column, expression: Column, answer: Column) -> Column:
    """SFT chat record for a calculator prompt (P-1)."""
    args = F.to_json(F.struct(expression.alias("expression")))
    return F.struct(
        F.format_string(K.SFT_CALC_ID_FORMAT, idx).alias("id"),
        F.array(
            message("system", F.lit(K.SFT_SYSTEM_PROMPT)),
            message("user", F.concat(F.lit(K.SFT_CALC_USER_TEMPLATE), expression)),
            message("assistant", tool_call_json(F.lit("calculator"), args)),
        ).alias("messages"),
        F.struct(F.lit("calculator").alias("task"), answer.alias("answer")).alias("meta"),
    )


def sft_json_validator_record(idx: Column, text: Column) -> Column:
    """SFT chat record for a JSON-validator prompt (P-2); JSON text nested in JSON text."""
    args = F.to_json(F.struct(text.alias("text")))
    return F.struct(
        F.format_string(K.SFT_JSON_ID_FORMAT, idx).alias("id"),
        F.array(
            message("system", F.lit(K.SFT_SYSTEM_PROMPT)),
            message("user", F.concat(F.lit(K.SFT_JSON_USER_TEMPLATE), text)),
            message("assistant", tool_call_json(F.lit("json_validator"), args)),
        ).alias("messages"),
        F.struct(F.lit("json_validator").alias("task"), F.lit(None).cast("string").alias("answer")).alias("meta"),
    )


def reward_record(chat: DataFrame) -> DataFrame:
    """Verifiable-reward record from an SFT chat record (P-13).

    prompt = last user message, expected tool / arguments from the last
    assistant tool call (arguments as canonical JSON text), answer from meta.
    """
    user = F.filter(F.col("messages"), lambda m: m["role"] == "user")
    asst = F.filter(F.col("messages"), lambda m: m["role"] == "assistant")
    df = chat.select(
        "id",
        F.try_element_at(user, F.lit(-1))["content"].alias("prompt"),
        F.try_element_at(asst, F.lit(-1))["content"].alias("_call"),
        F.col("meta.answer").alias("answer"),
    )
    df = jsonx.with_strict_json(df, "_call", "call")
    return df.select(
        "id",
        "prompt",
        jsonx.get_string(F.col("call_v"), "tool").alias("expected_tool"),
        F.to_json(jsonx.get_field(F.col("call_v"), "arguments")).alias("expected_arguments"),
        "answer",
    )
