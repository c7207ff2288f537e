"""Scoring and comparing model outputs (V-20, V-21, J-1, J-2, J-5, A-5 .. A-10,
A-22 .. A-24, A-27 .. A-29, FN-13, FN-17, SRC-13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ptloom import constants as K
from ptloom.functions import jsonx
from ptloom.functions.text import strip_ws


def evaluate_output(df: DataFrame, output_col: str = "output", expected_tool_col: str = "expected_tool",
                    tool_key: str = "tool", arguments_key: str = "arguments", compat: bool = False) -> DataFrame:
    """V-20: is_valid_json, has_tool_key, tool_correct, has_arguments (non-empty object).

    The text is stripped before parsing.  Key checks need an object; with
    ``compat=True`` a JSON array holding the string "tool" or a JSON string
    containing "tool" counts as having the key (the reference's membership
    test), which gives those outputs 0.6 instead of 0.4.
    """
    d = df.withColumn("_s", strip_ws(F.col(output_col)))
    d = jsonx.with_strict_json(d, "_s", "_e")
    d = d.withColumn("_o", F.try_variant_get(F.col("_e_v"), "$", "map<string,variant>"))
    o = F.col("_o")
    has_tool = F.coalesce(F.map_contains_key(o, F.lit(tool_key)), F.lit(False))
    if compat:
        arr = F.try_variant_get(F.col("_e_v"), "$", "array<variant>")
        in_array = F.coalesce(F.exists(arr, lambda x: jsonx.variant_string(x) == tool_key), F.lit(False))
        in_string = F.coalesce(jsonx.variant_string(F.col("_e_v")).contains(tool_key), F.lit(False))
        has_tool = has_tool | in_array | in_string
    tool_val = jsonx.variant_string(o[tool_key])
    n_args = jsonx.object_size(o[arguments_key])
    return d.select(
        *df.columns,
        F.col("_e_ok").alias("is_valid_json"),
        (F.col("_e_ok") & has_tool).alias("has_tool_key"),
        F.coalesce(F.col("_e_ok") & (tool_val == F.col(expected_tool_col)), F.lit(False)).alias("tool_correct"),
        F.coalesce(F.col("_e_ok") & (n_args > 0), F.lit(False)).alias("has_arguments"),
        F.to_json(o[arguments_key]).alias("_args_canon"),
    )


def score(df: DataFrame, out_col: str = "score") -> DataFrame:
    """A-5: 0.4 valid JSON + 0.2 tool key + 0.3 tool correct + 0.1 arguments, in
    integer tenths so the sum is exact (round(.., 2) of the float sum)."""
    w = K.SCORE_WEIGHTS_TENTHS
    tenths = (
        F.col("is_valid_json").cast("int") * w[0]
        + F.col("has_tool_key").cast("int") * w[1]
        + F.col("tool_correct").cast("int") * w[2]
        + F.col("has_arguments").cast("int") * w[3]
    )
    return df.withColumn(out_col, tenths / F.lit(10.0))


def exact_arguments(df: DataFrame, expected_args_col: str = "expected_arguments") -> DataFrame:
    """V-21: arguments equal the expected ones (canonical JSON: keys sorted)."""
    exp = F.to_json(F.try_parse_json(F.col(expected_args_col)))
    return df.withColumn("args_exact", F.coalesce(F.col("_args_canon") == exp, F.lit(False)))


def model_summary(scored: DataFrame, model_col: str = "model") -> DataFrame:
    """A-6 .. A-9, A-28: mean score (3 digits), pass rates, overall accuracy,
    answered rate and mean output length per model.

    ``args_acc`` is the share whose arguments equal the expected ones and
    ``overall_acc`` that of valid JSON, right tool and right arguments; both
    are null without ``args_exact`` (see ``exact_arguments``).
    ``has_args_rate`` is the share of non-empty arguments.
    """
    exact = F.col("args_exact") if "args_exact" in scored.columns else F.lit(None).cast("boolean")
    rate = lambda c: F.round(F.avg(c.cast("double")), 6)
    return scored.groupBy(model_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.round(F.avg("score"), K.MEAN_SCORE_DIGITS).alias("mean_score"),
        rate(F.col("is_valid_json")).alias("format_acc"),
        rate(F.col("tool_correct")).alias("tool_acc"),
        rate(F.col("has_arguments")).alias("has_args_rate"),
        rate(exact).alias("args_acc"),
        rate(exact & F.col("is_valid_json") & F.col("tool_correct")).alias("overall_acc"),
        rate(strip_ws(F.col("output")) != "").alias("answer_rate"),
        F.round(F.avg(F.char_length("output")), 6).alias("mean_len"),
    )


def arrow(diff: Column) -> Column:
    """↑ / ↓ / → by the sign of a difference (A-6)."""
    return F.when(diff > 0, "↑").when(diff < 0, "↓").otherwise("→")


def tick(flag: Column) -> Column:
    """FN-17: ✓ / ✗."""
    return F.when(flag, "✓").otherwise("✗")


def compare_models(scored: DataFrame, a: str, b: str, key_col: str = "prompt_id", model_col: str = "model",
                   extra_cols: list[str] | None = None) -> DataFrame:
    """J-2 / A-10 / SRC-13 detail: one row per prompt with both models' flags and
    scores, outputs and answered flags (pivot on the model, one shuffle on the
    prompt key).  ``extra_cols`` are per-prompt attributes carried along (e.g.
    the prompt text).  A model with several outputs for a prompt shows the
    best-scored one (ties: least text), and ``{model}_n_outputs`` counts them."""
    cols = ["is_valid_json", "has_tool_key", "tool_correct", "has_arguments", "score", "output", "answered"]
    extra = list(extra_cols or [])
    d = scored.withColumn("answered", F.coalesce(strip_ws(F.col("output")) != "", F.lit(False)))
    best = F.min_by(F.struct(*cols), F.struct(-F.col("score"), "output"))
    p = d.groupBy(key_col, *extra).pivot(model_col, [a, b]).agg(best.alias("best"), F.count(F.lit(1)).alias("n_outputs"))
    p = p.select(key_col, *extra, *[F.col(f"{m}_best.{c}").alias(f"{m}_{c}") for m in (a, b) for c in cols],
                 *[F.coalesce(f"{m}_n_outputs", F.lit(0)).cast("bigint").alias(f"{m}_n_outputs") for m in (a, b)])
    out = p.select(
        key_col, *extra,
        *[F.col(f"{m}_{c}") for m in (a, b) for c in [*cols, "n_outputs"]],
        (F.col(f"{b}_score") - F.col(f"{a}_score")).alias("_d"),
    )
    return out.withColumn("diff_tenths", F.round(F.col("_d") * 10).cast("bigint")).withColumn(
        "direction", arrow(F.col("_d"))
    ).withColumn("tick_a", tick(F.col(f"{a}_is_valid_json"))).withColumn("tick_b", tick(F.col(f"{b}_is_valid_json"))).drop("_d")


def win_rate(compared: DataFrame, a: str, b: str) -> DataFrame:
    """A-22 / A-24: share where b beats a, ties apart; improved / regressed counts."""
    d = F.col(f"{b}_score") - F.col(f"{a}_score")
    return compared.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(F.when(d > 0, 1).otherwise(0)).cast("bigint").alias("n_improved"),
        F.sum(F.when(d < 0, 1).otherwise(0)).cast("bigint").alias("n_regressed"),
        F.sum(F.when(d == 0, 1).otherwise(0)).cast("bigint").alias("n_tied"),
        F.round(F.avg(F.when(d > 0, 1.0).otherwise(0.0)), 6).alias("win_rate"),
        F.round(F.avg(F.when(d == 0, 1.0).otherwise(0.0)), 6).alias("tie_rate"),
    )


def text_stats(df: DataFrame, text_col: str, known_words: DataFrame | None = None, n: int = 3) -> DataFrame:
    """A-27 / A-29 per row: word n-gram repetition, line breaks, speaker-style
    lines ('Name:' at a line start), punctuation share."""
    from ptloom.functions.text import word_ngrams

    # the words are a column of their own: inside the n-grams' lambda the text would be split again for each n-gram
    d = df.withColumn("_w", F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"\S+"), F.lit(0)))
    words = F.col("_w")
    # a text of at most n words has one n-gram or none
    rep = F.when(F.size(words) > n, 1 - F.size(F.array_distinct(word_ngrams(words, n))) / (F.size(words) - (n - 1))).otherwise(F.lit(0.0))
    nchar = F.char_length(F.col(text_col))
    punct = F.char_length(F.regexp_replace(F.col(text_col), r"[^\p{Punct}]+", ""))
    return d.withColumns({
        "n_words": F.size(words).cast("bigint"),
        "repetition": rep.cast("double"),
        "n_line_breaks": (nchar - F.char_length(F.replace(F.col(text_col), F.lit("\n"), F.lit("")))).cast("bigint"),
        "n_speaker_lines": F.regexp_count(F.col(text_col), F.lit(r"(?m)^[A-Z][A-Za-z]*:")).cast("bigint"),
        "punct_share": F.when(nchar > 0, punct / nchar).otherwise(F.lit(0.0)),
    }).drop("_w")
