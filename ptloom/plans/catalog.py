"""The query catalog: one callable (spark, sf_dir) -> DataFrame per operator group.

Every query reads the driver tables (or inputs Spark derives from them) in
full; no id subsets, samples or row caps.  Limits appear only where the limit
is the feature (head-n preview, top-k).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ptloom import constants as K
from ptloom.operators import build, classify, validate
from ptloom.plans import derived
from ptloom.session import stored_table
from ptloom.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


@query
def pref_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: build pairs, write them as JSONL text, validate and classify the
    text, report per tool and rejected type (P-3..P-12, SRC-6, V-11..V-17, A-2, A-3, W-1)."""
    t = Tables(spark, sf_dir)
    from ptloom.sources.textio import as_text_lines

    recs = build.preference_record(derived.pairs(t))
    lines = as_text_lines(recs, build.preference_json_line(recs), ["tool"])
    checked = validate.validate_preference(lines)
    agg = checked.groupBy("tool", "rejected_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum("n_errors").cast("bigint").alias("n_errors"),
    )
    from pyspark.sql import Window

    w = Window.partitionBy("tool")
    return agg.select(
        "tool", "rejected_type", "n", F.round(F.col("n") / F.sum("n").over(w), 6).alias("share"), "n_errors"
    )


# ------------------------------------------------------------ preference data
@query
def toolcalls_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-1/P-3/P-12, U-2: tool-call prompts and chosen answers from five tables."""
    return derived.toolcalls(Tables(spark, sf_dir))


@query
def tool_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-3: registry lookup (broadcast of the five-row registry) and unknown-tool report."""
    tc = derived.toolcalls(Tables(spark, sf_dir))
    reg = build.tool_registry(spark)
    per_tool = tc.groupBy("tool").agg(F.count(F.lit(1)).cast("bigint").alias("n_prompts"))
    # one left join to the five-row registry: a tool without a registry row is the
    # unknown-tool report (the reference's KeyError)
    j = per_tool.join(F.broadcast(reg), "tool", "left")
    return j.select(
        "tool", "description", F.size("arg_keys").cast("bigint").alias("n_arg_keys"), "n_prompts",
        F.col("arg_keys").isNull().alias("unknown"),
    ).withColumn("n_arg_keys", F.when(F.col("unknown"), F.lit(None).cast("bigint")).otherwise(F.col("n_arg_keys")))


@query
def pref_pairs_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-4..P-11, J-4, SRC-6: every pair as its JSONL record text."""
    recs = build.preference_record(derived.pairs(Tables(spark, sf_dir)))
    return recs.select("pair_id", "key", "variant", "rejected", build.preference_json_line(recs).alias("record"))


@query
def rejected_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-3, A-4, W-1: rejected-type counts, bar length and maximum over all pairs."""
    p = classify.classify_rejected(derived.pairs(Tables(spark, sf_dir)), "rejected")
    return classify.type_distribution(p)


@query
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-12: the rejected types are not all one type."""
    p = classify.classify_rejected(derived.pairs(Tables(spark, sf_dir)), "rejected")
    return classify.class_balance(p)


def _rules(errors_col: str = "errors") -> F.Column:
    return F.array_join(F.array_sort(F.transform(errors_col, lambda e: e["rule"])), ",")


@query
def pref_validate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-11..V-17 on damaged JSONL text: per-line errors, warnings and class."""
    raw = derived.raw_pair_lines(Tables(spark, sf_dir))
    v = validate.validate_preference(raw)
    return v.select("line_id", "file", "n_errors", "n_warnings", "rejected_type", _rules().alias("rules"))


@query
def pref_rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-12, V-14, V-17: the rules and labels that ``pref_validate_lines`` does not meet (not_object, not_list,
    message_not_object, missing_role, missing_content, content_not_string, extra_text_pollution, other)."""
    v = validate.validate_preference(derived.pref_rule_lines(Tables(spark, sf_dir)))
    return v.select("line_id", "file", "n_errors", "n_warnings", "rejected_type", _rules().alias("rules"))


@query
def pref_strict_role_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-13: the same lines under the role list of each field (``strict_roles``)."""
    v = validate.validate_preference(derived.pref_rule_lines(Tables(spark, sf_dir)), strict_roles=True)
    return v.select("line_id", "n_errors", _rules().alias("rules"))


@query
def pref_file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-2, SRC-8, U-5: examples, errors and warnings per file in one multi-file pass."""
    raw = derived.raw_pair_lines(Tables(spark, sf_dir))
    return validate.preference_file_summary(validate.validate_preference(raw))


@query
def pref_string_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-14: string-form preference rows converted to messages form."""
    p = derived.pairs(Tables(spark, sf_dir)).select(
        F.col("pair_id").alias("id"), "prompt", F.col("chosen"), F.col("rejected")
    )
    m = build.string_to_messages_form(p)
    return m.select(
        "id",
        F.to_json("prompt_messages").alias("prompt_json"),
        F.to_json("chosen_messages").alias("chosen_json"),
        F.to_json("rejected_messages").alias("rejected_json"),
    )


# ------------------------------------------------------------------ chat data
@query
def chat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-15: conversations grouped into records."""
    c = derived.chat(Tables(spark, sf_dir))
    return c.select("conv_id", F.size("messages").cast("bigint").alias("n_messages"),
                    F.to_json("messages").alias("messages_json"))


@query
def messages_to_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-16: records back to one row per turn (round trip of P-15)."""
    from ptloom.operators.chat import records_to_turns

    return records_to_turns(derived.chat(Tables(spark, sf_dir)))


@query
def chat_validate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-1..V-10, SRC-1..SRC-4: chat validator on damaged JSONL text."""
    v = validate.validate_chat(derived.raw_chat_lines(Tables(spark, sf_dir)))
    return v.select("line_id", "n_errors", _rules().alias("rules"))


@query
def chat_rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-4..V-6: the rules that ``chat_validate_lines`` does not meet (messages that are no objects,
    roles and contents that are no text)."""
    v = validate.validate_chat(derived.chat_rule_lines(Tables(spark, sf_dir)))
    return v.select("line_id", "n_errors", _rules().alias("rules"))


@query
def chat_validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1: checked count, failed records, errors, OK/FAILED verdict."""
    v = validate.validate_chat(derived.raw_chat_lines(Tables(spark, sf_dir)))
    return validate.chat_summary(v)


@query
def chat_error_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U-3: one row per error (rule, message index)."""
    v = validate.validate_chat(derived.raw_chat_lines(Tables(spark, sf_dir)))
    e = validate.error_table(v, ["line_id"])
    return e.groupBy("rule").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                 F.countDistinct("line_id").cast("bigint").alias("n_lines"))


@query
def prompt_only_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-17, V-22: assistant tail dropped; validated with the prompt profile."""
    from ptloom.operators.chat import prompt_only

    c = derived.chat(Tables(spark, sf_dir))
    p = c.select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("id"),
        prompt_only(F.col("messages")).alias("messages"),
    )
    lines = p.select("id", "messages", F.to_json(F.struct("id", "messages")).alias("value"))
    v = validate.validate_chat(lines, require_assistant=False)
    return v.select("id", F.size("messages").cast("bigint").alias("n_messages"), "n_errors", _rules().alias("rules"))


@query
def chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-18, P-19: ChatML rendering, with and without the generation prompt."""
    from ptloom.operators.chat import prompt_only, render

    c = derived.chat(Tables(spark, sf_dir))
    full = render(F.col("messages"))
    gen = render(prompt_only(F.col("messages")), add_generation_prompt=True)
    return c.select(
        "conv_id",
        F.char_length(full).cast("bigint").alias("n_chars"),
        F.md5(full).alias("text_md5"),
        F.char_length(gen).cast("bigint").alias("n_chars_prompt"),
        F.md5(gen).alias("prompt_md5"),
    )


@query
def sft_records_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-1, P-2, U-1, FN-12: calculator records from orders plus JSON-validator records
    from event properties, appended."""
    t = Tables(spark, sf_dir)
    o = t.orders
    factor = F.pmod(F.col("o_orderkey"), F.lit(97)) + 2
    expr = F.concat(F.col("o_custkey").cast("string"), F.lit(" * "), factor.cast("string"))
    calc = o.select(build.sft_calculator_record(F.col("o_orderkey"), expr,
                                                (F.col("o_custkey") * factor).cast("string")).alias("r"))
    js = t.events.select(build.sft_json_validator_record(F.col("event_id"), F.col("props")).alias("r"))
    u = calc.unionByName(js)
    return u.select(
        F.col("r.id").alias("id"), F.col("r.meta.task").alias("task"), F.col("r.meta.answer").alias("answer"),
        F.to_json("r.messages").alias("messages_json"),
    )


@query
def reward_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-13: verifiable-reward records derived from the SFT records of both tasks."""
    t = Tables(spark, sf_dir)
    o = t.orders
    factor = F.pmod(F.col("o_orderkey"), F.lit(97)) + 2
    expr = F.concat(F.col("o_custkey").cast("string"), F.lit(" * "), factor.cast("string"))
    sft = o.select(build.sft_calculator_record(F.col("o_orderkey"), expr,
                                               (F.col("o_custkey") * factor).cast("string")).alias("r"))
    js = t.events.select(build.sft_json_validator_record(F.col("event_id"), F.col("props")).alias("r"))
    return build.reward_record(sft.unionByName(js).select("r.*"))


# --------------------------------------------------------------------- splits
@query
def hash_split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-5: group-safe split of pairs by prompt key (10 % val)."""
    from ptloom.operators.split import hash_split

    p = derived.pairs(Tables(spark, sf_dir)).select("pair_id", "key")
    return hash_split(p, "key", 0.1)


@query
def exact_split_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-2: exact-count split of chat records, val = max(1, round_half_even(n*0.2))."""
    from ptloom.operators.split import exact_split

    c = derived.chat(Tables(spark, sf_dir)).select(F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("line_id"))
    return exact_split(c, "line_id", 0.2, rounding="half_even")


@query
def exact_split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-3: exact-count split of pairs, val = max(1, int(n*0.1))."""
    from ptloom.operators.split import exact_split

    p = derived.pairs(Tables(spark, sf_dir)).select("pair_id")
    return exact_split(p, "pair_id", 0.1, rounding="floor")


@query
def split_check_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-6, U-4: the exact split is a partition (no overlap, nothing lost or added)."""
    from ptloom.operators.split import exact_split, split_check

    p = derived.pairs(Tables(spark, sf_dir)).select("pair_id")
    return split_check(exact_split(p, "pair_id", 0.1, rounding="floor"), p, "pair_id")


@query
def seeded_shuffle_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-1, L-6, SRC-14: first 8 pairs of the seeded permutation (the limit is the feature)."""
    from pyspark.sql import Window

    from ptloom.operators.split import head, seeded_order_key

    p = derived.pairs(Tables(spark, sf_dir)).withColumn("_ord", seeded_order_key("pair_id"))
    top = head(p, ["_ord", "pair_id"], 8)
    return top.select("pair_id", "rejected", F.row_number().over(Window.orderBy("_ord", "pair_id")).cast("bigint").alias("pos"))


@query
def seeded_shuffle_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-1: every pair's place in the seeded permutation."""
    from ptloom.operators.split import seeded_shuffle

    return seeded_shuffle(derived.pairs(Tables(spark, sf_dir)).select("pair_id"), "pair_id", pos_col="pos").select("pair_id", "pos")


@query
def contiguous_split_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-4: per source, first 90 % of characters (by doc_id) train, rest val."""
    from ptloom.operators.split import contiguous_split

    d = Tables(spark, sf_dir).documents.select("doc_id", "source", "n_chars")
    return contiguous_split(d, "source", "doc_id", "n_chars", 0.9).select("doc_id", "source", "split")


# ------------------------------------------------------------------ evaluation
def _scored(spark: SparkSession, sf_dir: str, compat: bool = False) -> DataFrame:
    from ptloom.operators import evaluate as ev

    o = derived.outputs(Tables(spark, sf_dir))
    return ev.exact_arguments(ev.score(ev.evaluate_output(o, compat=compat)))


@query
def output_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-20, V-21, A-5, FN-13: per-output checks, exact-arguments flag and score."""
    s = _scored(spark, sf_dir)
    return s.select("model", "prompt_id", "is_valid_json", "has_tool_key", "tool_correct", "has_arguments",
                    "args_exact", "score")


@query
def model_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-6 .. A-9, A-28: per-model mean score, pass rates, answer rate, length."""
    from ptloom.operators import evaluate as ev

    return ev.model_summary(_scored(spark, sf_dir))


@query
def model_compare_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-2, A-10, SRC-13 detail: per prompt, base vs tuned flags, scores, outputs and answered flags."""
    from ptloom.operators import evaluate as ev

    return ev.compare_models(_scored(spark, sf_dir), "base", "tuned", extra_cols=["prompt", "expected_tool"])


@query
def model_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-6, FN-17: mean scores, difference (3 digits), arrow and signed text."""
    from ptloom.operators import evaluate as ev

    s = ev.model_summary(_scored(spark, sf_dir)).select("model", "mean_score")
    p = s.groupBy().pivot("model", ["base", "tuned"]).agg(F.first("mean_score"))
    diff = F.round(F.col("tuned") - F.col("base"), 3)
    return p.select(
        F.col("base").alias("base_mean"), F.col("tuned").alias("tuned_mean"), diff.alias("diff"),
        ev.arrow(diff).alias("direction"), F.format_string("%+.3f", diff).alias("diff_text"),
    )


@query
def win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-22, A-24: tuned-vs-base win rate, ties apart; improved / regressed counts."""
    from ptloom.operators import evaluate as ev

    return ev.win_rate(ev.compare_models(_scored(spark, sf_dir), "base", "tuned"), "base", "tuned")


@query
def improved_regressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-24: the prompts whose score changed, largest change first."""
    from ptloom.operators import evaluate as ev

    c = ev.compare_models(_scored(spark, sf_dir), "base", "tuned", extra_cols=["prompt"])
    return c.where(F.col("diff_tenths") != 0).select(
        "prompt_id", F.substring("prompt", 1, 50).alias("prompt_preview"),  # FN-16 display prefix
        "diff_tenths", F.when(F.col("diff_tenths") > 0, "improved").otherwise("regressed").alias("kind")
    ).orderBy(F.abs("diff_tenths").desc(), "prompt_id")


@query
def reward_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-5, V-21, A-23: outputs joined to the expected tool/arguments; average
    exact-match reward and average weighted score per model."""
    from ptloom.operators import evaluate as ev

    t = Tables(spark, sf_dir)
    outs = derived.outputs(t).select("model", "prompt_id", "output")
    expected = derived.toolcalls(t).select(
        F.col("key").alias("prompt_id"), F.col("tool").alias("expected_tool"),
        F.col("arguments_json").alias("expected_arguments"),
    )
    j = outs.join(expected, "prompt_id", "inner")
    s = ev.exact_arguments(ev.score(ev.evaluate_output(j)))
    reward = (F.col("tool_correct") & F.col("args_exact")).cast("double")
    return s.groupBy("model").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.round(F.avg(reward), 6).alias("avg_reward"),
        F.round(F.avg("score"), 6).alias("avg_score"),
    )


@query
def positional_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-1: base and tuned outputs paired by prompt id with a full outer join;
    unmatched rows are counted instead of silently dropped."""
    o = derived.outputs(Tables(spark, sf_dir))
    a = o.where(F.col("model") == "base").select("prompt_id", F.col("output").alias("base_output"))
    b = o.where(F.col("model") == "tuned").select("prompt_id", F.col("output").alias("tuned_output"))
    j = a.join(b, "prompt_id", "full_outer")
    return j.agg(
        F.sum(F.when(F.col("base_output").isNotNull() & F.col("tuned_output").isNotNull(), 1).otherwise(0)).cast("bigint").alias("n_matched"),
        F.sum(F.when(F.col("tuned_output").isNull(), 1).otherwise(0)).cast("bigint").alias("n_only_base"),
        F.sum(F.when(F.col("base_output").isNull(), 1).otherwise(0)).cast("bigint").alias("n_only_tuned"),
        F.sum(F.when(F.col("base_output") == F.col("tuned_output"), 1).otherwise(0)).cast("bigint").alias("n_same_output"),
    )


@query
def format_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-18, V-19: JSON validity (no stripping) and tool-call shape, with the key
    name as a parameter (``tool`` and the stub's ``tool_name``)."""
    from ptloom.operators.classify import tool_call_shapes

    o = derived.outputs(Tables(spark, sf_dir))
    # one parse per output feeds all three checks
    o = tool_call_shapes(o, "output", {"shape_tool": "tool", "shape_tool_name": "tool_name"}, ok_col="json_ok")
    rate = lambda c: F.round(F.avg(F.col(c).cast("double")), 6)
    return o.groupBy("model").agg(rate("json_ok").alias("json_rate"), rate("shape_tool").alias("tool_shape_rate"),
                                  rate("shape_tool_name").alias("tool_name_shape_rate"))


@query
def output_text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-27, A-28, A-29: repetition, length, line breaks, punctuation share and the
    share of output words known from the document corpus (left-semi join)."""
    from ptloom.operators import evaluate as ev

    t = Tables(spark, sf_dir)
    # the outputs are derived once: each distinct text of a model with its number of rows
    o = stored_table(derived.outputs(t).groupBy("model", "output").agg(F.count(F.lit(1)).alias("c")))
    s = ev.text_stats(o, "output")
    n, all_n = F.col("c"), F.sum("c")
    per_model = s.groupBy("model").agg(
        F.round(F.sum(F.col("repetition") * n) / all_n, 6).alias("mean_repetition"),
        F.round(F.sum(F.char_length("output") * n) / all_n, 6).alias("mean_len"),
        F.sum(F.col("n_line_breaks") * n).cast("bigint").alias("n_line_breaks"),
        F.sum(F.col("n_speaker_lines") * n).cast("bigint").alias("n_speaker_lines"),
        F.round(F.sum(F.col("punct_share") * n) / all_n, 6).alias("mean_punct_share"),
    )
    # words are counted before the join, so a very common one is a row per model, not a hot key
    words = lambda d, c: d.withColumn("w", F.explode(F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+"), F.lit(0))))
    counts = stored_table(words(o, "output").groupBy("w", "model").agg(F.sum("c").alias("c")))
    # of the corpus only words of the outputs are kept; with few of them Spark sorts out the others before it groups
    corpus = words(t.documents.select("text"), "text").groupBy("w").agg(F.lit(1).alias("seen")).join(counts.select("w"), "w", "left_semi")
    shares = counts.join(corpus, "w", "left").groupBy("model").agg(
        F.round(F.sum(F.when(F.col("seen") == 1, F.col("c")).otherwise(0)) / F.sum("c"), 6).alias("known_word_share"))
    return per_model.join(shares, "model", "left")


# --------------------------------------------------------------------- tokens
def _docs_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).documents.withColumn("split", derived.doc_split(0.1))


@query
def char_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-16, SRC-9: character vocabulary of the corpus, frequency and ids."""
    from ptloom.operators import tokens

    return tokens.char_vocab(Tables(spark, sf_dir).documents)


@query
def encode_decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-9, FN-10, V-23: vocabulary from the train split; every document is encoded
    to token ids and decoded back inside its own row (a broadcast table of bounded
    size, no row for a character); a document round-trips when its text comes back."""
    from ptloom.operators import codec, tokens

    d = _docs_split(spark, sf_dir)
    chars, ids = codec.collect_vocabulary(tokens.char_vocab(d.where(F.col("split") == "train")))
    enc = d.select("split", "text", codec.char_encoder(spark, chars, ids)(F.col("text")).alias("ids"))
    dec = enc.select("*", codec.decoder(spark, dict(zip(chars, ids)))(F.col("ids")).alias("decoded"))
    n_tok = F.coalesce(F.size("ids"), F.lit(0))
    return dec.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.sum(F.col("decoded").eqNullSafe(F.col("text")).cast("int")).cast("bigint").alias("n_roundtrip_ok"),
        F.sum(n_tok).cast("bigint").alias("n_tokens"),
        F.sum(n_tok - F.coalesce(F.size(F.array_compact("ids")), F.lit(0))).cast("bigint").alias("n_unknown"),
    )


@query
def token_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-14, A-15: token and word counts per language: mean, max, median, p90."""
    from ptloom.operators import tokens

    return tokens.length_stats(Tables(spark, sf_dir).documents, "lang")


@query
def overlength_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-24, L-9: documents over 1024 tokens and tokens lost by truncation, per language."""
    from ptloom.operators import tokens

    d = Tables(spark, sf_dir).documents
    over, lost = tokens.truncation(F.char_length("text"), 1024)
    return d.groupBy("lang").agg(
        F.sum(over.cast("int")).cast("bigint").alias("n_over"),
        F.sum(lost).cast("bigint").alias("n_lost_tokens"),
    )


@query
def overlength_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V-24: chat samples whose prompt exceeds 512 tokens, whose whole sample exceeds
    1024, and whether the cut hits or removes the final answer."""
    from ptloom.operators.chat import prompt_only, render

    c = derived.chat(Tables(spark, sf_dir))
    full = F.char_length(render(F.col("messages")))
    prompt = F.char_length(render(prompt_only(F.col("messages"))))
    d = c.select(full.alias("n_full"), prompt.alias("n_prompt"))
    return d.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_samples"),
        F.sum(F.when(F.col("n_prompt") > 512, 1).otherwise(0)).cast("bigint").alias("n_prompt_over"),
        F.sum(F.when(F.col("n_full") > 1024, 1).otherwise(0)).cast("bigint").alias("n_truncated"),
        F.sum(F.when((F.col("n_full") > 1024) & (F.col("n_prompt") < 1024), 1).otherwise(0)).cast("bigint").alias("n_answer_cut"),
        F.sum(F.when(F.col("n_prompt") >= 1024, 1).otherwise(0)).cast("bigint").alias("n_answer_lost"),
    )


@query
def next_token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-2: next-token targets as (token, next) counts over the whole corpus."""
    from ptloom.operators import tokens

    return tokens.next_token_pairs(Tables(spark, sf_dir).documents)


@query
def context_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-3: 256-token context blocks per document with shifted targets."""
    from ptloom.operators import tokens

    b = tokens.blocks(Tables(spark, sf_dir).documents, 256)
    return b.select("doc_id", "block_no", "n_tokens", F.md5("input_text").alias("input_md5"),
                    F.md5("target_text").alias("target_md5"))


@query
def label_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-10: input ids, labels with prompt turns masked to -100, attention mask."""
    from ptloom.operators import tokens

    c = derived.chat(Tables(spark, sf_dir))
    m = c.select("conv_id", tokens.label_mask(F.col("messages")).alias("t"))
    kept = F.filter("t.labels", lambda x: x != K.IGNORE_INDEX)
    return m.select(
        "conv_id",
        F.size("t.input_ids").cast("bigint").alias("n_tokens"),
        F.size(kept).cast("bigint").alias("n_label_tokens"),
        F.aggregate(kept, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("sum_label_ids"),
        ((F.size("t.input_ids") == F.size("t.labels")) & (F.size("t.labels") == F.size("t.attention_mask"))).alias("lengths_equal"),
    )


def _chat_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ptloom.functions.hashing import seeded_hash
    from ptloom.operators.chat import render

    c = derived.chat(Tables(spark, sf_dir))
    key = F.concat(F.lit("conv-"), F.col("conv_id").cast("string"))
    text = render(F.col("messages"))
    return c.select(
        "conv_id", F.pmod(seeded_hash(key), F.lit(4)).alias("bucket"),
        F.char_length(text).cast("bigint").alias("n_tok"), text.alias("text"),
    )


@query
def padding_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-7, L-8: length-sorted batches of 8 inside 4 hash buckets; every sample is
    padded to its batch maximum (ids + attention mask) and padding is counted."""
    from ptloom.operators import tokens
    from ptloom.operators.ordered import row_number_in_group

    d = row_number_in_group(_chat_lengths(spark, sf_dir), ["bucket"], ["n_tok", "conv_id"], out_col="rn")
    d = d.withColumn("batch_id", F.floor((F.col("rn") - 1) / 8).cast("bigint"))
    # batch maxima: one row per batch of 8, joined back on the (bucket, batch) key
    mx = d.groupBy("bucket", "batch_id").agg(F.max("n_tok").alias("max_len"))
    p = d.join(mx, ["bucket", "batch_id"]).withColumn("_pad", F.struct(*[
        c.alias(n) for c, n in zip(tokens.pad_to(tokens.code_points(F.col("text")), F.col("max_len")),
                                   ["input_ids", "attention_mask"])]))
    p = p.select("bucket", "batch_id", "n_tok", "max_len",
                 F.size("_pad.input_ids").alias("padded_len"),
                 F.size(F.filter("_pad.attention_mask", lambda x: x == 0)).alias("n_pad_tok"))
    b = p.groupBy("bucket", "batch_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_samples"),
        F.max("max_len").cast("bigint").alias("max_len"),
        F.sum("n_tok").cast("bigint").alias("sum_len"),
        F.sum("n_pad_tok").cast("bigint").alias("n_pad"),
    )
    return b.withColumn("pad_share", F.round(F.col("n_pad") / (F.col("n_samples") * F.col("max_len")), 6))


@query
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-7: effective batch = device batch 4 x accumulation 2; steps per epoch."""
    d = _chat_lengths(spark, sf_dir)
    eff = 4 * 2
    return d.agg(F.count(F.lit(1)).cast("bigint").alias("n_samples")).select(
        "n_samples", F.lit(eff).cast("bigint").alias("effective_batch"),
        F.ceil(F.col("n_samples") / eff).cast("bigint").alias("steps_per_epoch"),
    )


@query
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-11: concat-and-chunk packing in 8 hash buckets: every pack of 4096 tokens with
    the documents it touches, those that start in it and its tokens (all packs are
    full but the last of a bucket)."""
    from ptloom.functions.hashing import seeded_hash
    from ptloom.operators import tokens

    d = Tables(spark, sf_dir).documents.select(
        "doc_id", F.pmod(seeded_hash(F.col("doc_id").cast("string")), F.lit(8)).alias("bucket"),
        F.col("n_chars").alias("n_tok"),
    )
    return tokens.pack(d, 4096, "bucket", "doc_id", "n_tok").groupBy("bucket", "pack_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.sum((F.col("start") == 0).cast("int")).cast("bigint").alias("n_docs_starting"),
        F.sum(F.col("end") - F.col("start")).cast("bigint").alias("n_tokens"),
    )


BPE_MERGES = 10


@query
def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-11: the packs of ``packing`` as sequences of 4096 character ids, with segment
    numbers and positions that restart in each document; digests of all three."""
    from ptloom.functions.hashing import seeded_hash
    from ptloom.operators import codec, tokens

    d = Tables(spark, sf_dir).documents
    to_ids = codec.char_encoder(spark, *codec.collect_vocabulary(tokens.char_vocab(d)))
    d = d.select("doc_id", F.pmod(seeded_hash(F.col("doc_id").cast("string")), F.lit(8)).alias("bucket"), to_ids(F.col("text")).alias("ids"))
    p = tokens.packed_sequences(d, 4096, "bucket", "doc_id")
    digest = lambda c: F.md5(F.array_join(F.col(c).cast("array<string>"), ",")).alias(f"{c}_md5")
    return p.select("bucket", "pack_id", F.size("input_ids").cast("bigint").alias("n_tokens"), F.array_max("segment_ids").cast("bigint").alias("n_segments"),
                    digest("input_ids"), digest("segment_ids"), digest("position_ids"))


@query
def truncated_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-9, V-24: every chat sample cut to 512 tokens on the side that spares the answer:
    where the cut lies, the ids that are left and the tokens lost per role."""
    from ptloom.operators import tokens

    t = derived.chat(Tables(spark, sf_dir)).select("conv_id", tokens.truncate_chat(F.col("messages"), 512).alias("t"))
    lost = lambda role: F.aggregate("t.lost", F.lit(0), lambda acc, x: acc + F.when(x["role"] == role, x["n_lost"]).otherwise(0)).cast("bigint").alias(f"lost_{role}")
    return t.select("conv_id", F.col("t.n_tokens").cast("bigint").alias("n_tokens"), F.col("t.cut_start").cast("bigint").alias("cut_start"),
                    F.size("t.input_ids").cast("bigint").alias("n_kept"), F.md5(F.array_join(F.col("t.input_ids").cast("array<string>"), ",")).alias("ids_md5"),
                    F.size(F.filter("t.labels", lambda x: x != K.IGNORE_INDEX)).cast("bigint").alias("n_label_tokens"), "t.answer_kept",
                    *[lost(r) for r in ("system", "user", "assistant")])


@query
def bpe_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-17: the first 10 BPE merges learned on the whole document corpus, by an index
    from pair to words, so that a round reads only the words it changes."""
    from ptloom.operators.bpe import train_bpe

    return train_bpe(spark, Tables(spark, sf_dir).documents, BPE_MERGES)


def _bpe(spark: SparkSession, docs: DataFrame):
    """The learned tokenizer: encoder column function and the tokens' ids."""
    from ptloom.operators import bpe, codec, tokens

    chars, ids = codec.collect_vocabulary(tokens.char_vocab(docs))
    merges = [(r["a"], r["b"]) for r in bpe.train_bpe(spark, docs, BPE_MERGES).orderBy("rank").collect()]
    return codec.bpe_encoder(spark, chars, ids, merges), dict(zip(chars, ids)) | codec.merged_ids(ids, merges), len(ids)


@query
def bpe_encode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-9, FN-10, V-23: every document encoded with the merges learned on the corpus and
    decoded again; tokens, merged tokens, sum of ids and exact round trips per language."""
    from ptloom.operators import codec

    d = Tables(spark, sf_dir).documents
    encode, known, n_chars = _bpe(spark, d)
    told = codec.round_trip(encode, codec.decoder(spark, known), *codec.id_totals(spark, n_chars))
    enc = d.select("lang", told(F.col("text")).alias("s")).select("lang", "s.*")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return enc.groupBy("lang").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        total("n_tokens").alias("n_tokens"),
        total("n_merged").alias("n_merged_tokens"),
        total("id_sum").alias("sum_ids"),
        F.sum(F.col("same").cast("int")).cast("bigint").alias("n_roundtrip_ok"),
    )


@query
def token_counts_by_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-15: token counts per language and tokenizer (bytes, characters, words, learned BPE),
    all tokenizers in one pass over the texts, with ratios to words and to characters."""
    from ptloom.operators import tokens

    d = Tables(spark, sf_dir).documents
    encode, _, _ = _bpe(spark, d)
    return tokens.counts_by_tokenizer(d, {
        "byte": F.octet_length("text"), "char": F.char_length("text"), "word": tokens.n_words(F.col("text")),
        "bpe": F.size(encode(F.col("text"))),
    }, "lang")


# ----------------------------------------------------------------------- runs
def _runlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.runlog(Tables(spark, sf_dir))


@query
def loss_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-18: first / last / best losses per run, total drop and train-val gap."""
    from ptloom.operators import runs

    return runs.loss_table(_runlog(spark, sf_dir))


@query
def experiment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-19: one row per run joined to its parameter table (broadcast, size-checked)."""
    from ptloom.operators import runs

    rl = _runlog(spark, sf_dir)
    return runs.experiment_summary(rl, runs.run_params(rl))


@query
def sweep_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-20: mean loss per beta (rows) and split (columns)."""
    from ptloom.operators import runs

    rl = _runlog(spark, sf_dir)
    return runs.sweep_pivot(rl, runs.run_params(rl))


@query
def gpu_cost_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-21: GPU hours and cost by stage and GPU with subtotals (rollup)."""
    from ptloom.operators import runs

    return runs.gpu_cost(derived.gpu_log(Tables(spark, sf_dir)))


@query
def step_time_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-30: step time per run for training steps, evaluation steps apart, and the
    change of each run against the mean over runs."""
    from ptloom.operators import runs

    return runs.step_time_summary(_runlog(spark, sf_dir))


@query
def run_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-30: every training point of the other runs beside the last point of the run ``click`` at or before
    the same share of progress (as-of join), with the change; points without a match are reported."""
    from ptloom.operators import runs

    return runs.align_runs(_runlog(spark, sf_dir), "click")


@query
def loss_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-4, W-5: change since the previous evaluation and new-best flag (one skew-safe scan)."""
    from ptloom.operators import runs

    return runs.loss_deltas(_runlog(spark, sf_dir))


@query
def overfit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-6: points where train loss falls while val loss rises."""
    from ptloom.operators import runs

    return runs.overfit_flags(runs.loss_deltas(_runlog(spark, sf_dir)))


@query
def eval_interval_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-7: every 100th step (logging / evaluation interval)."""
    rl = _runlog(spark, sf_dir)
    return rl.where(F.pmod(F.col("step"), F.lit(100)) == 0).select("run_id", "split", "step", "loss")


@query
def dataset_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-11: rows per split file, distinct tools and distinct rejected types."""
    p = classify.classify_rejected(derived.pairs(Tables(spark, sf_dir)), "rejected")
    p = p.withColumn("file", derived.preference_split_file("key"))
    return p.groupBy("file").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.countDistinct("tool").cast("bigint").alias("n_tools"),
        F.countDistinct("rejected_type").cast("bigint").alias("n_types"),
    )


@query
def examples_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-13: examples per task (SFT records) and per tool (preference pairs)."""
    sft = sft_records_build(spark, sf_dir).groupBy(F.col("task").alias("name")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n")).withColumn("kind", F.lit("task"))
    tools = derived.pairs(Tables(spark, sf_dir)).groupBy(F.col("tool").alias("name")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n")).withColumn("kind", F.lit("tool"))
    return sft.unionByName(tools)


# ---------------------------------------------------------------------- align
@query
def dpo_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-25: DPO loss, implicit rewards, margin and accuracy from log-probs (beta 0.1)."""
    from ptloom.operators import align

    lp = derived.logprobs(Tables(spark, sf_dir))
    return align.dpo_summary(align.dpo_terms(lp, beta=0.1), ["label"])


@query
def token_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-26: mean -ln p per split under the unigram character model of the train split."""
    from ptloom.operators import align

    d = _docs_split(spark, sf_dir)
    return align.unigram_cross_entropy(d, "split", "train")


@query
def temperature_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-8: temperature-0.7 softmax over per-document candidate logits, top 5."""
    from ptloom.operators import align

    return align.temperature_topk(align.char_candidates(Tables(spark, sf_dir).documents), 0.7, 5)


# -------------------------------------------------------------- scans / sinks
@query
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1, SRC-5, SRC-6, SRC-8, U-5: the damaged preference lines written as two
    compressed JSONL files (one folder per file name), scanned back as raw text in one multi-file
    scan, validated, and summarised per file — same result as ``pref_file_summary``."""
    from ptloom.sources import textio

    raw = derived.raw_pair_lines(Tables(spark, sf_dir))
    path = textio.scratch_path(spark, "pairs-jsonl")
    textio.write_text_lines(raw, "value", path, partition_by=["file"], compression="gzip", open_folders=2)
    # a line names its file by its path
    lines = textio.read_lines(spark, path).withColumn("file", F.regexp_extract("file", "file=([^/]+)/", 1))
    return validate.preference_file_summary(validate.validate_preference(lines))


LINES_PER_FILE = 1000


@query
def line_error_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1, SRC-7, SRC-8, U-3: the damaged preference lines written in order as files of 1000 lines, several of
    one name in different folders, and read back with path and line number; one row per
    error that names both, and one for each file asked for that does not exist."""
    from ptloom.operators.scan import segmented_scan
    from ptloom.sources import textio

    # what the lines are made from is put in order, and a line is made where it is written: no exchange carries texts
    keys = segmented_scan(derived.raw_pair_keys(Tables(spark, sf_dir)), ["file"], ["line_id"], ordinal="pos").withColumn("part", F.floor((F.col("pos") - 1) / LINES_PER_FILE))
    path = textio.scratch_path(spark, "numbered-lines")
    raw = derived.lines_of_keys(keys.repartition("file", "part").sortWithinPartitions("file", "part", "pos"))
    textio.write_text_lines(raw, "value", path, partition_by=["file", "part"], compression="gzip")
    asked = {f: f"{path}/file={f}" for f in ("preference_train.jsonl", "preference_val.jsonl", "preference_test.jsonl")}
    missing = textio.missing_paths(spark, list(asked.values()))
    gone = {r.path for r in missing.collect()}
    lines = textio.read_lines(spark, [p for p in asked.values() if p not in gone], line_numbers=True)
    errors = validate.error_table(validate.validate_preference(lines), ["file", "line_no"])
    name = lambda c: F.regexp_replace(F.regexp_extract(c, "/file=([^/]+(?:/part=[0-9]+)?)", 1), "/part=", "/")
    return errors.select(name("file").alias("path"), "line_no", "rule").unionByName(
        missing.select(name("path").alias("path"), F.lit(None).cast("bigint").alias("line_no"), "rule"))


@query
def training_curve_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11: the run log written as a CSV history and scanned back with a declared
    schema; the loss table computed from the scan (same result as ``loss_table``)."""
    from ptloom.operators import runs
    from ptloom.sources import textio

    rl = _runlog(spark, sf_dir).select("run_id", "split", "step", "loss", "ms")
    path = textio.scratch_path(spark, "loss-history")
    textio.write_csv(rl, path)
    back = textio.read_csv(spark, path, "run_id string, split string, step bigint, loss double, ms double")
    return runs.loss_table(back)


@query
def model_outputs_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2, SRC-12: model outputs written as JSONL, read back with a typed FAILFAST
    scan and summarised per model (same result as ``model_summary``)."""
    from ptloom.operators import evaluate as ev
    from ptloom.sources import textio

    o = derived.outputs(Tables(spark, sf_dir))
    path = textio.scratch_path(spark, "outputs-jsonl")
    textio.write_jsonl(o, path)
    back = textio.read_jsonl_typed(
        spark, path,
        "model string, prompt_id string, prompt string, output string, expected_tool string, "
        "expected_arguments string, answer string",
    )
    return ev.model_summary(ev.exact_arguments(ev.score(ev.evaluate_output(back))))


@query
def token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10, FN-9: documents encoded with the corpus vocabulary, written as
    range-partitioned Parquet token shards, scanned back and counted per split; ids are
    made inside the row, so a shard's shuffle moves documents, not characters."""
    from ptloom.operators import codec, tokens
    from ptloom.sources import textio

    d = _docs_split(spark, sf_dir)
    to_ids = codec.char_encoder(spark, *codec.collect_vocabulary(tokens.char_vocab(d)))
    enc = d.select("doc_id", "split", to_ids(F.col("text")).alias("ids"))
    path = textio.scratch_path(spark, "token-shards")
    textio.write_token_shards(enc, path)
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.coalesce(F.sum(F.aggregate("ids", F.lit(0).cast("bigint"), lambda acc, x: acc + x)), F.lit(0)).cast("bigint").alias("sum_ids"),
    )
