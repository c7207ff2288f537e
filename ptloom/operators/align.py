"""Preference-alignment and language-model metrics over tables (A-25, A-26, W-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ptloom.operators.joins import checked_broadcast
from ptloom.session import reliable_checkpoint
from ptloom.operators.codec import CODE_POINTS
from ptloom.operators.tokens import chars

R6 = lambda c: F.round(c, 6)


def softplus(x):
    """log(1 + exp(x)) in a numerically stable form."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def dpo_terms(lp: DataFrame, beta: float = 0.1) -> DataFrame:
    """A-25 per pair: implicit rewards beta*(log pi - log ref) of chosen and rejected,
    margin, loss = -log sigmoid(margin) = softplus(-margin), accuracy."""
    rc = F.lit(beta) * (F.col("policy_chosen") - F.col("ref_chosen"))
    rr = F.lit(beta) * (F.col("policy_rejected") - F.col("ref_rejected"))
    return lp.withColumns({"reward_chosen": rc, "reward_rejected": rr}).withColumns({
        "margin": F.col("reward_chosen") - F.col("reward_rejected"),
    }).withColumns({
        "loss": softplus(-F.col("margin")),
        "correct": F.col("reward_chosen") > F.col("reward_rejected"),
    })


def dpo_summary(terms: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    g = list(group_cols or [])
    return terms.groupBy(*g).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        R6(F.avg("loss")).alias("mean_loss"),
        R6(F.avg("reward_chosen")).alias("mean_reward_chosen"),
        R6(F.avg("reward_rejected")).alias("mean_reward_rejected"),
        R6(F.avg("margin")).alias("mean_margin"),
        R6(F.avg(F.col("correct").cast("double"))).alias("reward_accuracy"),
    )


def unigram_cross_entropy(docs: DataFrame, split_col: str, train_value: str, text_col: str = "text") -> DataFrame:
    """A-26: fit p(c) on the train split, then mean -ln p(c) and perplexity per split.

    Counting is per (split, character) with a partial aggregate; the model is a
    table of at most one row per character.  Characters unseen in training are
    counted apart.
    """
    counts = docs.select(split_col, F.explode(chars(F.col(text_col))).alias("ch")).groupBy(split_col, "ch").agg(
        F.count(F.lit(1)).alias("n"))
    counts = reliable_checkpoint(counts)  # one row per (split, character): the corpus is read once
    train = counts.where(F.col(split_col) == train_value)
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # over the small per-character table
    model = train.select("ch", (-F.log(F.col("n") / total)).alias("nll"))
    # one row per character of the training split: broadcast only under the checked bound
    j = counts.join(checked_broadcast(model, CODE_POINTS), "ch", "left")
    per = j.groupBy(split_col).agg(
        (F.sum(F.when(F.col("nll").isNotNull(), F.col("n") * F.col("nll"))) /
         F.sum(F.when(F.col("nll").isNotNull(), F.col("n")))).alias("ce"),
        F.sum(F.when(F.col("nll").isNull(), F.col("n")).otherwise(0)).cast("bigint").alias("n_unseen"),
        F.sum("n").cast("bigint").alias("n_tokens"),
    )
    return per.select(split_col, R6(F.col("ce")).alias("cross_entropy"), R6(F.exp("ce")).alias("perplexity"),
                      "n_tokens", "n_unseen")


def char_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Candidate-score table: prompt = doc_id, token = character, logit = ln(count)."""
    c = docs.select("doc_id", F.explode(chars(F.col(text_col))).alias("token")).groupBy("doc_id", "token").agg(
        F.count(F.lit(1)).alias("n"))
    return c.select(F.col("doc_id").alias("prompt"), "token", F.log(F.col("n").cast("double")).alias("logit"))


def temperature_topk(cand: DataFrame, temperature: float, k: int) -> DataFrame:
    """W-8: softmax of logit / T inside each prompt and the k most likely tokens.

    Windows are per prompt; a prompt's candidates are bounded by the vocabulary.
    """
    w = Window.partitionBy("prompt")
    z = F.exp((F.col("logit") - F.max("logit").over(w)) / F.lit(temperature))
    p = cand.withColumn("_z", z).withColumn("prob", F.col("_z") / F.sum("_z").over(w))
    r = p.withColumn("rank", F.row_number().over(w.orderBy(F.desc("prob"), "token")))
    return r.where(F.col("rank") <= k).select("prompt", "token", F.col("rank").cast("bigint"), R6(F.col("prob")).alias("prob"))
