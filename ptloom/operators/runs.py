"""Training-run tables: losses, parameters, sweeps, GPU cost, step times,
curve deltas (A-18 .. A-21, A-30, W-4 .. W-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ptloom.functions.hashing import seeded_hash
from ptloom.operators.joins import checked_broadcast
from ptloom.operators.ordered import join_null_safe
from ptloom.operators.scan import asof_join, exact_quantiles, segmented_scan

R6 = lambda c: F.round(c, 6)


def loss_table(rl: DataFrame) -> DataFrame:
    """A-18: per run — first/last train and val loss, best val, total drop, final gap."""
    tr = F.col("split") == "train"
    va = F.col("split") == "val"
    g = rl.groupBy("run_id").agg(
        F.min_by(F.when(tr, F.col("loss")), F.when(tr, F.col("step"))).alias("first_train"),
        F.max_by(F.when(tr, F.col("loss")), F.when(tr, F.col("step"))).alias("last_train"),
        F.min_by(F.when(va, F.col("loss")), F.when(va, F.col("step"))).alias("first_val"),
        F.max_by(F.when(va, F.col("loss")), F.when(va, F.col("step"))).alias("last_val"),
        F.min(F.when(va, F.col("loss"))).alias("best_val"),
    )
    return g.select(
        "run_id", R6(F.col("first_train")).alias("first_train"), R6(F.col("last_train")).alias("last_train"),
        R6(F.col("first_val")).alias("first_val"), R6(F.col("last_val")).alias("last_val"),
        R6(F.col("best_val")).alias("best_val"),
        R6(F.col("first_train") - F.col("last_train")).alias("total_drop"),
        R6(F.col("last_val") - F.col("last_train")).alias("final_gap"),
    )


def run_params(rl: DataFrame) -> DataFrame:
    """The run-parameter table (one row per run): beta and learning rate from the run key."""
    runs = rl.select("run_id").distinct()
    h = seeded_hash(F.col("run_id"))
    return runs.select(
        "run_id", F.lit("ptloom-run").alias("model"),
        ((F.pmod(h, F.lit(5)) + 1) / 10.0).alias("beta"),
        ((F.pmod(h, F.lit(3)) + 1) * 0.00001).alias("lr"),
    )


def experiment_summary(rl: DataFrame, params: DataFrame) -> DataFrame:
    """A-19: rows, steps, first and last loss per run + its parameters."""
    g = rl.groupBy("run_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.max("step").cast("bigint").alias("steps"),
        R6(F.min_by("loss", "step")).alias("loss_first"),
        R6(F.max_by("loss", "step")).alias("loss_last"),
    )
    return g.join(checked_broadcast(params), "run_id").select(
        "run_id", "model", "beta", "lr", "n_rows", "steps", "loss_first", "loss_last")


def sweep_pivot(rl: DataFrame, params: DataFrame) -> DataFrame:
    """A-20: mean loss by beta (rows) × split (columns)."""
    j = rl.join(checked_broadcast(params.select("run_id", "beta")), "run_id")
    p = j.groupBy("beta").pivot("split", ["train", "val"]).agg(F.avg("loss"))
    return p.select("beta", R6(F.col("train")).alias("train"), R6(F.col("val")).alias("val"))


def gpu_cost(log: DataFrame) -> DataFrame:
    """A-21: hours and cost totals with subtotals per stage and a grand total."""
    return log.rollup("stage", "gpu").agg(
        F.sum("hours").alias("hours"), F.sum(F.col("hours") * F.col("price")).alias("cost"),
        F.count(F.lit(1)).cast("bigint").alias("n"),
    )


def step_time_summary(rl: DataFrame) -> DataFrame:
    """A-30: train-step time stats, eval steps apart, change against the mean over runs."""
    tr = F.col("split") == "train"
    g = rl.groupBy("run_id").agg(
        R6(F.avg(F.when(tr, F.col("ms")))).alias("train_ms_mean"),
        F.min(F.when(tr, F.col("ms"))).alias("train_ms_min"),
        F.max(F.when(tr, F.col("ms"))).alias("train_ms_max"),
        R6(F.avg(F.when(~tr, F.col("ms")))).alias("eval_ms_mean"),
        F.sum(F.when(~tr, 1).otherwise(0)).cast("bigint").alias("n_eval"),
    )
    half = exact_quantiles(rl.where(tr), ["run_id"], "ms", {"train_ms_p50": 0.5})
    g = join_null_safe(g, half, ["run_id"]).withColumn("train_ms_p50", R6(F.col("train_ms_p50")))
    w = Window.partitionBy(F.lit(0))  # over the per-run summary only (one row per run)
    return g.withColumn("train_ms_vs_mean", R6(F.col("train_ms_mean") - F.avg("train_ms_mean").over(w)))


def align_runs(rl: DataFrame, base: str, split: str = "train") -> DataFrame:
    """A-30: every point of every other run beside the base run's last point at or before the same share of progress.

    Progress is the step as a share of the run's last step, so runs of different length are
    compared over their whole course; a point before the base run's first one has no match (null).  One scan
    orders all runs' points and the base run's by progress: no run is a join key.
    """
    t = rl.where(F.col("split") == split).select("run_id", "step", "loss")
    ends = rl.groupBy("run_id").agg(F.max("step").alias("_end"))
    t = join_null_safe(t, ends, ["run_id"]).withColumn("progress", F.col("step") / F.col("_end")).drop("_end")
    mine = ~F.col("run_id").eqNullSafe(F.lit(base))
    other = t.where(~mine).select("step", "loss", "progress")
    a = asof_join(t.where(mine), other, [], "progress", ties=["step"], match="_base")
    return a.select("run_id", "step", R6(F.col("progress")).alias("progress"), R6(F.col("loss")).alias("loss"), F.col("_base.step").alias("base_step"),
                    R6(F.col("_base.loss")).alias("base_loss"), R6(F.col("loss") - F.col("_base.loss")).alias("change"), F.col("_base").isNotNull().alias("matched"))


def loss_deltas(rl: DataFrame) -> DataFrame:
    """W-4 / W-5: ordinal inside (run, split), change since the previous point and the new-best
    flag, from one scan that carries all three (a run that holds a third of the rows is cut into many partitions)."""
    s = segmented_scan(rl.select("run_id", "split", "step", "loss"), ["run_id", "split"], ["step"], ordinal="ord", previous={"prev_loss": "loss"}, least={"best_before": "loss"})
    return s.select(
        "run_id", "split", "ord", "step", R6(F.col("loss")).alias("loss"),
        R6(F.col("loss") - F.col("prev_loss")).alias("delta"),
        F.coalesce(F.col("loss") < F.col("best_before"), F.lit(True)).alias("new_best"),
    )


def overfit_flags(deltas: DataFrame) -> DataFrame:
    """W-6: align the i-th train and val point of a run; flag train falling while val rises.

    One group-by of the place brings both sides together (a place has one point of either side)."""
    side = lambda s, c: F.max(F.when(F.col("split") == s, F.col(c)))
    j = deltas.groupBy("run_id", "ord").agg(side("train", "delta").alias("d_train"), side("val", "delta").alias("d_val"),
                                            side("train", "ord").alias("t"), side("val", "ord").alias("v"))
    return j.where(F.col("t").isNotNull() & F.col("v").isNotNull()).groupBy("run_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_aligned"),
        F.sum(F.when((F.col("d_train") < 0) & (F.col("d_val") > 0), 1).otherwise(0)).cast("bigint").alias("n_overfit"),
    )
