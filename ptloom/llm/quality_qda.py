"""Operator 1, quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics of a text (sizes, shares of character kinds, repetition) are
made symmetric by log and square-root transforms.  Spark sums, for each
class, the counts, first and second moments of the labelled rows outside the
held-out fold; that fixed handful of numbers fits the model.  Each class
covariance is shrunk towards its scaled identity (after pooled scaling) by
the oracle-approximating intensity, with ``MIN_SHRINK`` at least.  A score
is the logistic of the difference of log-densities and log-priors, with
Mahalanobis distances by triangular solves against Cholesky factors that are
computed once.

Only the text enters a score.  Cases: null and empty texts have zero
statistics and a score like any other; a null id is never held out and never
learned from; labels repeated for a document count each time, null labels
not at all; without rows of both classes the score is the smoothed share of
label 1; extra columns are ignored or carried.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import arrays, rows
from ptloom.llm.perplexity import base_rules

FEATURES = ("log_bytes", "log_words", "word_length", "word_spread", "upper", "digit", "mark", "bar", "exclaim", "comma", "period",
            "line_rate", "non_ascii", "distinct", "dup_lines", "repeat", "marked_ends", "longest")
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
MIN_SHRINK = 0.01
#: labelled ids that are broadcast, to measure only their texts; beyond them all texts outside the fold are measured
MAX_IDS = 1_000_000

_KIND = {
    "upper": np.isin(np.arange(256), np.arange(0x41, 0x5B)),
    "digit": np.isin(np.arange(256), np.arange(0x30, 0x3A)),
    "mark": np.isin(np.arange(256), np.frombuffer(b"#*$%&<>@^_~=+\\/{}[]", np.uint8)),
    "bar": np.isin(np.arange(256), np.frombuffer(b"|", np.uint8)),
    "exclaim": np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8)),
    "comma": np.isin(np.arange(256), np.frombuffer(b",;:", np.uint8)),
    "period": np.isin(np.arange(256), np.frombuffer(b".", np.uint8)),
    "line_rate": np.isin(np.arange(256), [0x0A]),
    "non_ascii": np.arange(256) >= 0xC0,
}
_LETTER = arrays.ALNUM.copy()
_LETTER[0x30:0x3A] = False


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """One row of transformed statistics for each text."""
    out = [np.zeros((0, len(FEATURES)))]
    for lo, hi in arrays.chunks(texts):
        part = texts[lo:hi]
        words = arrays.Words(part, arrays.NOT_SPACE)
        base = base_rules(words, part)
        n = np.array([len(t or b"") for t in part], np.float64)
        nw = words.counts.astype(np.float64)
        size, nonzero = np.maximum(n, 1), np.maximum(nw, 1)
        length = (words.ends - words.starts).astype(np.float64)
        mean = arrays.sum_by(length, words.first) / nonzero
        spread = np.sqrt(np.maximum(arrays.sum_by(length**2, words.first) / nonzero - mean**2, 0))
        pair = arrays.mix(words.hashes + words.owner.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        distinct = np.bincount(words.owner[np.unique(pair, return_index=True)[1]], minlength=len(part))
        lines = arrays.sum_by((words.flat == 0x0A).astype(np.int64), words.text_starts)
        odd_end = ~_LETTER[words.flat[words.ends - 1]] if len(length) else np.zeros(0, bool)
        longest = np.zeros(len(part))
        np.maximum.at(longest, words.owner, length)
        col = {"log_bytes": np.log1p(n), "log_words": np.log1p(nw), "word_length": np.log1p(mean), "word_spread": np.log1p(spread),
               "distinct": np.sqrt(distinct / nonzero), "dup_lines": np.sqrt(base["n_dup_lines"] / np.maximum(lines, 1)),
               "repeat": np.sqrt(base["n_repeat_words"] / nonzero), "marked_ends": np.sqrt(arrays.sum_by(odd_end.astype(np.int64), words.first) / nonzero),
               "longest": np.log1p(longest)}
        for name, kind in _KIND.items():
            col[name] = np.sqrt(np.maximum(arrays.sum_by(kind[words.flat].astype(np.int64), words.text_starts) - (name == "line_rate"), 0) / size)
        out.append(np.column_stack([col[f] for f in FEATURES]))
    return np.concatenate(out)


def measure(docs: DataFrame, *, text_col: str = "text", row: list[str] | None = None) -> DataFrame:
    """Columns ``row`` and ``res.x`` (array of double, in the order of ``FEATURES``)."""
    def fn(texts, _):
        return {"x": list(statistics(texts))}

    return rows.map_texts(docs, text_col, fn, T.StructType([T.StructField("x", T.ArrayType(T.DoubleType(), False), False)]), row=row)


def moments(labelled: DataFrame, d: int = len(FEATURES)) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: rows, sum and sum of products of ``x``; a fixed number of sums, whatever the rows."""
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    got = labelled.groupBy("label").agg(F.count("*").alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"),
                                        F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("q")).collect()
    out = {}
    for r in got:
        q = np.zeros((d, d))
        for (i, j), v in zip(pairs, r["q"]):
            q[i, j] = q[j, i] = v
        out[int(r["label"])] = (float(r["n"]), np.array(r["s"]), q)
    return out


class Discriminant:
    """The fitted model: scaling, class means, inverse Cholesky factors, log-determinants and priors."""

    def __init__(self, stats: dict[int, tuple[float, np.ndarray, np.ndarray]], min_shrink: float = MIN_SHRINK):
        n = {k: stats[k][0] if k in stats else 0.0 for k in (0, 1)}
        self.prior = (n[1] + 1) / (n[0] + n[1] + 2)
        self.classes = None
        if min(n.values()) < 2:
            return
        total = n[0] + n[1]
        mean = (stats[0][1] + stats[1][1]) / total
        var = np.diag(stats[0][2] + stats[1][2]) / total - mean**2
        self.scale = 1 / np.sqrt(np.maximum(var, 1e-6))
        self.mean = mean
        self.classes = []
        for k in (0, 1):
            m = stats[k][1] / n[k]
            s = (stats[k][2] / n[k] - np.outer(m, m)) * np.outer(self.scale, self.scale)
            d = len(m)
            tr, tr2 = np.trace(s), np.sum(s * s)
            rho = ((1 - 2 / d) * tr2 + tr**2) / max((n[k] + 1 - 2 / d) * (tr2 - tr**2 / d), 1e-12)
            rho = min(1.0, max(min_shrink, rho))
            cov = (1 - rho) * s + (rho * max(tr / d, 1e-3)) * np.eye(d)
            factor = np.linalg.cholesky(cov)
            prior = self.prior if k else 1 - self.prior
            self.classes.append(((m - mean) * self.scale, np.linalg.inv(factor), np.log(np.diag(factor)).sum() - np.log(prior)))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.prior)
        z = (x - self.mean) * self.scale
        logs = [-0.5 * np.sum(((z - m) @ inv.T) ** 2, axis=1) - c for m, inv, c in self.classes]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def held_out(ident, folds: int = FOLDS):
    """Whether a row is in the held-out fold: crc32 of its id as text, modulo the folds, is 0."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % folds == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text") -> Discriminant:
    """Fits on every labelled row outside the held-out fold."""
    known = labels.where(labels[label_col].isin(0, 1)).select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label"))
    known = known.where(~held_out(F.col("id")))
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where(~held_out(F.col("id")))
    ids = known.select("id").distinct()
    if ids.limit(MAX_IDS + 1).count() <= MAX_IDS:  # texts without a label are not measured; without the broadcast they would have to travel
        src = src.join(F.broadcast(ids), "id", "left_semi")
    x = measure(src, row=["id"]).select("row.id", "res.x")
    return Discriminant(moments(x.join(known, "id")))


def score(docs: DataFrame, model: Discriminant, *, text_col: str = "text", row: list[str] | None = None) -> DataFrame:
    """Columns ``row`` and ``res.score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def fn(texts, _):
        return {"score": shared.value.score(statistics(texts))}

    return rows.map_texts(docs, text_col, fn, T.StructType([T.StructField("score", T.DoubleType(), False)]), row=row)


def op1(spark, sf_dir: str) -> DataFrame:
    """Scores of every whole text, fitted on the labelled rows outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, row=["doc_id"]).select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "res.score",
                                                     (F.col("res.score") >= THRESHOLD).cast("int").alias("predicted"))
