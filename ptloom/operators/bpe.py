"""BPE training (A-17): count adjacent symbol pairs weighted by word frequency,
merge the most frequent pair, repeat.

The corpus is reduced once to its distinct words.  An index holds a posting
for each word and each pair in it, sorted by pair, and a count for each pair.
A round takes the best pair from the counts, reads that pair's postings (a pushed-down
filter on sorted files), merges the words found there, and appends what
changed: postings of the new word under all its old and new pairs (dead where
a pair is gone) and the differences of the counts.  Words without the pair are
not read, so a round costs as much as the words it touches; every ``compact_every`` rounds the appended parts
are rewritten as one.

A word is a string in which every symbol stands between two marks, so a merge is one
``replace``, from the left and without overlap.  The marks are control
characters; where a text holds them they are escaped, and a symbol's own
character stays one symbol.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ptloom.operators import codec
from ptloom.session import ensure_checkpoint_dir, stored_table

OPEN, CLOSE, ESCAPE = "\x01", "\x02", "\x03"
MARKS = {ESCAPE: "c", OPEN: "a", CLOSE: "b"}  # the escape itself first


def marked(word: Column) -> Column:
    """The word with each character as a marked symbol."""
    for mark, letter in MARKS.items():
        word = F.replace(word, F.lit(mark), F.lit(ESCAPE + letter))
    return F.regexp_replace(word, f"(?s)({ESCAPE}?.)", f"{OPEN}$1{CLOSE}")


def unmarked(symbol: str) -> str:
    for mark, letter in reversed(MARKS.items()):
        symbol = symbol.replace(ESCAPE + letter, mark)
    return symbol


def word_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct words, marked, with their frequency; a run without white space is cut after ``WORD_CHARS`` characters."""
    return codec.word_counts(docs, text_col).groupBy("w").agg(F.sum("n").alias("freq")).select(marked(F.col("w")).alias("word"), "freq")


def pairs(word: str) -> list[str]:
    """The adjacent pairs of a marked word, each as the marked string of its two symbols."""
    s = word[1:-1].split(CLOSE + OPEN)
    return [f"{OPEN}{a}{CLOSE}{OPEN}{b}{CLOSE}" for a, b in zip(s, s[1:])]


def _postings(words: DataFrame, generation: int) -> DataFrame:
    """(pair, word, freq, round, live, diff) of distinct words (old, word, freq): a row for each distinct pair of either form, made in the word's own row."""
    schema = "pair string, word string, freq bigint, round int, live boolean, diff bigint"
    made = pa.schema([("pair", pa.string()), ("word", pa.string()), ("freq", pa.int64()), ("round", pa.int32()), ("live", pa.bool_()), ("diff", pa.int64())])
    codec.small_batches(words.sparkSession)

    def run(batches):
        def told(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), made.types)], schema=made)

        rows, held = [], 0
        for batch in batches:
            for word, freq, old in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                new, gone = Counter(pairs(word)), Counter(pairs(old))
                for pair in new | gone:
                    rows.append((pair, word, freq, generation, pair in new, (new[pair] - gone[pair]) * freq))
                    held += len(word) + len(pair)
                    if held >= codec.BATCH_BYTES // 4:
                        yield told(rows)
                        rows, held = [], 0
        if rows:
            yield told(rows)

    return words.select("word", "freq", "old").mapInArrow(run, schema)


def _sorted(postings: DataFrame, ranged: bool = True) -> DataFrame:
    """Written in order of pair and word, so that a filter on the pair skips files and row groups; a frequent pair is dealt over several.

    A round's own part is sorted as its words lie (``ranged`` would compute it twice, to sample it).
    """
    return stored_table((postings.repartitionByRange("pair", "word") if ranged else postings).sortWithinPartitions("pair", "word"))


def _total(counts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, counts).groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") > 0)


def train_bpe(spark: SparkSession, docs: DataFrame, n_merges: int, text_col: str = "text", compact_every: int = 16) -> DataFrame:
    """Learn ``n_merges`` merges; returns (rank, a, b, merged, count).

    Ties on the count break on the marked pair (its first symbol, then its
    second) so the result is deterministic.  Stops early only when no adjacent pair is left.
    """
    ensure_checkpoint_dir(spark)
    words = word_table(docs, text_col).select("word", "freq", F.lit("").alias("old"))
    index = [_sorted(_postings(words, 0))]
    counts = [stored_table(index[0].groupBy("pair").agg(F.sum("diff").alias("n")))]
    merges = []
    for rank in range(1, n_merges + 1):
        best = _total(counts).orderBy(F.desc("n"), "pair").limit(1).collect()
        if not best:
            break
        pair = best[0]["pair"]
        a, b = pair[1:-1].split(CLOSE + OPEN)
        merges.append((rank, unmarked(a), unmarked(b), unmarked(a) + unmarked(b), int(best[0]["n"])))
        if rank == n_merges:
            break
        found = reduce(DataFrame.unionByName, [part.where(F.col("pair") == pair) for part in index])
        # a word has a posting of each round that changed it; the last one counts
        latest = found.groupBy(F.translate("word", OPEN + CLOSE, "").alias("_key")).agg(F.max_by(F.struct("word", "freq", "live"), "round").alias("w"))
        touched = latest.where("w.live").select(F.col("w.word").alias("old"), F.replace(F.col("w.word"), F.lit(pair), F.lit(f"{OPEN}{a}{b}{CLOSE}")).alias("word"), "w.freq")
        index.append(_sorted(_postings(touched, rank), ranged=False))
        counts.append(stored_table(index[-1].groupBy("pair").agg(F.sum("diff").alias("n")).where(F.col("n") != 0)))
        if len(index) > compact_every:
            index = [index[0], _sorted(reduce(DataFrame.unionByName, index[1:]))]
            counts = [stored_table(_total(counts))]
    return spark.createDataFrame(merges, "rank int, a string, b string, merged string, count bigint")
