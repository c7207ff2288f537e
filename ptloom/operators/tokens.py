"""Token-level operators over a character vocabulary (SRC-9, SRC-10, A-14 .. A-17,
FN-9 .. FN-11, V-23, V-24, W-2, W-3, L-7 .. L-11).

The default tokenizer is characters (code points); a vocabulary is a
DataFrame ``(ch, id)``.  Texts are encoded and decoded inside their own row
(``ptloom.operators.codec``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ptloom import constants as K
from ptloom.operators import codec
from ptloom.operators.ordered import join_null_safe
from ptloom.operators.scan import exact_quantiles, segmented_scan
from ptloom.session import stored_table


def chars(text: Column) -> Column:
    """Code points of a text as array<string>; empty text gives an empty array."""
    return F.when(F.char_length(text) > 0, F.split(text, "")).otherwise(F.array().cast("array<string>"))


def char_vocab(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A-16: characters, their frequency and ids in code-point order.

    Characters are counted within each task (no row for an occurrence); the
    id window runs over the small aggregated vocabulary.
    """
    counts = codec.char_counts(docs, text_col).groupBy("ch").agg(F.sum("n").alias("n"))
    return counts.withColumn("id", (F.row_number().over(Window.orderBy("ch")) - 1).cast("int"))


def encode(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """FN-9: text → ids (array<int>), one row for each row of ``docs``; unknown characters → null id."""
    to_ids = codec.char_encoder(docs.sparkSession, *codec.collect_vocabulary(vocab))
    return docs.select(id_col, to_ids(F.col(text_col)).alias("ids"))


def decode(ids: DataFrame, vocab: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """FN-10: ids → text, one row for each row of ``ids``; unknown (null) ids are skipped."""
    to_text = codec.decoder(ids.sparkSession, dict(zip(*codec.collect_vocabulary(vocab))))
    return ids.select(id_col, to_text(F.col("ids")).alias("decoded"))


def n_words(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(text, F.lit(r"\S+"))


def counts_by_tokenizer(docs: DataFrame, counts: dict[str, Column], group_col: str = "lang", word: str = "word", char: str = "char") -> DataFrame:
    """A-15: a row for each group and tokenizer, from one pass over ``docs``; ``counts`` maps a
    tokenizer to a text's number of tokens and includes ``word`` and ``char``, to which the ratios refer.

    A null text counts as a document without tokens; ratios to nothing are null.
    """
    d = docs.select(group_col, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(f"_n_{k}") for k, c in counts.items()])
    g = d.groupBy(group_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"), *[
        F.struct(F.sum(f"_n_{k}").alias("n"), F.max(f"_n_{k}").alias("most")).alias(f"_{k}") for k in counts])
    g = g.select(group_col, "n_docs", F.col(f"_{word}.n").alias("_words"), F.col(f"_{char}.n").alias("_chars"), F.explode(F.array(*[
        F.struct(F.lit(k).alias("tokenizer"), F.col(f"_{k}.n").alias("n"), F.col(f"_{k}.most").alias("most")) for k in counts])).alias("t"))
    ratio = lambda a, b: F.round(a / F.nullif(b, F.lit(0)), 6)
    return g.select(group_col, "t.tokenizer", "n_docs", F.col("t.n").alias("n_tokens"), F.col("t.most").alias("max_tokens"),
                    ratio(F.col("t.n"), F.col("n_docs")).alias("mean_tokens"), ratio(F.col("t.n"), F.col("_words")).alias("tokens_per_word"),
                    ratio(F.col("_chars"), F.col("t.n")).alias("chars_per_token"))


def length_stats(docs: DataFrame, group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """A-14: token (character) and word counts per group: mean, max, median, 90 %.

    The texts are read once, into a histogram of their lengths; everything else comes from it.
    """
    d = docs.select(group_col, F.char_length(text_col).cast("bigint").alias("n_tok"), n_words(F.col(text_col)).alias("n_words"))
    h = stored_table(d.groupBy(group_col, "n_tok").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("n_words")))
    total = F.sum(F.col("n_tok") * F.col("n"))
    g = h.groupBy(group_col).agg(
        F.sum("n").cast("bigint").alias("n_docs"),
        total.cast("bigint").alias("n_tokens"),
        F.round(total / F.sum(F.when(F.col("n_tok").isNotNull(), F.col("n"))), 6).alias("mean_tokens"),
        F.max("n_tok").cast("bigint").alias("max_tokens"),
        F.sum("n_words").cast("bigint").alias("n_words"),
        F.round(total / F.sum("n_words"), 6).alias("tokens_per_word"),
    )
    q = exact_quantiles(h, [group_col], "n_tok", {"p50_tokens": 0.5, "p90_tokens": 0.9}, weight_col="n")
    return join_null_safe(g, q.select(group_col, F.round("p50_tokens", 6).alias("p50_tokens"), F.round("p90_tokens", 6).alias("p90_tokens")), [group_col])


def truncation(n_tokens: Column, max_length: int) -> tuple[Column, Column]:
    """V-24 / L-9: (over-length flag, tokens lost by truncation to max_length)."""
    return n_tokens > max_length, F.greatest(n_tokens - max_length, F.lit(0))


def truncate_chat(messages: Column, max_length: int, pre: str = K.CHATML_PRE, post: str = K.CHATML_POST) -> Column:
    """L-9 / V-24: a rendered chat cut to ``max_length`` tokens on the side that spares the answer.

    Returns struct(n_tokens, cut_start, input_ids, labels, answer_kept, lost) where ``lost`` gives the role and
    the lost tokens of each message.  The window of ``max_length`` tokens ends with the last assistant message if that
    fits behind what comes before it (tokens are cut on the left, and behind the answer), begins with it
    where it is longer than the window, and is the first ``max_length`` tokens of a chat without an assistant.
    One prefix sum over the messages places it; null roles and contents are empty.
    """
    text = lambda m: F.concat(F.lit(pre), F.coalesce(m["role"], F.lit("")), F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(post))
    size = lambda m: F.char_length(text(m))
    is_answer = lambda m: F.coalesce(m["role"] == "assistant", F.lit(False))
    zero = F.lit(0)
    # (end of the messages so far, start and end of the last answer)
    state = F.aggregate(messages, F.struct(zero.alias("end"), F.lit(-1).alias("a"), F.lit(-1).alias("b")), lambda s, m: F.struct(
        (s["end"] + size(m)).alias("end"), F.when(is_answer(m), s["end"]).otherwise(s["a"]).alias("a"),
        F.when(is_answer(m), s["end"] + size(m)).otherwise(s["b"]).alias("b")))
    start = lambda s: F.when((s["end"] <= max_length) | (s["b"] <= max_length), zero).when(s["b"] - s["a"] > max_length, s["a"]).otherwise(s["b"] - max_length)
    ids = F.flatten(F.transform(messages, lambda m: code_points(text(m))))
    labels = F.flatten(F.transform(messages, lambda m: F.when(is_answer(m), code_points(text(m))).otherwise(F.array_repeat(F.lit(K.IGNORE_INDEX), size(m)))))
    # lost tokens of a message: what lies outside [start, start + max_length)
    spans = lambda: F.aggregate(messages, F.array().cast("array<struct<role:string,a:int,b:int>>"), lambda acc, m: F.concat(acc, F.array(F.struct(
        F.coalesce(m["role"], F.lit("")).alias("role"), F.coalesce(F.get(acc, F.size(acc) - 1)["b"], zero).alias("a"),
        (F.coalesce(F.get(acc, F.size(acc) - 1)["b"], zero) + size(m)).alias("b")))))
    cut = F.struct(state.alias("s"), start(state).alias("at"))
    return F.transform(F.array(cut), lambda c: F.struct(
        c["s"]["end"].alias("n_tokens"), c["at"].alias("cut_start"), F.slice(ids, c["at"] + 1, F.lit(max_length)).alias("input_ids"),
        F.slice(labels, c["at"] + 1, F.lit(max_length)).alias("labels"),
        F.when(c["s"]["b"] >= 0, (c["s"]["a"] >= c["at"]) & (c["s"]["b"] <= c["at"] + max_length)).alias("answer_kept"),
        F.transform(spans(), lambda x: F.struct(x["role"].alias("role"), (x["b"] - x["a"] - F.greatest(
            F.least(x["b"], c["at"] + max_length) - F.greatest(x["a"], c["at"]), zero)).alias("n_lost"))).alias("lost"),
    ))[0]


def next_token_pairs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """W-2: (token, next token) target pairs inside each document, as counts.

    The shift is an array slice inside the row — no window over documents.
    """
    c = chars(F.col(text_col))
    n = F.size(c)
    pairs = F.arrays_zip(F.slice(c, 1, n - 1).alias("cur"), F.slice(c, 2, n - 1).alias("nxt"))
    d = docs.where(F.char_length(text_col) > 1).select(F.explode(pairs).alias("p"))
    return d.groupBy(F.col("p.cur").alias("cur"), F.col("p.nxt").alias("nxt")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def blocks(docs: DataFrame, block_size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """W-3: fixed-size context blocks per document with the shifted targets.

    The text is cut once, in one pass over it; a block's targets are its own
    characters from the second on and the first of the next block.  Empty
    documents have no blocks.
    """
    d = docs.select(id_col, F.regexp_extract_all(F.col(text_col), F.lit(f"(?s).{{1,{int(block_size)}}}"), F.lit(0)).alias("b"))
    shifted = F.transform("b", lambda x, i: F.concat(F.substring(x, 2, block_size), F.coalesce(F.substring(F.get("b", i + 1), 1, 1), F.lit(""))))
    d = d.select(id_col, F.posexplode(F.arrays_zip(F.col("b").alias("x"), shifted.alias("y"))).alias("i", "p"))
    return d.select(id_col, F.col("i").cast("bigint").alias("block_no"), F.char_length("p.x").cast("bigint").alias("n_tokens"),
                    F.col("p.x").alias("input_text"), F.col("p.y").alias("target_text"))


def _spans(docs: DataFrame, size: int, bucket_col: str, order_col: str, length_col: str) -> DataFrame:
    """``docs`` with a row for each pack that a document touches: ``pack_id``, ``start`` and ``end`` (token places in the document)."""
    c = segmented_scan(docs.where(F.col(length_col) > 0).withColumn("_len", F.col(length_col).cast("bigint")), [bucket_col], [order_col], total={"_before": "_len"})
    first, last = F.floor(F.col("_before") / size), F.floor((F.col("_before") + F.col("_len") - 1) / size)
    c = c.withColumn("pack_id", F.explode(F.sequence(first, last)))
    return c.withColumn("start", F.greatest(F.col("pack_id") * size - F.col("_before"), F.lit(0)).cast("bigint")).withColumn(
        "end", F.least((F.col("pack_id") + 1) * size - F.col("_before"), F.col("_len")).cast("bigint"))


def pack(docs: DataFrame, size: int, bucket_col: str, order_col: str, length_col: str) -> DataFrame:
    """L-11: concat-and-chunk packing, a row (bucket, pack_id, order column, start, end) for
    each pack that a document touches; ``start`` and ``end`` are token places in the document.

    The running sum is skew-safe; documents without tokens touch no pack.
    """
    return _spans(docs.select(bucket_col, order_col, length_col), size, bucket_col, order_col, length_col).select(bucket_col, "pack_id", order_col, "start", "end")


def packed_sequences(docs: DataFrame, size: int, bucket_col: str, order_col: str, ids_col: str = "ids") -> DataFrame:
    """L-11: the packs themselves, (bucket, pack_id, input_ids, segment_ids, position_ids).

    Every pack holds ``size`` tokens but the last one of a bucket; ``segment_ids`` number the documents of a pack from 1 and
    ``position_ids`` restart at 0 in each segment.  A pack is gathered in one row, which ``size`` bounds;
    documents that tie in ``order_col`` lie in no defined order.  Null ids (unknown tokens) are tokens; null or empty arrays are no part of a pack.
    """
    d = docs.select(bucket_col, order_col, F.col(ids_col).alias("_ids"), F.size(ids_col).alias("_n"))
    s = _spans(d, size, bucket_col, order_col, "_n")
    piece = F.struct((F.col("pack_id") * size - F.col("_before")).alias("at"), F.slice("_ids", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")).alias("ids"))
    # at falls as the documents of a pack follow each other: all but the first start behind the pack's start
    g = s.select(bucket_col, "pack_id", piece.alias("p")).groupBy(bucket_col, "pack_id").agg(F.sort_array(F.collect_list("p"), asc=False).alias("_p"))
    return g.select(bucket_col, "pack_id", F.flatten("_p.ids").alias("input_ids"),
                    F.flatten(F.transform("_p", lambda p, i: F.array_repeat(i + 1, F.size(p["ids"])))).alias("segment_ids"),
                    F.flatten(F.transform("_p", lambda p: F.sequence(F.lit(0), F.size(p["ids"]) - 1))).alias("position_ids"))


def code_points(text: Column) -> Column:
    """Code point ids of a text (a vocabulary-free character tokenizer)."""
    return F.transform(chars(text), lambda c: F.ascii(c))


def label_mask(messages: Column, pre: str = K.CHATML_PRE, post: str = K.CHATML_POST) -> Column:
    """L-10: struct(input_ids, labels, attention_mask) for a rendered chat; tokens of
    non-assistant turns get label -100."""
    def piece(m: Column) -> Column:
        return F.concat(F.lit(pre), m["role"], F.lit("\n"), m["content"], F.lit(post))

    ids = F.flatten(F.transform(messages, lambda m: code_points(piece(m))))
    labels = F.flatten(F.transform(messages, lambda m: F.when(
        m["role"] == "assistant", code_points(piece(m))
    ).otherwise(F.array_repeat(F.lit(K.IGNORE_INDEX), F.char_length(piece(m))))))
    return F.struct(ids.alias("input_ids"), labels.alias("labels"),
                    F.array_repeat(F.lit(1), F.size(ids)).alias("attention_mask"))


def pad_to(ids: Column, length: Column, pad_id: int = 0) -> tuple[Column, Column]:
    """L-8: right-pad ids to ``length``; attention mask 1 for real tokens, 0 for padding."""
    n_pad = F.greatest(length - F.size(ids), F.lit(0)).cast("int")
    return (F.concat(ids, F.array_repeat(F.lit(pad_id), n_pad)),
            F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), n_pad)))
