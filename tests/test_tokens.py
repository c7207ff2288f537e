"""Character tokens, BPE against a brute-force learner, splits as partitions."""

from collections import Counter

from pyspark.sql import functions as F

from ptloom.operators import bpe, codec, split, tokens

TEXTS = ["low lower lowest", "newer wider new", "", "é😀 ü", "aaa aaaa"]


def _docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")


def test_encode_decode_roundtrip(spark):
    d = _docs(spark)
    vocab = tokens.char_vocab(d)
    assert {r.ch for r in vocab.collect()} == set("".join(TEXTS))
    enc = tokens.encode(d, vocab)
    dec = {r.doc_id: r.decoded for r in tokens.decode(enc, vocab).collect()}
    assert all(dec[i] == t for i, t in enumerate(TEXTS))
    assert {r.doc_id: len(r.ids) for r in enc.collect()} == {i: len(t) for i, t in enumerate(TEXTS)}


def test_blocks_and_targets(spark):
    b = tokens.blocks(_docs(spark), 4).where(F.col("doc_id") == 0).orderBy("block_no").collect()
    assert [r.input_text for r in b] == ["low ", "lowe", "r lo", "west"]
    assert b[0].target_text == "ow l"


def test_label_mask_lengths(spark):
    df = spark.createDataFrame([([("user", "hi"), ("assistant", "ok")],)], "m array<struct<role:string,content:string>>")
    r = df.select(tokens.label_mask(F.col("m")).alias("t")).collect()[0].t
    assert len(r.input_ids) == len(r.labels) == len(r.attention_mask)
    kept = [x for x in r.labels if x != -100]
    assert "".join(chr(x) for x in kept) == "<|im_start|>assistant\nok<|im_end|>\n"


def brute_bpe(texts, n):
    words = Counter(w for t in texts for w in t.split())
    vocab = {tuple(w): c for w, c in words.items()}
    merges = []
    for _ in range(n):
        pairs = Counter()
        for sym, c in vocab.items():
            for a, b in zip(sym, sym[1:]):
                pairs[(a, b)] += c
        if not pairs:
            break
        (a, b), cnt = min(pairs.items(), key=lambda kv: (-kv[1], kv[0]))
        merges.append((a, b, cnt))
        new = {}
        for sym, c in vocab.items():
            out, i = [], 0
            while i < len(sym):
                if i + 1 < len(sym) and sym[i] == a and sym[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(sym[i])
                    i += 1
            new[tuple(out)] = new.get(tuple(out), 0) + c
        vocab = new
    return merges


def test_bpe_matches_brute_force(spark):
    for every in (16, 2):
        got = bpe.train_bpe(spark, _docs(spark), 8, compact_every=every).orderBy("rank").collect()
        assert [(r.a, r.b, r["count"]) for r in got] == brute_bpe(TEXTS, 8)


def test_bpe_stops_without_pairs_and_handles_marks(spark):
    texts = ["\x01\x02 \x01\x02\x03 \x03a", "ab\x03", None, "x" * 300]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    got = bpe.train_bpe(spark, d, 40).orderBy("rank").collect()
    import re
    words = [w for t in texts if t for w in re.findall(r"\S{1,256}", t)]
    want = brute_bpe([" ".join(words)], 40)
    assert len(got) == len(want) and got[0]["count"] == want[0][2] and (got[0].a, got[0].b) == ("x", "x")
    assert {(r.a, r.b, r["count"]) for r in got} == set(want)


def test_bpe_encode_is_greedy_by_rank_and_decodes(spark):
    texts = [*TEXTS, None, "lower  newest\n\tlow é", "unseen Ω low", "w" * 700, TEXTS[0]]
    d = spark.createDataFrame([(i % 7, t) for i, t in enumerate(texts)], "doc_id long, text string")
    chars, ids = codec.collect_vocabulary(tokens.char_vocab(_docs(spark)))
    merges = [(r.a, r.b) for r in bpe.train_bpe(spark, _docs(spark), 8).orderBy("rank").collect()]
    known = dict(zip(chars, ids)) | codec.merged_ids(ids, merges)
    enc, dec = codec.bpe_encoder(spark, chars, ids, merges), codec.decoder(spark, known)
    got = d.select("text", enc(F.col("text")).alias("ids")).select("*", dec(F.col("ids")).alias("back"), codec.token_strings(spark, known)(F.col("ids")).alias("toks")).collect()
    assert len(got) == len(texts)

    def plain(text):
        out = []
        for piece in codec.PIECES.findall(text):
            s = list(piece)
            for a, b in merges:
                i, m = 0, []
                while i < len(s):
                    two = s[i:i + 2] == [a, b]
                    m.append(a + b if two else s[i])
                    i += 1 + two
                s = m
            out += s
        return out

    for r in got:
        if r.text is None:
            assert r.ids is None and r.back is None and r.toks is None
            continue
        assert r.ids == [known.get(t) for t in plain(r.text)]
        assert r.toks == [t if t in known else None for t in plain(r.text)]
        assert r.back == "".join(t for t in plain(r.text) if t in known)
    assert {r.back for r in got if r.text in TEXTS} == set(TEXTS)


def test_exact_split_is_partition_and_stable(spark):
    df = spark.range(0, 1003).select(F.format_string("k%04d", "id").alias("k"))
    a = split.exact_split(df, "k", 0.1, rounding="floor")
    b = split.exact_split(df.repartition(7), "k", 0.1, rounding="floor")
    assert a.where("split = 'val'").count() == 100
    assert a.exceptAll(b).count() == 0
    chk = {r.metric: r.value for r in split.split_check(a, df, "k").collect()}
    assert chk["n_overlap_keys"] == 0 and chk["n_lost"] == 0 and chk["n_extra"] == 0


def test_exact_split_with_duplicate_keys(spark):
    # one key holds a third of the rows: ties are split exactly, nothing is lost
    hot = spark.range(0, 300).select(F.lit("hot").alias("k"))
    rest = spark.range(0, 600).select(F.format_string("k%04d", "id").alias("k"))
    df = hot.unionByName(rest)
    for ratio in (0.2, 0.5):
        s = split.exact_split(df, "k", ratio, rounding="floor")
        assert s.count() == 900
        assert s.where("split = 'val'").count() == int(900 * ratio)


def test_rows_are_kept_by_encoding(spark):
    d = spark.createDataFrame([(1, "ab"), (2, None), (3, ""), (4, "ab"), (4, "ba"), (5, "a😀é"), (6, "aΩ")], "doc_id long, text string").repartition(3)
    vocab = tokens.char_vocab(d.where("doc_id <> 6"))
    enc = tokens.encode(d, vocab)
    ids = {c: i for c, i in zip(*codec.collect_vocabulary(vocab))}
    got = sorted(((r.doc_id, r.ids) for r in enc.collect()), key=str)
    assert got == sorted([(1, [ids["a"], ids["b"]]), (2, None), (3, []), (4, [ids["a"], ids["b"]]), (4, [ids["b"], ids["a"]]), (5, [ids[c] for c in "a😀é"]), (6, [ids["a"], None])], key=str)
    back = sorted(((r.doc_id, r.decoded) for r in tokens.decode(enc, vocab).collect()), key=str)
    assert back == sorted([(1, "ab"), (2, None), (3, ""), (4, "ab"), (4, "ba"), (5, "a😀é"), (6, "a")], key=str)
    plain = tokens.decode(tokens.encode(spark.createDataFrame([(1, "ab")], "doc_id long, text string"), vocab), vocab)
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
