"""Operator 6, quality rules: base rules, then perplexity bands of a modified Kneser-Ney model.

The model is of order ``ORDER`` over characters: ASCII by ``SYMBOLS``
classes (the 26 lower-case letters, space, line feed, digits, upper case,
single classes of punctuation), every other character by its own code point.
So a language's n-grams grow with its text.  Spark takes the counts over
every character of every distinct text that passes the base rules (what they reject teaches
the model nothing); a task sends what it counted once it
holds ``HELD`` n-grams.  A model keeps, per order, the sorted hashes of its
n-grams beside their log-probabilities and back-off weights.  Languages are
scored in blocks whose models hold ``BLOCK_NGRAMS`` n-grams together (one
language at least).

A document's log-perplexity is the mean over all of its characters, its
core the mean without the costliest ``QUOTED`` of its blocks of ``BLOCK``
characters.  It is rejected if both lie outside the bands of its
language: the quartiles, widened by ``BAND`` times their distance (and by
``FLOOR`` at least), more for short texts.  Quartiles come from an exact
histogram over the texts of all documents that pass the base rules.  Both
the model and the quartiles count a text of a language once, whatever the
number of its copies; every row is read and judged.

Cases: null and empty texts have no words and fail the base rules; a null
language is the language ``''``; a text without characters has perplexity
1, as has every text of a language in which none passes the base rules; very long texts are counted and scored whole; equal and repeated rows get the same verdict; an empty table gives none; extra columns are carried.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import arrays, rows

ORDER = 4
SYMBOLS = 40
#: symbols of the registered model: the classes of ASCII, then every other character by its own code point
POINTS = 1 << 15
BLOCK_NGRAMS = 5_200_000
#: n-grams that a task counts before it sends them
HELD = 4_000_000
#: share of the interquartile range that a band reaches beyond the quartiles, its least reach, and the length at which a text gets sqrt(2) of it
BAND, FLOOR, SHORT = 1.75, 0.03, 500
BIN = 1000
#: blocks of characters, and the costliest share of a text's that may be a quotation, an address, a passage in another language
BLOCK, QUOTED = 64, 0.1

_SYMBOL_CHARS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def _classes() -> np.ndarray:
    """Class of each byte: 0 is the start of a text, letters are 14 to 39."""
    c = np.full(256, 8, np.uint8)  # other ASCII marks
    c[:0x20] = 13
    c[0x20] = c[0x09] = 1
    c[0x0A] = c[0x0D] = 2
    c[0x30:0x3A] = 3
    c[0x41:0x5B] = 4
    c[0x61:0x7B] = 14 + np.arange(26)
    for k, chars in ((5, b"."), (6, b","), (7, b";:?'\"()-"), (9, b"!")):
        c[np.frombuffer(chars, np.uint8)] = k
    c[0x80:0xE0], c[0xE0:0xF0], c[0xF0:] = 10, 11, 12
    return c


_CLASS = _classes()


def _points(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lead bytes of the characters beyond ASCII, and a symbol for each, by its code point.

    Code points that are ``POINTS - SYMBOLS`` apart share a symbol; no script is that long.
    """
    at = np.flatnonzero(flat >= 0xC0)
    more = np.concatenate((flat, np.zeros(3, np.uint8))).astype(np.int64)
    lead = more[at]
    point = np.where(lead < 0xE0, lead & 0x1F, np.where(lead < 0xF0, lead & 0x0F, lead & 0x07))
    for j, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
        point = np.where(lead >= least, point << 6 | more[at + j] & 0x3F, point)
    return at, SYMBOLS + (point - 0x80) % (POINTS - SYMBOLS)


def grams(texts: list[bytes | None], symbols: int = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams that end at each character, and the bounds of each text among them."""
    pad = ORDER - 1
    flat = np.frombuffer(b"".join(b"\0" * pad + (t or b"") for t in texts), np.uint8)
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    begin = np.cumsum(np.concatenate(([0], sizes + pad)))
    symbol = _CLASS[flat].astype(np.int64)
    if symbols > SYMBOLS:
        at, own = _points(flat)
        symbol[at] = own
    for j in range(pad):
        symbol[begin[:-1] + j] = 0
    keep = (flat & 0xC0) != 0x80  # one symbol for each character
    before = np.concatenate(([0], np.cumsum(keep)))
    symbol = symbol[keep]
    key = np.zeros(len(symbol), np.int64)
    for j in range(ORDER):
        key = key * symbols + np.concatenate((np.zeros(min(pad - j, len(symbol)), np.int64), symbol[: max(0, len(symbol) - (pad - j))]))
    real = symbol != 0
    return key[real], np.concatenate(([0], np.cumsum(real)))[before[begin]]


def base_rules(words: arrays.Words, texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """Counts of the contract for each text."""
    flat, begin = words.flat, words.text_starts
    lead = (flat & 0xC0) != 0x80
    inside = np.cumsum(np.concatenate(([0], lead)))
    word_chars = arrays.sum_by(inside[words.ends] - inside[words.starts], words.first)
    symbols = arrays.sum_by(_SYMBOL_CHARS[flat].astype(np.int64), begin)
    # lines: cut at line feeds, which also end every text
    ends = np.flatnonzero(flat == 0x0A)
    starts = np.concatenate(([0], ends[:-1] + 1))
    owner = np.searchsorted(begin, starts, "right") - 1
    at = np.concatenate(([0], np.cumsum(arrays.NOT_SPACE[flat])))
    full = np.flatnonzero(at[ends] > at[starts])
    h = arrays.mix(arrays.span_hashes(flat, starts[full], ends[full]) + owner[full].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, first = np.unique(h, return_index=True)
    dup = np.ones(len(full), bool)
    dup[first] = False
    dup_lines = np.bincount(owner[full][dup], minlength=words.n_texts)
    # words in 8-word windows that occur twice or more in their text
    first, h = words.windows(8)
    h = arrays.mix(h + words.owner[first].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1] if len(h) else np.zeros(0, bool)
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    repeat = arrays.covered(first[again], 8, len(words.starts))
    return {"n_words": words.counts, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
            "n_repeat_words": arrays.sum_by(repeat.astype(np.int64), words.first)}


class KneserNey:
    """Interpolated modified Kneser-Ney model in sorted hash arrays, from the counts of its highest order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, symbols: int = SYMBOLS):
        self.symbols = symbols
        keys, counts = np.asarray(keys, np.int64), np.asarray(counts, np.int64)
        levels = [(keys, counts)]
        for n in range(ORDER - 1, 0, -1):  # continuation counts: how many characters precede each shorter n-gram
            k, c = np.unique(levels[0][0] % symbols**n, return_counts=True)
            levels.insert(0, (k, c))
        self.order: list[tuple[np.ndarray, np.ndarray]] = []
        self.backoff: list[tuple[np.ndarray, np.ndarray]] = []
        lower = None
        for n, (k, c) in enumerate(levels, 1):
            k, c = np.asarray(k, np.int64), np.asarray(c, np.float64)
            d = self._discounts(c)[np.minimum(c, 3).astype(int)]
            context, first = np.unique(k // symbols, return_index=True)
            bounds = np.append(first, len(k))
            total, cut = arrays.sum_by(c, bounds), arrays.sum_by(d, bounds)
            gamma = cut / np.maximum(total, 1e-300)
            own = np.repeat(np.arange(len(context)), np.diff(bounds))
            rest = np.full(len(k), 1 / symbols) if lower is None else lower[1][np.searchsorted(lower[0], k % symbols ** (n - 1))]
            p = (c - d) / total[own] + gamma[own] * rest if len(k) else np.zeros(0)
            lower = (k, p)
            for kept, ident, value in ((self.order, k, np.log(p)), (self.backoff, context, np.log(np.maximum(gamma, 1e-30)))):
                h = self._hash(ident, n)
                at = np.argsort(h)
                kept.append((h[at], value[at].astype(np.float32)))

    @staticmethod
    def _hash(k: np.ndarray, n: int) -> np.ndarray:
        return arrays.mix(k.astype(np.uint64) + np.uint64(n * 0x9E3779B97F4A7C15 % 2**64))

    @staticmethod
    def _discounts(c: np.ndarray) -> np.ndarray:
        """Discounts of counts 0, 1, 2 and 3 or more, from the counts of counts."""
        n1, n2, n3, n4 = (np.count_nonzero(c == i) for i in (1, 2, 3, 4))
        if not (n1 and n2 and n3 and n4):
            return np.array([0, 0.5, 0.5, 0.5])
        y = n1 / (n1 + 2 * n2)
        d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
        return np.clip(d, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.9, 2.85])

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, values = table
        if not len(keys):
            return np.zeros(len(h), bool), np.zeros(len(h))
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = keys[at] == h
        return hit, np.where(hit, values[at], 0.0)

    def log_p(self, keys: np.ndarray) -> np.ndarray:
        """Log-probability of the last character of each n-gram; unseen n-grams back off."""
        keys = np.asarray(keys, np.int64)
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        for n in range(ORDER, 0, -1):
            k = keys[todo] % self.symbols**n
            hit, value = self._find(self.order[n - 1], self._hash(k, n))
            out[todo[hit]] += value[hit]
            todo, k = todo[~hit], k[~hit]
            if not len(todo):
                return out
            out[todo] += self._find(self.backoff[n - 1], self._hash(k // self.symbols, n))[1]
        out[todo] += np.log(1 / self.symbols)
        return out


def _digest(text):
    """128 bits of a text's SHA-256."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _lang(df: DataFrame, lang_col: str):
    return F.coalesce(df[lang_col].cast("string"), F.lit("")) if lang_col in df.columns else F.lit("")


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the parts, and their counts added up."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], arrays.sum_by(counts, np.append(first, len(keys)))


def passes(texts: list[bytes | None]) -> np.ndarray:
    """Whether each text passes the base rules."""
    got = base_rules(arrays.Words(texts, arrays.NOT_SPACE), texts)
    return (got["n_words"] >= 20) & (100 * got["n_repeat_words"] <= 30 * got["n_words"])


def count(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", symbols: int = SYMBOLS, passing: bool = False) -> DataFrame:
    """Corpus counts: ``lang``, ``gram``, ``n`` over every character of every document; with ``passing``, of those that pass the base rules."""
    src = docs.select(_lang(docs, lang_col).alias("lang"), docs[text_col].cast("binary").alias("text"))

    def run(batches):
        import pyarrow as pa

        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def given():
            for lang, parts in held.items():
                k, c = _added(parts)
                for i in range(0, len(k), 100_000):
                    part = k[i:i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part), pa.array(c[i:i + 100_000])], names=["lang", "gram", "n"])
            held.clear()

        for batch in rows.sliced(batches):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                own = [t for x, t in zip(langs, texts) if x == lang]
                parts = held.setdefault(lang, [])
                for lo, hi in arrays.chunks(own):
                    part = own[lo:hi]
                    if passing:
                        part = [t for t, ok in zip(part, passes(part)) if ok]
                    parts.append(np.unique(grams(part, symbols)[0], return_counts=True))
                    if sum(len(k) for k, _ in parts[1:]) > max(500_000, len(parts[0][0])):
                        parts[:] = [_added(parts)]
            if sum(len(k) for parts in held.values() for k, _ in parts) > HELD:
                yield from given()
        yield from given()
        pa.default_memory_pool().release_unused()

    return src.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def distinct_texts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang`` and ``text`` of every distinct text of a language, once; copies meet in their task before they travel."""
    src = docs.select(_lang(docs, lang_col).alias("lang"), docs[text_col].cast("binary").alias("text")).where("length(text) > 0")
    return src.withColumn("digest", _digest(F.col("text"))).dropDuplicates(["lang", "digest"]).select("lang", "text")


def models(counts: DataFrame):
    """Blocks of models by language, of ``BLOCK_NGRAMS`` n-grams together or of one language."""
    sizes = {r["lang"]: r["k"] for r in counts.groupBy("lang").agg(F.count("*").alias("k")).collect()}
    block: list[str] = []
    for i, lang in enumerate(langs := sorted(sizes)):
        block.append(lang)
        if i + 1 == len(langs) or sum(sizes[x] for x in [*block, langs[i + 1]]) > BLOCK_NGRAMS:
            got = {}
            for x in block:
                t = counts.where(F.col("lang") == x).select("gram", "n").toArrow()
                k, c = t.column(0).to_numpy(), t.column(1).to_numpy()
                at = np.argsort(k)
                got[x] = KneserNey(k[at], c[at], POINTS)
            yield got
            block = []


MEASURES = T.StructType([T.StructField(c, T.LongType(), False) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams")]
                        + [T.StructField(c, T.DoubleType(), False) for c in ("log_perplexity", "core")] + [T.StructField("lang", T.StringType(), False)])


def core(cost: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean cost per character of each text over its blocks of ``BLOCK`` characters, but for the share ``QUOTED`` of the costliest."""
    n = np.diff(bounds)
    blocks = -(-n // BLOCK)
    first = np.cumsum(blocks) - blocks
    own = np.repeat(np.arange(len(n)), blocks)
    begin = bounds[own] + (np.arange(len(own)) - first[own]) * BLOCK
    size = np.minimum(BLOCK, bounds[own + 1] - begin)
    total = np.add.reduceat(cost, begin) if len(begin) else np.zeros(0)
    order = np.lexsort((total / size, own))
    keep = np.arange(len(own)) - first[own] < (blocks - (blocks * QUOTED).astype(np.int64))[own]
    kept = order[keep]
    return np.bincount(own[kept], total[kept], len(n)) / np.maximum(np.bincount(own[kept], size[kept], len(n)), 1)


def _measure(shared):
    def fn(texts, extra):
        model = shared.value
        out: dict[str, list] = {f.name: [np.zeros(0, np.float64 if f.dataType == T.DoubleType() else np.int64)] for f in MEASURES if f.name != "lang"}
        for lo, hi in arrays.chunks(texts):
            part, langs = texts[lo:hi], extra["lang"][lo:hi]
            got = base_rules(arrays.Words(part, arrays.NOT_SPACE), part)
            mean, inner, n = np.zeros(hi - lo), np.zeros(hi - lo), np.zeros(hi - lo, np.int64)
            for lang in dict.fromkeys(langs):
                own = [i for i, x in enumerate(langs) if x == lang]
                if lang not in model:
                    continue
                key, bounds = grams([part[i] for i in own], POINTS)
                seen = np.unique(key)  # looked up once each
                cost = -model[lang].log_p(seen)[np.searchsorted(seen, key)]
                n[own] = np.diff(bounds)
                mean[own], inner[own] = arrays.sum_by(cost, bounds) / np.maximum(n[own], 1), core(cost, bounds)
            got |= {"n_grams": n, "log_perplexity": mean, "core": inner}
            for k, v in got.items():
                out[k].append(v)
        return {k: np.concatenate(v) for k, v in out.items()} | {"lang": extra["lang"]}

    return fn


_DIGEST = "digest of the text"


def base_failed():
    return (F.col("res.n_words") < 20) | (F.lit(100) * F.col("res.n_repeat_words") > F.lit(30) * F.col("res.n_words"))


BANDS = ("log_perplexity", "core")


def bands(measured: DataFrame) -> dict[str, tuple[float, ...]]:
    """Lower quartile, upper quartile and reach per language of each of ``BANDS``, by exact histograms.

    ``measured`` has the text's digest in its ``row``: a text counts once, however many copies it has.
    """
    hist: dict[str, dict[int, list[tuple[int, int]]]] = {}
    at = F.array(*[F.floor(F.col(f"res.{c}") * BIN).cast("int") for c in BANDS])
    once = measured.where(~base_failed()).select(F.col("res.lang").alias("lang"), F.col(f"row.{_DIGEST}").alias("digest"), at.alias("at")).dropDuplicates(["lang", "digest"])
    once = once.select("lang", F.posexplode("at").alias("band", "at"))
    for r in once.groupBy("lang", "band", "at").agg(F.count("*").alias("n")).collect():
        hist.setdefault(r["lang"], {}).setdefault(r["band"], []).append((r["at"], r["n"]))
    out = {}
    for lang, both in hist.items():
        out[lang] = ()
        for _, h in sorted(both.items()):
            x, n = np.array(sorted(h)).T
            cum = np.cumsum(n)
            low, high = ((x[np.searchsorted(cum, q * cum[-1])] + 0.5) / BIN for q in (0.25, 0.75))
            out[lang] += (float(low), float(high), max(FLOOR, BAND * float(high - low)))
    return out


def assess(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", row: list[str] | None = None) -> DataFrame:
    """Columns ``row``, ``res`` (measures), ``base_failed`` and ``kept``, a row for each document."""
    spark = docs.sparkSession
    counts = count(distinct_texts(docs, text_col=text_col, lang_col=lang_col), symbols=POINTS, passing=True).persist()
    known: list[tuple[list[str], object]] = [(list(m), spark.sparkContext.broadcast(m)) for m in models(counts)]
    counts.unpersist()
    names = row if row is not None else docs.columns
    docs = docs.withColumn(_DIGEST, _digest(F.coalesce(docs[text_col].cast("binary"), F.lit(b""))))
    lang = _lang(docs, lang_col)
    unknown = ~lang.isin([x for langs, _ in known for x in langs]) if known else F.lit(True)

    def measured(names):
        parts = []
        for langs, model in [*known, (None, spark.sparkContext.broadcast({}))]:
            own = docs.where(lang.isin(langs) if langs else unknown)
            parts.append(rows.map_texts(own, text_col, _measure(model), MEASURES, row=names, extra={"lang": _lang(own, lang_col)}))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    if text_col not in names:  # narrow rows: one pass, written and read for the bands and for the verdict
        all_of = rows.stored(measured([*names, _DIGEST]))
        limits = bands(all_of)
        all_of = all_of.select(F.struct(*[F.col(f"row.`{c}`") for c in names]).alias("row"), "res")
    else:
        limits = bands(measured([_DIGEST]))
        all_of = measured(names)
    table = spark.createDataFrame([(k, *v) for k, v in limits.items()], "lang string, " + ", ".join(f"low_{c} double, high_{c} double, reach_{c} double" for c in BANDS))
    got = all_of.join(F.broadcast(table), F.col("res.lang") == table["lang"], "left")
    more = F.sqrt(1 + SHORT / F.greatest(F.col("res.n_grams"), F.lit(1)))
    whole, inner = (F.col(f"res.{c}").between(F.col(f"low_{c}") - F.col(f"reach_{c}") * more, F.col(f"high_{c}") + F.col(f"reach_{c}") * more) for c in BANDS)
    within = F.coalesce(whole | inner, F.lit(True))
    return got.select("row", "res", base_failed().alias("base_failed"), (~base_failed() & within).alias("kept"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Contract columns over the whole table."""
    got = assess(spark.read.parquet(f"{sf_dir}/documents.parquet"), row=["doc_id"])
    return got.select("row.doc_id", *[F.col(f"res.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      "base_failed", "kept", F.exp("res.log_perplexity").alias("perplexity"))


def keep(docs: DataFrame, **kw) -> DataFrame:
    """The documents that pass, with their own columns."""
    return assess(docs, **kw).where("kept").select(*[F.col(f"row.`{c}`") for c in docs.columns])
