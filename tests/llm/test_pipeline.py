"""The registered queries, their SQL twins, and the stages of the pipeline against the operators' plain versions."""

import hashlib

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from ptloom.llm.queries import ORACLE, QUERIES
from ptloom.llm.rows import stored

from .conftest import SF, words
from .test_operators import plain_chunk_dedup, plain_hits, plain_representatives


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(llm, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](llm, SF)
    want = con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = ", ".join(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, con.sql(f"SELECT {cols} FROM want").fetchall()))


def test_entry_registers_one_query_for_each_operator():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))


def test_stages(llm, docs):
    table = llm.read.parquet(f"{SF}/documents.parquet")
    for source in (table, docs, docs.limit(0)):
        now = source
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before = now
            now = stored(stage(llm, now, SF))
            if i < 4:
                assert now.columns == source.columns and now.dtypes == source.dtypes, name
            if name == "near_duplicates":
                pairs = [(r.doc_id, r.text) for r in before.collect()]
                kept = sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.text or "") for r in now.collect())
                want = plain_representatives(pairs)
                assert [i for i, _ in kept] == [i for i, _ in want]
                assert all(any(i == j and t in ts for j, ts in want) for i, t in kept)
            if name == "substring_dedup":
                want = plain_chunk_dedup([(2**63 - 1 if r.doc_id is None else r.doc_id, (r.text or "").encode()) for r in before.collect()], 100)
                kept = {w[0]: w[4].decode() for w in want if not w[2] or w[4].strip()}
                assert {2**63 - 1 if r.doc_id is None else r.doc_id: r.text or "" for r in now.collect()} == kept
                assert now.count() == len(want) - sum(bool(w[2]) and not w[4].strip() for w in want)
                assert all(r.text is None or r.n_chars == len(r.text) for r in now.collect())
            if name == "benchmark_decontamination":
                items = [(r.item_id, r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
                hits = {r.doc_id: plain_hits(r.text, items) for r in before.collect()}
                assert {r.doc_id for r in now.collect()} == {i for i, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)}
            if name == "bpe_tokens":
                texts_ = {r.doc_id: r.text or "" for r in before.collect()}
                assert {r.doc_id: r.decoded_sha256 for r in now.collect()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts_.items()}


def test_one_row_of_each_component_stays(llm):
    copy = words("copy", 60)
    pairs = [(None, copy), (None, copy), (7, copy), (7, copy), (9, copy + " more"), (None, words("own", 50)), (None, words("own", 50)), (None, " "), (None, ""), (None, None),
             (3, ""), (3, None), (4, "\n"), (7, words("other", 40)), (7, words("other", 40)), (12, words("other", 40))]
    df = llm.createDataFrame([(i, t, "en", "s", 1) for i, t in pairs], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    kept = corpus_pipeline.near_duplicates(llm, df, SF).collect()
    want = plain_representatives(pairs)
    assert sorted(2**63 - 1 if r.doc_id is None else r.doc_id for r in kept) == [i for i, _ in want] == [3, 4, 7, 7, 2**63 - 1, 2**63 - 1]


def test_remains_of_white_space_go(llm):
    passage = words("passage", 80)
    pairs = [(1, "intro " + passage), (2, "\n\n\t" + passage), (3, "\x0b\x0c " + passage + "\r\n"), (4, " "), (5, passage + " tail")]
    df = llm.createDataFrame([(i, t, "en", "s", len(t)) for i, t in pairs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text for r in corpus_pipeline.substring_dedup(llm, df, SF).collect()}
    assert set(kept) >= {1, 4, 5} and all(t.strip() or i == 4 for i, t in kept.items())


def test_run_keeps_clean_and_drops_copies(llm, tmp_path):
    long = [(i, words(("doc", i), 300)) for i in range(60)]
    rows = long + [(100, long[3][1]), (101, long[4][1] + " one more"), (102, "too short"), (103, words("q", 150) + " " + long[5][1][:600])]
    llm.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    llm.createDataFrame([(1, long[7][1][:400])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(llm, str(tmp_path)).collect()}
    assert not {100, 101, 102, 7} & set(got) and len(set(range(60)) & set(got)) >= 57 and 103 in got
