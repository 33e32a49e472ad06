"""Every pipeline stage against a plain version, each on its own input; and the registration."""

import public_tokenizers as P
import pytest
import sentencepiece

import __spark_entry__ as E
import brute
import corpus_pipeline
from tramline.llm import common, ordinal_quality, queries

SF_SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = common.read_table(spark, SF_SMALL, "documents")
    out = [docs.toPandas()]
    for name, step in corpus_pipeline.STAGES:
        docs = common.stage(step(spark, docs, SF_SMALL), name.replace(" ", "-"))
        assert docs.columns[: len(COLUMNS)] == COLUMNS
        out.append(docs.toPandas())
    return out


def _rows(table):
    return list(zip(table.doc_id.tolist(), table.text.tolist()))


def test_quality_stage(spark, stages):
    docs = common.read_table(spark, SF_SMALL, "documents")
    judged = ordinal_quality.judged(docs, ordinal_quality.rated(common.read_table(spark, SF_SMALL, "labels")))
    want = {r.doc_id for r in judged.collect() if r.p_good >= ordinal_quality.KEEP}
    assert set(stages[1].doc_id) == want and 0 < len(want) < len(stages[0])


def test_exact_stage(stages):
    assert sorted(stages[2].doc_id) == sorted(w[0] for w in brute.exact(_rows(stages[1])) if w[3])


def test_near_stage(stages):
    assert sorted(stages[3].doc_id) == sorted(w[0] for w in brute.near(_rows(stages[2])) if w[3])


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in common.read_table(spark, SF_SMALL, "benchmark").collect()]
    assert sorted(stages[4].doc_id) == sorted(w[0] for w in brute.decontamination(_rows(stages[3]), items) if not w[4])


def test_encoding_stage(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    last = stages[5]
    assert sorted(last.doc_id) == sorted(stages[4].doc_id)
    for text, ids, decoded, n in zip(last.text, last.ids, last.decoded, last.n_tokens):
        assert list(ids) == library.encode(text) and decoded == library.decode(list(ids)) and n == len(ids)


def test_every_dealt_query_is_registered():
    names = set(E.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(rel.columns)
    want = sorted(map(repr, rel.select(*df.columns).fetchall()))
    assert sorted(repr(tuple(r)) for r in df.collect()) == want
