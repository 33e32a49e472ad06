"""Vector codes, token counts and importance resampling against their plain versions."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import sentencepiece

import brute
from conftest_llm import bag, docs, frame, rows  # noqa: F401
from tramline.llm import importance, slices, token_counts, vector_codes

MODEL = P.path("piece_bpe_32k.model")


def test_slices_hold_as_many_rows_as_the_bytes_allow():
    texts = ["a" * n for n in (3, 0, 4, 90, 1, 1, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    parts = [p.column(0).to_pylist() for p in slices.by_bytes([batch, batch.slice(0, 0)], "t", 7)]
    assert sum(parts, []) == texts and [len(p) for p in parts] == [3, 1, 4]


def test_sums_by_row():
    assert slices.sums_by_row(np.arange(5), np.array([0, 0, 2, 5, 5])).tolist() == [0, 1, 9, 0]


# --- vector codes -----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(12))
def test_orchard_search_finds_the_nearest_entry_and_the_lower_of_equals(seed):
    rng = np.random.default_rng(seed)
    width, size, parts = rng.integers(1, 17), rng.integers(1, 257), rng.integers(1, 5)
    reach = (3, 500, 10**6)[seed % 3]  # small numbers: many equal distances and equal entries
    entries = rng.integers(-reach, reach, (parts, size, width)).astype(np.int64)
    vectors = rng.integers(-reach, reach, (300, parts * width)).astype(np.int64)
    code, far = vector_codes.Codebooks(entries).nearest(vectors)
    every = ((vectors.reshape(300, parts, 1, width) - entries[None]) ** 2).sum(3)
    assert (code == every.argmin(2)).all() and (far == every.min(2)).all()


def test_orchard_search_measures_fewer_than_all_entries_where_they_lie_in_groups():
    rng = np.random.default_rng(1)
    heart = rng.integers(-4000, 4000, (16, 8))
    entries = (heart[np.arange(256) % 16] + rng.integers(-20, 20, (256, 8)))[None].astype(np.int64)
    books = vector_codes.Codebooks(entries)
    near = heart[np.arange(200) % 16] + rng.integers(-20, 20, (200, 8))
    code, _ = books.nearest(near)
    assert (code % 16 == (np.arange(200) % 16)[:, None]).all()
    # from the found entry on, most of its list lies beyond twice the distance
    far = ((near - entries[0][code[:, 0]]) ** 2).sum(1)
    assert (books.from_on[0][code[:, 0]] <= far[:, None]).mean() < 0.25


def _vectors(seed, n=120, repeat=True):
    rng = random.Random(seed)
    vector = lambda: [round(rng.uniform(-1, 1), 2) for _ in range(8)]
    out = [(7 * i % 1009, vector(), rng.choice([None, 1, 2])) for i in range(n)]
    odd = [(5000, None, 1), (5001, [], 1), (5002, [0.5] * 7 + [None], 1), (5003, [float("nan")] * 8, 1), (5004, [0.1] * 7 + [math.inf], None)]
    if repeat:
        odd += [out[3], out[3], (out[4][0], out[5][1], None), (None, vector(), 9), (None, out[6][1], None)]
    return out + odd


VECTORS = "vec_id long, embedding array<double>, label int, code string, id string, slot int, s0 int, of int"


@pytest.mark.parametrize("entries", [256, 16, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_vector_codes(spark, seed, entries):
    given = _vectors(seed)
    random.Random(seed).shuffle(given)
    table = spark.createDataFrame([(*r, "x", None, 1, 2, 3) for r in given], VECTORS).repartition(3)
    found = vector_codes.compressed(table, entries=entries).collect()
    want, books = brute.codes(given, entries=entries)
    assert bag((r.vec_id, r.code, r.error, r.label_error) for r in found) == bag(want)
    flat = ",".join(str(c) for book in books for entry in book for c in entry)
    assert {r.codebooks_sha256 for r in found} == {hashlib.sha256(flat.encode()).hexdigest()}


def test_vector_codes_of_nothing(spark):
    table = spark.createDataFrame([(1, None, 1, *[None] * 5), (2, [], 1, *[None] * 5)], VECTORS)
    found = vector_codes.compressed(table)
    assert found.collect() == [] and found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.compressed(table.limit(0)).collect() == []


def test_vectors_that_cannot_be_coded_raise(spark):
    for vectors in ([[0.1] * 8, [0.1] * 4], [[0.1] * 6], [[1e9] * 8]):
        table = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
        with pytest.raises(Exception, match="one length|64 bits"):
            vector_codes.compressed(table.coalesce(1)).collect()


# --- token counts -----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("limit", [4096, 3])
def test_token_counts(docs, rows, limit):  # noqa: F811
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = token_counts.counted(docs, MODEL, limit=limit, keep=["doc_id", "id"]).collect()
    want = [(d, len((t or "").encode()), len(library.encode(t or ""))) for d, t in rows]
    assert bag((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == bag((*w, w[2] > limit) for w in want)


def test_token_counts_on_noise():
    known, rng = token_counts.Lengths(MODEL), random.Random(6)
    alphabet = [*"abcdethéèß \n\t  ▁.,!AB12\x00​😀漢字", "  ", "\r\n", "<s>", "</s>", "<0x41>", " \n", "\n "]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(4000)] + ["a" * 3000, " " * 500, "▁", " x", "x ", "\n", ""]
    want = [len(i) for i in known.library.encode(texts)]
    assert known.counts(pa.array(texts)).tolist() == want
    assert known.counts(pa.array(texts)).tolist() == want  # from the worker's own table


def test_tables_of_lengths_change_no_count(monkeypatch):
    plain = token_counts.Lengths(MODEL)
    texts = pa.array(["one two three two two", "two  three\nfour", "x" * 400 + " two"])
    names = ["two", "three"]
    table = token_counts.Lengths(MODEL, (pa.array(names), np.array(plain.encoded(names), np.int64)))
    monkeypatch.setattr(token_counts, "REMEMBERED", 1)
    for _ in range(4):  # generations of the worker's own table come and go
        assert table.counts(texts).tolist() == plain.counts(texts).tolist() == [len(i) for i in plain.library.encode(texts.to_pylist())]


def test_frequent_pre_tokens_come_from_all_rows(spark):
    common = [(i, f"often n{i} often rare{i % 50}") for i in range(400)]
    found = token_counts.frequent(spark.createDataFrame([*common, (1, None), (2, "")], "doc_id long, text string").repartition(5), k=40, tracked=64)
    assert "often" in found and len(found) <= 40
    assert token_counts.frequent(spark.createDataFrame([], "doc_id long, text string")) == []


def test_a_model_that_cannot_be_cut_is_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "id_to_piece", lambda self, i: f"a▁b{i}")
    with pytest.raises(ValueError, match="cut at spaces"):
        token_counts.Lengths(MODEL)


def test_kept_columns_do_not_clash(docs):  # noqa: F811
    with pytest.raises(ValueError, match="n_bytes"):
        token_counts.counted(docs.withColumnRenamed("n", "n_bytes"), MODEL, limit=1, keep=["n_bytes"])


# --- importance resampling --------------------------------------------------------------------------------------

def test_features_are_the_crcs_of_all_runs():
    rng = random.Random(8)
    texts = ["".join(rng.choices([*"abcABZÉé1 \n.,\x00[`{~\x7f\x80  "], k=rng.randint(0, 80))) for _ in range(1500)]
    texts += ["x" * 300 + " " + "y" * 47 + " z " + "w" * 48, "", "a", " a b ", "ŐK"]
    for part in (texts, ["", "."], []):
        ends, runs = importance.features(pa.array(part, pa.string()))
        row = np.repeat(np.arange(len(part)), np.diff(ends))
        got = [[] for _ in part]
        for n, (at, bucket) in enumerate(runs):
            for r, b in zip(row[at], bucket):
                got[r].append((n, int(b)))
        for text, own in zip(part, got):
            w = brute.LETTERED.findall(brute.lowered(text))
            assert sorted(own) == sorted((n, brute.zlib.crc32(" ".join(w[i:i + n + 1]).encode()) % 10_000)
                                         for n in range(3) for i in range(len(w) - n))


@pytest.mark.parametrize("percent", [5, 60])
def test_importance_resampling(spark, docs, rows, percent):  # noqa: F811
    target = [t for _, t in rows if t][:6] + [None, "", "con con"]
    items = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, n string")
    found = importance.resampled(docs, items, percent=percent).collect()
    want = brute.resampled(rows, target, percent=percent)
    # rows alike in all that orders them share their ranks in either order
    assert bag(tuple(r) for r in found) == bag(want)
    assert sorted(r.rank for r in found if r.rank) == list(range(1, percent * sum(len(brute.LETTERED.findall(brute.lowered(t))) >= 20 for _, t in rows) // 100 + 1))


def test_ranks_over_many_ranges_and_ties(spark):
    rows_ = [(i, " ".join(["same"] * 25)) for i in range(3000)] + [(9000 + i, "short") for i in range(50)]
    table = spark.createDataFrame(rows_, "doc_id long, text string").repartition(7)
    found = importance.resampled(table, table.limit(0), percent=50).collect()
    assert bag(tuple(r) for r in found) == bag(brute.resampled(rows_, [], percent=50))
