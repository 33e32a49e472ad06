"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered: 0 toxic, 1 low quality, 2 good. One weight vector over hashed text
features is shared by all grades and ordered thresholds part them:
P(grade <= k) = sigmoid(threshold[k] - score). A document gets its expected grade and the
tail probability P(grade >= 2), on which selection rests.

Features of a whole text: its words (A-Z lowered) and its runs of symbols, hashed to
``2 ** BITS`` slots with the square root of their share in the text, and bands of four
shape ratios (capitals, symbols, different words, length).

The model is fitted on at most ``SAMPLE`` labelled rows, those with the smallest hash of
doc_id; every document is scored.

Defined results: a null text is scored as an empty one (length band alone); labels with a
null are ignored; a doc_id that is labelled twice counts twice; repeated documents get equal
rows; without labels every document has the same score and is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from . import common

BITS = 18
#: Labelled rows that the model is fitted on at most.
SAMPLE = 12_000
#: A document stays if its probability of the top grade is as high.
KEEP = 0.5
GRADES = 3
#: A feature counts if as many of the fitted rows have it.
LEAST_ROWS = 4
_STEPS, _RATE = 250, 4.0

_SYMBOL = A.byte_set(lambda b: 0x21 <= b <= 0x7E and not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
_CAPITAL = A.byte_set(lambda b: 0x41 <= b <= 0x5A)
_LETTER = A.byte_set(lambda b: b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


def _counts(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(upto[offsets])


def features(data: np.ndarray, offsets: np.ndarray):
    """(slots, values, first, words): sparse rows of a block's documents, and their word counts."""
    docs = len(offsets) - 1
    words = A.Words(data, offsets, A.LETTER_WORD)
    marks = A.Words(data, offsets, _SYMBOL)
    lower = A.LOWER[data]
    n_words = np.diff(words.first)
    doc = np.concatenate([words.document(), marks.document()])
    slot = np.concatenate([words.hashes(lower), marks.hashes(data) + np.uint64(1)]) & np.uint64((1 << BITS) - 1)
    key, tf = np.unique((doc.astype(np.int64) << BITS) | slot.astype(np.int64), return_counts=True)
    kinds = np.bincount(key >> BITS, minlength=docs)
    total = np.maximum(n_words + np.diff(marks.first), 1)
    value = np.sqrt(tf / total[key >> BITS])
    size = np.maximum(np.diff(offsets), 1)
    letters = np.maximum(_counts(_LETTER[data], offsets), 1)
    ratios = np.stack([
        np.minimum(10 * _counts(_CAPITAL[data], offsets) // letters, 9),
        np.minimum(40 * _counts(_SYMBOL[data], offsets) // size, 9),
        np.minimum(10 * kinds // total, 9),
        np.minimum(np.log2(total + 1).astype(np.int64), 15)])
    shape = (A.mix((ratios + 16 * np.arange(4)[:, None] + 1000).astype(np.uint64)) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    key = np.concatenate([key, (np.arange(docs) << BITS) + shape.reshape(4, docs) if docs else np.zeros((4, 0), np.int64)], axis=None)
    value = np.concatenate([value, np.full(4 * docs, 0.3)])
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    return key & ((1 << BITS) - 1), value, np.searchsorted(key >> BITS, np.arange(docs + 1)), n_words


def scores(slots, values, first, weights) -> np.ndarray:
    upto = np.zeros(len(slots) + 1)
    part = weights[slots]
    part *= values
    np.cumsum(part, out=upto[1:])
    return upto[first[1:]] - upto[first[:-1]]


def _below(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade <= k) for k = -1 .. GRADES - 1, a column each."""
    inner = 1 / (1 + np.exp(-np.clip(thresholds - score[:, None], -40, 40)))
    return np.concatenate([np.zeros((len(score), 1)), inner, np.ones((len(score), 1))], axis=1)


def fit(slots, values, first, grades) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the largest likelihood, by adaptive gradient steps."""
    weights = np.zeros(1 << BITS)
    thresholds = np.array([-1.0, 1.0])
    if not len(grades):
        return weights, np.array([-3.0, -1.5])
    known = np.bincount(slots, minlength=1 << BITS) >= LEAST_ROWS
    values = values * known[slots]
    sizes = np.diff(first)
    seen, past, at = np.full(1 << BITS, 1e-8), np.full(2, 1e-8), np.arange(len(grades))
    for _ in range(_STEPS):
        below = _below(scores(slots, values, first, weights), thresholds)
        p = np.maximum(below[at, grades + 1] - below[at, grades], 1e-12)
        slope = below * (1 - below)  # of P(grade <= k) by its threshold
        pull = (slope[at, grades + 1] - slope[at, grades]) / p / len(grades)  # of the loss by the score
        part = np.repeat(pull, sizes)
        part *= values
        step = np.bincount(slots, weights=part, minlength=1 << BITS)
        del part
        seen += step * step
        weights -= _RATE * step / np.sqrt(seen)
        push = np.array([(slope[:, k + 1] * ((grades == k + 1) / p - (grades == k) / p)).mean() for k in range(GRADES - 1)])
        past += push * push
        thresholds = np.sort(thresholds - _RATE * push / np.sqrt(past))
        thresholds[1] = max(thresholds[1], thresholds[0] + 1e-3)
    return weights, thresholds


def rated(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from quality and toxic flags."""
    return labels.filter("doc_id is not null and quality is not null and toxic is not null").select(
        "doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2).alias("grade"))


def trained(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The model, fitted in one task on a bounded sample of ratings (doc_id, grade)."""
    chosen = common.stage(ratings.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample), "ratings")
    chosen = common.sized(chosen.select(F.col("doc_id").alias("__rated"), "grade"), sample, 24)
    labelled = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("__rated")).select(
        "text", "grade", F.xxhash64("doc_id", "grade", "text").alias("by"))

    def rows(batches):
        for batch in batches:
            for row, data, offsets in A.blocks(batch.column(0)):
                slots, values, first, _ = features(data, offsets)
                ends = pa.array(first.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(row, len(first) - 1), batch.column(2).slice(row, len(first) - 1),
                    pa.ListArray.from_arrays(ends, pa.array(slots.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(values.astype(np.float32)))], names=["grade", "by", "slots", "weights"])

    def model(batches):
        grades, slots, values, sizes = ([np.zeros(0, np.int64)] for _ in range(4))
        for batch in batches:
            grades.append(batch.column(0).to_numpy().astype(np.int64))
            slots.append(batch.column(2).flatten().to_numpy().astype(np.int64))
            values.append(batch.column(3).flatten().to_numpy().astype(float))
            sizes.append(np.diff(batch.column(2).offsets.to_numpy()))
        # the batches' parts go before the fit begins
        grades, slots, values, sizes = [np.concatenate(parts) for parts in (grades, slots, values, sizes)]
        weights, thresholds = fit(slots, values, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), grades)
        yield pa.RecordBatch.from_arrays([
            pa.array([weights.astype(np.float32).tobytes()]), pa.array([thresholds.tobytes()])], names=["weights", "thresholds"])

    # all tasks read documents; only the sample's sparse rows meet in one, in a fixed order
    found = (labelled.mapInArrow(rows, "grade int, by long, slots array<int>, weights array<float>")
             .repartition(1).sortWithinPartitions("by").mapInArrow(model, "weights binary, thresholds binary").first())
    if found is None:  # no labelled document, no task
        none = np.zeros(0, np.int64)
        return fit(none, none.astype(float), np.zeros(1, np.int64), none)
    return np.frombuffer(found[0], np.float32).astype(float), np.frombuffer(found[1], float)


OWN = ("n_words", "expected_grade", "p_good", "selected")


def judged(docs: DataFrame, ratings: DataFrame, *, sample: int = SAMPLE, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of docs (all by default), then n_words, expected_grade, p_good and selected.
    Columns of docs with these names are left out."""
    own = list(OWN)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    at = keep.index("text") if "text" in keep else len(keep)
    source = docs.select(*keep, *([] if "text" in keep else ["text"]))
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_words", T.LongType()), T.StructField("expected_grade", T.DoubleType()),
        T.StructField("p_good", T.DoubleType()), T.StructField("selected", T.BooleanType())])
    n_keep = len(keep)
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, ratings, sample))

    def step(batches):
        weights, thresholds = shared.value
        for batch in batches:
            for row, data, offsets in A.blocks(batch.column(at)):
                slots, values, first, n_words = features(data, offsets)
                above = 1 - _below(scores(slots, values, first, weights), thresholds)[:, 1:GRADES]
                good = np.round(above[:, -1], 6)
                part = batch.slice(row, len(n_words))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(n_keep)), pa.array(n_words.astype(np.int64)),
                     pa.array(np.round(above.sum(axis=1), 6)), pa.array(good), pa.array(good >= KEEP)], names=[*keep, *own])

    return source.mapInArrow(step, schema)


def selected(docs: DataFrame, ratings: DataFrame, *, sample: int = SAMPLE) -> DataFrame:
    """The documents that stay, with all their columns."""
    safe, back = common.shielded(docs, OWN)
    return judged(safe, ratings, sample=sample).filter("selected").select(*safe.columns).withColumnsRenamed(back)
