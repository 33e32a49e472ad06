"""Seeds for finding repeats, shared by the two substring operators.

A window is W consecutive items (words or bytes) of one document. Winnowing picks one
k-gram of every window, the one with the least hash (leftmost of equals), so equal
windows pick the same k-gram at the same place. Windows next to each other that pick the
same k-gram are one stretch; stretches cover every window once, and there are about
2 / (W - k + 2) of them per item. Two windows can only be equal if their stretches have
the same k-gram, so stretches are joined on it:

1. equal stretches (k-gram and a hash of all their items) need no look at single windows;
2. where one k-gram has several different stretches, one of each is extended to its
   windows, which are then compared.

A task settles what it can by itself before anything shuffles: of equal stretches it
passes on one, so a passage that a third of all documents hold reaches the shuffle once
per task and not once per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from . import common

#: Stretches that a task holds before it settles what it can among them.
HELD = 600_000

#: key1, key2: what equal rows share; place: document and first window; n: windows, or items
#: where covered is set; many: met twice already.
STRETCH = T.StructType([
    T.StructField("key1", T.LongType()), T.StructField("key2", T.LongType()),
    T.StructField("id", T.LongType()), T.StructField("start", T.IntegerType()),
    T.StructField("n", T.IntegerType()), T.StructField("covered", T.BooleanType()),
    T.StructField("many", T.BooleanType())])

#: A document's share of spans: flat starts and ends.
_NONE = np.zeros(0, np.int64)


def stretches(values: np.ndarray, first: np.ndarray, window: int, gram: int):
    """(first window, last window, k-gram hash, hash of all items) of every stretch of a block."""
    n = len(values)
    if n < window:
        return (_NONE,) * 2 + (np.zeros(0, np.uint64),) * 2
    at = np.arange(n - gram + 1)
    grams = A.mix(A.Sums(values).of(at, at + gram))
    low = np.uint64((1 << int(n).bit_length()) - 1)
    least = A.sliding_min((grams & ~low) | at.astype(np.uint64), window - gram + 1)
    whole = np.flatnonzero(A.run_ends(first)[: n - window + 1] >= np.arange(window, n + 1))
    if not len(whole):
        return (_NONE,) * 2 + (np.zeros(0, np.uint64),) * 2
    anchor = (least[whole] & low).astype(np.int64)
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(whole) != 1)) + 1
    begin, stop = np.concatenate([[0], new]), np.concatenate([new, [len(whole)]]) - 1
    lo, hi = whole[begin], whole[stop]
    return lo, hi, grams[anchor[begin]], A.mix(A.Sums(values, 1).of(lo, hi + window))


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of half-open spans of documents: (doc, start, end), touching spans joined."""
    if not len(doc):
        return doc, start, end
    names, place = np.unique(doc, return_inverse=True)
    s, e = (place.astype(np.int64) << 32) + start, (place.astype(np.int64) << 32) + end
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    cut = np.flatnonzero(s[1:] > e[:-1]) + 1
    s, e = s[np.concatenate([[0], cut])], e[np.concatenate([cut, [len(e)]]) - 1]
    return names[s >> 32], s & 0xFFFFFFFF, e & 0xFFFFFFFF


def settle(key1, key2, doc, start, n, window: int, keep_first: bool):
    """Of equal rows only the first goes on. The others' items are covered (and the first's as
    well, unless ``keep_first``); covered items leave as merged spans under a key of their own."""
    order = np.lexsort((start, doc, key2, key1))
    key1, key2, doc, start, n = (x[order] for x in (key1, key2, doc, start, n))
    head = np.ones(len(order), bool)
    head[1:] = (key1[1:] != key1[:-1]) | (key2[1:] != key2[:-1])
    group = np.cumsum(head) - 1
    many = (np.bincount(group) > 1)[group] if len(group) else head
    gone = ~head if keep_first else many
    d, s, e = merged(doc[gone], start[gone].astype(np.int64), start[gone] + n[gone].astype(np.int64) - 1 + window)
    spread = A.mix(d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + s.astype(np.uint64))
    no, zero = np.zeros(len(d), bool), np.zeros(len(d), np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([key1[head].view(np.int64), spread.view(np.int64)])),
        pa.array(np.concatenate([key2[head].view(np.int64), zero])),
        pa.array(np.concatenate([doc[head], d])),
        pa.array(np.concatenate([start[head], s]).astype(np.int32)),
        pa.array(np.concatenate([n[head], e - s]).astype(np.int32)),
        pa.array(np.concatenate([np.zeros(int(head.sum()), bool), ~no])),
        pa.array(np.concatenate([many[head], no]))], names=STRETCH.names)


class Held:
    """Rows of a task until there are enough of them to settle."""

    def __init__(self, window: int, keep_first: bool):
        self.window, self.keep_first = window, keep_first
        self.rows: list[tuple] = []
        self.count = 0

    def add(self, key1, key2, doc, start, n):
        self.rows.append((key1, key2, doc, start, n))
        self.count += len(key1)
        if self.count >= HELD:
            yield from self.out()

    def out(self):
        if self.count:
            columns = [np.concatenate(c) for c in zip(*self.rows, strict=True)]
            self.rows, self.count = [], 0
            yield settle(*columns, self.window, self.keep_first)


def seeded(docs: DataFrame, items, window: int, gram: int, keep_first: bool,
           block: int = A.BLOCK_BYTES) -> DataFrame:
    """STRETCH rows of documents (id, text); ``items(data, offsets)`` gives (values, first)."""

    def step(batches):
        held = Held(window, keep_first)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in A.blocks(batch.column(1), block):
                values, first = items(data, offsets)
                lo, hi, key1, key2 = stretches(values, first, window, gram)
                doc = np.searchsorted(first, lo, "right") - 1
                yield from held.add(key1, key2, ids[row + doc], lo - first[doc], hi - lo + 1)
        yield from held.out()

    return docs.select("id", "text").mapInArrow(step, STRETCH)


def requests(firsts: DataFrame) -> tuple[DataFrame, int]:
    """Of different stretches those whose k-gram another one has, by document:
    (id, asked: array of (start, n, key1)), and the number of documents."""
    shared = common.stage(
        firsts.groupBy("key1").agg(F.count(F.lit(1)).alias("stretches")).filter("stretches > 1"), "shared")
    shared = common.sized(shared, shared.count(), 32)
    by_doc = common.stage(
        firsts.join(shared, "key1").groupBy("id").agg(
            F.collect_list(F.struct("start", "n", "key1", "stretches")).alias("asked")), "asked")
    return by_doc, by_doc.count()


def asked_texts(docs: DataFrame, by_doc: DataFrame, count: int, width: int = 64) -> DataFrame:
    """(id, text, asked) of the documents that were asked for."""
    ids = common.sized(by_doc.select("id"), count, width)
    return docs.select("id", "text").join(ids, "id", "left_semi").join(by_doc, "id")


def spans_by_doc(covered: DataFrame) -> DataFrame:
    """(id, spans): all (start, n) of a document; bounded by the document's own length."""
    return covered.groupBy("id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def flat_spans(column: pa.ListArray, base: np.ndarray):
    """Starts and ends of a batch's span lists, moved to the block by each row's base; and rows."""
    size = np.diff(column.offsets.to_numpy()).astype(np.int64)
    inner = column.flatten()
    start = inner.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
    n = inner.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
    moved = np.repeat(base, size)
    return start + moved, start + n + moved
