"""Substring dedup by seed and extend.

Documents are joined on winnowed anchors (``seeds``): a stretch of windows that share an
anchor is the anchor extended both ways as far as its windows reach. Equal stretches
settle all their windows at once; where stretches with one anchor differ, each different
one is extended window by window, and the windows are compared. Overlapping matches join
into maximal repeats of ``window`` words or more. A word goes if a window that covers it
has the same words as one that starts earlier (smaller doc_id, or same document, earlier
start), judged on the input.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Anchors of ``GRAM`` words in windows of 20:
about one per 8 words.

Defined results: a null or empty text has no words; a text of fewer words than a window
keeps them all; rows that repeat a doc_id, and null ids, are documents of their own
(``common.keyed``), the later ones lose what the earlier ones have.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays as A
from . import common, seeds

WINDOW = 20
GRAM = 6


def _items(data, offsets):
    words = A.Words(data, offsets, A.SPACED_WORD)
    return words.hashes(data), words.first


def _settled(rows: DataFrame, window: int) -> DataFrame:
    """STRETCH rows with covered set for all but the first of equal ones, where n then counts words."""
    first = Window.partitionBy("key1", "key2", "covered").orderBy("id", "start")
    placed = rows.withColumn("later", ~F.col("covered") & (F.row_number().over(first) > 1))
    return placed.select("key1", "id", "start", F.when(F.col("later"), F.col("n") + (window - 1)).otherwise(
        F.col("n")).alias("n"), (F.col("covered") | F.col("later")).alias("covered"))


def _windows(asked: DataFrame, window: int) -> DataFrame:
    """The windows of stretches that were asked for, as STRETCH rows with n = 1."""

    def step(batches):
        held = seeds.Held(window, True)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in A.blocks(batch.column(1)):
                values, first = _items(data, offsets)
                lists = batch.column(2).slice(row, len(offsets) - 1)
                at, end = seeds.flat_spans(lists, first[:-1].astype(np.int64))
                start = np.repeat(at - np.concatenate([[0], np.cumsum(end - at)[:-1]]) if len(at) else at, end - at)
                start = start + np.arange(len(start))
                doc = np.searchsorted(first, start, "right") - 1
                yield from held.add(A.mix(A.Sums(values, 0).of(start, start + window)),
                                    A.mix(A.Sums(values, 1).of(start, start + window)),
                                    ids[row + doc], start - first[doc], np.ones(len(start), np.int64))
        yield from held.out()

    return asked.mapInArrow(step, seeds.STRETCH)


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, start, n): spans of words that repeat earlier ones; ``docs`` as ``common.keyed`` gives them."""
    rows = common.stage(_settled(seeds.seeded(docs, _items, window, gram, True), window), "stretches")
    asked, count = seeds.requests(rows.filter("not covered"))
    closer = _settled(_windows(seeds.asked_texts(docs, asked, count), window), window)
    return (rows.filter("covered").select("id", "start", "n")
            .unionByName(closer.filter("covered").select("id", "start", "n")))


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space) per document."""
    docs, _ = common.keyed(docs)
    spans = seeds.spans_by_doc(repeats(docs, window, gram))
    joined = docs.join(spans, "id", "left").select("doc_id", "text", "spans")
    schema = "doc_id {}, n_words long, n_removed long, kept string".format(docs.schema["doc_id"].dataType.simpleString())

    def step(batches):
        for batch in batches:
            for row, data, offsets in A.blocks(batch.column(1)):
                words = A.Words(data, offsets, A.SPACED_WORD)
                first = words.first.astype(np.int64)
                lists = batch.column(2).slice(row, len(offsets) - 1)
                gone = A.covered(len(words), *seeds.flat_spans(lists, first[:-1]))
                upto = np.concatenate([[0], np.cumsum(~gone)])
                out, at = A.joined_words(data, words.start[~gone], words.end[~gone])
                begin, stop = at[upto[first[:-1]]], at[upto[first[1:]]]
                whole = out.tobytes()
                kept = [whole[b: max(b, e - 1)].decode() for b, e in zip(begin.tolist(), stop.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(offsets) - 1), pa.array(np.diff(first)),
                    pa.array(np.diff(first) - np.diff(upto[first])), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(step, schema)
