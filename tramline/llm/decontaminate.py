"""Benchmark decontamination by suffix arrays of the training text.

The training text is indexed shard by shard (a shard is one Arrow batch of documents, or
part of one): a suffix array over word positions, from which every suffix of the benchmark
is searched by bisection. A range of the array is all places of a match; the neighbours of
the point of insertion give the longest verbatim match. A word that no benchmark item has
ends a suffix, so only runs of benchmark words, as many as the shortest window has, enter
the array; no match can begin anywhere else. Suffixes are compared by ranks of their first
1, 2, 4, ... words, so memory grows with the words, not with the longest item.

The benchmark is the stated query set. It goes to the tasks in blocks of ``BLOCK_BYTES`` by
a hash of its item id; however large it grows, no block does.

Words: A-Z lowered, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window is ``window``
consecutive words of an item; an item of fewer words, but not none, is one window.

Defined results: a null text has no words; an item without words matches nothing; rows that
repeat an item id are one item; a null item id takes part under the name "null"; rows that
repeat a document give equal rows; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from . import common

WINDOW = 10
#: Benchmark text of one block.
BLOCK_BYTES = 4 << 20
#: Benchmark words of a shard, after which it ends with the block of text.
SHARD_WORDS = 1 << 20


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = A.Words(data, offsets, A.LETTER_WORD)
    return words.hashes(A.LOWER[data]), words.first.astype(np.int64)


class Queries:
    """One block of the benchmark: the word numbers of its items, a 0 behind each, and the words
    from each place to the item's end."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.names = [name for name, _ in items]
        text = pa.array([t for _, t in items], pa.string())
        hashes, first = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for _, data, offsets in A.blocks(text):
            h, f = _words(data, offsets)
            first.append(f[1:] + first[-1][-1])
            hashes.append(h)
        hashes, first = np.concatenate(hashes), np.concatenate(first)
        self.vocabulary = np.unique(hashes)
        size = np.diff(first)
        #: Words that a match needs at least.
        self.least = int(min(window, size[size > 0].min(initial=window)))
        self.item = np.repeat(np.arange(len(size)), size)
        self.start = np.arange(len(hashes)) - first[:-1][self.item]
        self.need = np.minimum(window, size[self.item])
        self.at = np.arange(len(hashes)) + self.item  # a 0 stands behind each item before
        self.ids = np.zeros(len(hashes) + len(size), np.int32)
        self.ids[self.at] = np.searchsorted(self.vocabulary, hashes) + 1
        self.left = np.zeros(len(self.ids), np.int32)
        self.left[self.at] = np.repeat(first[1:], size) - np.arange(len(hashes))


class Shard:
    """Suffix array of documents of one Arrow batch, for one block of the benchmark: every run of
    benchmark words that is long enough, with a 0 behind it.

    The suffixes of the runs and of the benchmark are ranked together by prefix doubling: a
    level holds the ranks by the first 1, 2, 4, ... words, so memory is a few numbers a word
    and level. Only groups that hold suffixes of both sides, and words behind those compared,
    are taken further; ranks of the two sides are equal if and only if so many words are.
    """

    def __init__(self, queries: Queries, parts: list[tuple[np.ndarray, ...]]):
        ids, left, doc, place = (np.concatenate(c) for c in zip(*parts, strict=True))
        own = len(queries.ids)
        self.left = np.concatenate([queries.left, left])
        self.levels = self._levels(np.concatenate([queries.ids, ids]), self.left, own)
        at = own + np.flatnonzero(ids)
        self.suffixes = at[np.argsort(self.levels[-1][at], kind="stable")]
        self.doc, self.place = doc[self.suffixes - own], place[self.suffixes - own]

    @staticmethod
    def _levels(ids: np.ndarray, left: np.ndarray, own: int) -> list[np.ndarray]:
        count = np.bincount(ids)
        rank = (np.cumsum(count) - count)[ids]  # a group's rank is how many suffixes are before it
        rank[ids == 0] = -1
        levels, words = [rank], 1
        at = np.flatnonzero(ids)
        while True:
            at = at[np.argsort(rank[at], kind="stable")]
            group, of = Shard._groups(rank[at])
            theirs = np.add.reduceat(at >= own, group) if len(at) else group
            longer = np.maximum.reduceat(left[at], group) > words if len(at) else group > 0
            size = np.diff(np.append(group, len(at)))
            at = at[((theirs > 0) & (theirs < size) & longer)[of]]
            if not len(at):
                return levels
            second = np.where(left[at] > words, rank[np.minimum(at + words, len(rank) - 1)], -1)
            order = np.lexsort((second, rank[at]))
            at, second = at[order], second[order]
            before = rank[at]
            group, of = Shard._groups(before)
            new = np.ones(len(at), bool)
            new[1:] = (before[1:] != before[:-1]) | (second[1:] != second[:-1])
            begin = np.flatnonzero(new)[np.cumsum(new) - 1]
            rank = rank.copy()
            rank[at] = before + begin - group[of]
            levels.append(rank)
            words *= 2

    @staticmethod
    def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted keys where each group of equal ones begins, and the group of each."""
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        return np.flatnonzero(new), np.cumsum(new) - 1

    def common(self, mine: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """How many words from a place of the benchmark and in a suffix of the array are equal."""
        a, b = mine.copy(), self.suffixes[suffix]
        for k in range(len(self.levels) - 1, -1, -1):
            step = np.where(self.levels[k][a] == self.levels[k][b], np.minimum(1 << k, self.left[a]), 0)
            a, b = a + step, b + step
        return a - mine

    def points(self, queries: Queries) -> np.ndarray:
        """Where each suffix of the benchmark stands in the array, by bisection."""
        return np.searchsorted(self.levels[-1][self.suffixes], self.levels[-1][queries.at])

    def _edge(self, mine, need, inside, outside) -> np.ndarray:
        """Between a place of the array that shares ``need`` words and one that does not, the last that does."""
        while (apart := np.abs(inside - outside) > 1).any():
            middle = np.where(apart, (inside + outside) // 2, inside)
            good = self.common(mine, middle) >= need
            inside, outside = np.where(good, middle, inside), np.where(apart & ~good, middle, outside)
        return inside

    def hits(self, queries: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Every place of every window: (document, first word, words, window), and the items of each window."""
        starts = np.flatnonzero(queries.left[queries.at] >= queries.need)
        mine, need = queries.at[starts], queries.need[starts]
        point = self.points(queries)[starts]
        near = np.stack([np.maximum(point - 1, 0), np.minimum(point, len(self.suffixes) - 1)])
        shared = np.stack([self.common(mine, n) >= need for n in near])
        found = shared.any(axis=0)
        starts, mine, need = starts[found], mine[found], need[found]
        inside = np.where(shared[0], near[0], near[1])[found]
        low = self._edge(mine, need, inside, np.full(len(mine), -1))
        high = self._edge(mine, need, inside, np.full(len(mine), len(self.suffixes))) + 1
        # of equal length, windows with one range are one window
        order = np.lexsort((need, low))
        new = np.ones(len(order), bool)
        new[1:] = (low[order][1:] != low[order][:-1]) | (need[order][1:] != need[order][:-1])
        one = order[new]
        items = [np.unique(i) for i in np.split(queries.item[starts[order]], np.flatnonzero(new)[1:])] if len(order) else []
        size = high[one] - low[one]
        window = np.repeat(np.arange(len(one)), size)
        at = np.arange(len(window)) + np.repeat(low[one] - (np.cumsum(size) - size), size)
        return self.doc[at], self.place[at], need[one][window], window, items

    def longest(self, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix of the benchmark the length of its longest match and where in the array."""
        best, where = np.zeros(len(queries.at), np.int64), np.zeros(len(queries.at), np.int64)
        point = self.points(queries)
        for at in (np.maximum(point - 1, 0), np.minimum(point, len(self.suffixes) - 1)):
            equal = self.common(queries.at, at)
            where = np.where(equal > best, at, where)
            best = np.maximum(best, equal)
        return best, where


def word_counts(texts: pa.Array) -> np.ndarray:
    words = np.zeros(len(texts), np.int64)
    for row, data, offsets in A.blocks(texts):
        words[row: row + len(offsets) - 1] = np.diff(A.Words(data, offsets, A.LETTER_WORD).first)
    return words


def shards(texts: pa.Array, queries: Queries):
    """The shards of one Arrow batch: as many blocks of text as give ``SHARD_WORDS`` benchmark words."""
    parts, held = [], 0
    for row, data, offsets in A.blocks(texts):
        hashes, first = _words(data, offsets)
        if not len(queries.vocabulary) or not len(hashes):
            continue
        near = np.minimum(np.searchsorted(queries.vocabulary, hashes), len(queries.vocabulary) - 1)
        ids = np.where(queries.vocabulary[near] == hashes, near + 1, 0).astype(np.int32)
        # words from here that are all benchmark words, inside the document
        stops = np.concatenate([np.flatnonzero(ids == 0), [len(ids)]])
        here = np.arange(len(ids))
        left = np.minimum(stops[np.searchsorted(stops, here)], A.run_ends(first)) - here
        begin = np.zeros(len(ids), bool)
        begin[1:] = left[:-1] <= 1
        begin[0] = True
        begin &= left > 0
        run = np.flatnonzero(begin)
        run = run[left[run] >= queries.least]
        if not len(run):
            continue
        size = left[run] + 1  # with the 0 behind
        upto = np.cumsum(size)
        at = np.arange(upto[-1]) + np.repeat(run - (upto - size), size)
        at[upto - 1] = run  # any place
        ids, left = ids[at], left[at].astype(np.int32)
        ids[upto - 1] = left[upto - 1] = 0
        d = np.searchsorted(first, at, "right") - 1
        parts.append((ids, left, (row + d).astype(np.int32), (at - first[d]).astype(np.int32)))
        held += len(at)
        if held >= SHARD_WORDS:
            yield Shard(queries, parts)
            parts, held = [], 0
    if parts:
        yield Shard(queries, parts)


def query_blocks(benchmark: DataFrame, window: int) -> list:
    """The benchmark as broadcast blocks, at least one."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / BLOCK_BYTES))
    if count == 1:
        blocks = [items]
    else:
        items = common.stage(items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count))), "benchmark")
        blocks = [items.filter(F.col("block") == k).select("item", "text") for k in range(count)]
    return [spark.sparkContext.broadcast(Queries([tuple(r) for r in b.collect()], window)) for b in blocks]


OWN = ("n_words", "n_hit", "items", "contaminated")


def judged(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of docs (all by default), then n_words, n_hit, items (array of item ids,
    sorted as strings) and contaminated. Columns of docs with these names are left out."""
    own = list(OWN)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    at = keep.index("text") if "text" in keep else len(keep)
    source = docs.select(*keep, *([] if "text" in keep else ["text"]))
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("contaminated", T.BooleanType())])
    n_keep = len(keep)
    blocks = query_blocks(benchmark, window)

    def step(batches):
        for batch in batches:
            none = np.zeros(0, np.int64)
            spans, pairs, words = [(none, none, none)], set(), word_counts(batch.column(at))
            for block in blocks:
                queries = block.value
                for shard in shards(batch.column(at), queries):
                    doc, place, size, which, of = shard.hits(queries)
                    spans.append((doc, place, place + size))
                    for d, w in np.unique(np.stack([doc, which], axis=1), axis=0).tolist():
                        pairs.update((d, queries.names[i]) for i in of[w].tolist())
            base = np.concatenate([[0], np.cumsum(words)])
            doc, start, end = (np.concatenate(c) for c in zip(*spans, strict=True))
            hit = np.add.reduceat(np.concatenate([A.covered(int(base[-1]), base[doc] + start, base[doc] + end), [False]]).astype(np.int64),
                                  base[:-1]) if batch.num_rows else words
            hit = np.where(words > 0, hit, 0)
            items: list[list[str]] = [[] for _ in range(batch.num_rows)]
            for d, name in sorted(pairs):
                items[d].append(name)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(n_keep)), pa.array(words), pa.array(hit),
                 pa.array(items, pa.list_(pa.string())), pa.array(hit > 0)], names=[*keep, *own])

    return source.mapInArrow(step, schema)


def clean(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """The documents that hold no window of the benchmark, with all their columns."""
    safe, back = common.shielded(docs, OWN)
    found = judged(safe, benchmark, window=window).filter("not contaminated")
    return found.select(*safe.columns).withColumnsRenamed(back)


def longest_matches(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """(item, start, n_words, doc_id, doc_start): the longest verbatim match, of as many words as a
    window has at least, of every suffix of the benchmark that has one; of equal lengths, the
    place of the smallest doc_id."""
    blocks = query_blocks(benchmark, window)
    source = docs.select("doc_id", "text")

    def step(batches):
        for batch in batches:
            for block in blocks:
                queries = block.value
                for shard in shards(batch.column(1), queries):
                    best, where = shard.longest(queries)
                    found = np.flatnonzero(best >= queries.least)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([queries.names[i] for i in queries.item[found]], pa.string()),
                        pa.array(queries.start[found]), pa.array(best[found]),
                        batch.column(0).take(pa.array(shard.doc[where[found]])), pa.array(shard.place[where[found]].astype(np.int64))],
                        names=["item", "start", "n_words", "doc_id", "doc_start"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = source.mapInArrow(step, f"item string, start long, n_words long, doc_id {kind}, doc_start long")
    best = F.max_by(F.struct("n_words", "doc_id", "doc_start"), F.struct("n_words", -F.col("doc_id")))
    return found.groupBy("item", "start").agg(best.alias("b")).select("item", "start", "b.*")
