"""MinHash near-dedup: one-permutation hashing with optimal densification.

A document's set is its distinct 5-word shingles (A-Z lowered, words ``[^\\x20\\x09-\\x0D]+``;
with fewer words the whole sequence is one shingle). One hash of each shingle gives its bin
and its value; the least value of each bin is the signature. Empty bins borrow from a bin
that a fixed sequence of hashes of the bin's number finds first (optimal densification).
Bands of the signature are buckets.

Documents with equal sets are one class, handled once. In a bucket only a star is tried:
every class with the bucket's centre. Pairs are confirmed on the full sets. A star misses
links between two classes that both differ from the centre, so buckets whose classes are
not yet connected are tried again: first with the most typical class as centre (the one
with the fewest shingles of its own), then pair by pair between what is still apart. Two
bounds that no link can break keep these few: the sizes, and the shingles that no other
class in question has. Nothing is capped.

A pair at the similarity of 0.85 shares none of the 48 bands of 8 with a probability of
2.4e-7; this is all that the method may miss. Sets of fewer than 6 shingles can only be
linked when equal, and need no bands.

Defined results: a null text, or one without words, has an empty set and is linked with
nothing; rows that repeat a doc_id, and null ids, are documents of their own
(``common.keyed``), of which the first stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from . import common

SHINGLE = 5
SIMILARITY = 85  # of 100
BANDS, ROWS = 48, 8
_TRIES = 64
#: Bits of a set's outline: each shingle sets one.
OUTLINE = 1024
_SHIFT = np.uint64(10)  # hashes keep 54 bits: the rest is the document's place in a block


def _probes(bins: int) -> np.ndarray:
    """For each try the bin that an empty one looks at."""
    at = np.arange(_TRIES * bins, dtype=np.uint64)
    return (A.mix(at + np.uint64(77)) % np.uint64(bins)).astype(np.int64).reshape(_TRIES, bins)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all documents' distinct shingles, sorted within each; first of each document)."""
    words = A.Words(data, offsets, A.SPACED_WORD)
    first = words.first.astype(np.int64)
    count = np.diff(first)
    sums = A.Sums(words.hashes(A.LOWER[data]))
    at = np.arange(len(words))
    end = A.run_ends(first)
    short = np.repeat(count < SHINGLE, count)
    use = np.where(short, at == np.repeat(first[:-1], count), at + SHINGLE <= end)
    at, end, short = at[use], end[use], short[use]
    hashes = A.mix(sums.of(at, np.where(short, end, at + SHINGLE)))
    doc = np.searchsorted(first, at, "right") - 1
    keys = np.unique((doc.astype(np.uint64) << np.uint64(54)) | (hashes >> _SHIFT))
    places = np.searchsorted(keys, np.arange(len(first), dtype=np.uint64) << np.uint64(54))
    return keys & np.uint64((1 << 54) - 1), places


def signatures(values: np.ndarray, first: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """One-permutation signatures, densified: a row of bins for each document."""
    bins = probes.shape[1]
    docs = len(first) - 1
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(docs * bins, top)
    mixed = A.mix(values)
    cell = np.repeat(np.arange(docs), np.diff(first)) * bins + (mixed % np.uint64(bins)).astype(np.int64)
    np.minimum.at(out, cell, mixed // np.uint64(bins))
    out = out.reshape(docs, bins)
    full = out != top
    result = out.copy()
    row, column = np.nonzero(~full & full.any(axis=1)[:, None])
    for probe in probes:
        if not len(row):
            break
        found = full[row, probe[column]]
        result[row[found], column[found]] = out[row[found], probe[column[found]]]
        row, column = row[~found], column[~found]
    for r in np.unique(row):  # hardly ever: the next bin that is not empty
        own = np.flatnonzero(full[r])
        mine = column[row == r]
        result[r, mine] = out[r, own[np.searchsorted(own, mine) % len(own)]]
    return result


def _profiles(docs: DataFrame) -> DataFrame:
    """(id, n, set1, set2, bands): size and hash of the set, and bucket keys."""

    def step(batches):
        probes = _probes(BANDS * ROWS)
        for batch in batches:
            for row, data, offsets in A.blocks(batch.column(1), rows=1000):
                values, first = shingle_sets(data, offsets)
                size = np.diff(first)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(A.mix(values + np.uint64(k)))]) for k in (1, 2)]
                signature = signatures(values, first, probes)
                bands = np.zeros((len(size), BANDS), np.uint64)
                for r in range(ROWS):
                    bands = A.mix(bands ^ signature[:, r::ROWS]) + np.arange(BANDS, dtype=np.uint64)
                able = size > 5
                ends = np.concatenate([[0], np.cumsum(np.where(able, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(size)), pa.array(size),
                    *(pa.array((s[first[1:]] - s[first[:-1]]).view(np.int64)) for s in sums),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[able].reshape(-1).view(np.int64)))],
                    names=["id", "n", "set1", "set2", "bands"])

    return docs.select("id", "text").mapInArrow(step, "id long, n long, set1 long, set2 long, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """(id, shingles: array<long>, outline: array<long>)."""

    def step(batches):
        for batch in batches:
            for row, data, offsets in A.blocks(batch.column(1), rows=1000):
                values, first = shingle_sets(data, offsets)
                bits = np.zeros((len(first) - 1, OUTLINE), bool)
                bits[np.repeat(np.arange(len(bits)), np.diff(first)), (A.mix(values) % np.uint64(OUTLINE)).astype(np.int64)] = True
                outlines = np.packbits(bits, axis=1).view(np.int64)
                ends = np.arange(len(bits) + 1, dtype=np.int32) * outlines.shape[1]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(bits)),
                    pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(outlines.reshape(-1)))],
                    names=["id", "shingles", "outline"])

    return docs.select("id", "text").mapInArrow(step, "id long, shingles array<long>, outline array<long>")


def _alike(inter, a, b):
    """Whether sets of a and b elements that share inter are linked."""
    return 100 * inter >= SIMILARITY * (a + b - inter)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b")), "b"))
    inter = F.size(F.array_intersect("of_a", "of_b"))
    return both.filter(_alike(inter, F.size("of_a"), F.size("of_b"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id that each linked id can reach. Labels spread along links and
    jump to their label's label, so the rounds grow with the logarithm of the longest path."""
    ways = common.stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = common.stage(ways.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select(
        "id", F.least("id", "b").alias("label")), "labels")
    while True:
        heard = (ways.join(labels, ways["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("heard")))
        told = labels.join(heard, labels["id"] == heard["a"], "left").select(
            "id", "label", F.least("label", "heard").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("beyond"))
        fresh = common.stage(told.join(jump, "next", "left").select(
            "id", F.least("next", "beyond").alias("label"), F.col("label").alias("was")), "labels")
        labels_next = fresh.select("id", "label")
        if fresh.filter("label < was").isEmpty():
            return labels_next
        labels = labels_next


def _apart(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket rows (key, id, n, ...) of buckets that hold more than one component, with label."""
    known = rows.drop("label").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    known = common.stage(known, "labelled")
    keys = known.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter(
        "least < most").select("key")
    keys = common.stage(keys, "apart")
    return common.stage(known.join(common.sized(keys, keys.count(), 32), "key"), "apart-rows")


def links(reps: DataFrame, docs: DataFrame) -> DataFrame | None:
    """(id, label) of the linked classes among ``reps`` (id, n, bands), whose texts are in docs."""
    rows = reps.select("id", "n", F.explode("bands").alias("key"))
    shared = common.stage(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("id", "n")).alias("centre"))
        .filter("size > 1").select("key", "centre"), "buckets")
    rows = common.stage(rows.join(common.sized(shared, shared.count(), 48), "key"), "bucket-rows")
    people = common.stage(rows.select("id").distinct(), "people")
    count = people.count()
    if not count:
        return None
    sets = common.stage(_sets(docs.select("id", "text").join(common.sized(people, count, 24), "id", "left_semi")), "sets")

    star = rows.filter(F.col("id") > F.col("centre.id")).filter(
        _alike(F.least("n", "centre.n"), F.col("n"), F.col("centre.n"))).select(
        F.col("centre.id").alias("a"), F.col("id").alias("b"))
    tried = common.stage(star.distinct(), "tried")
    found = common.stage(_confirmed(tried, sets), "confirmed")
    labels = components(found)

    rows = _apart(rows.select("key", "id", "n"), labels)
    left = common.stage(rows.select("id").distinct(), "left")
    own = (sets.join(left, "id").select("id", F.explode("shingles").alias("shingle"))
           .groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"), F.min("id").alias("id"))
           .filter("holders = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own")))
    shares = common.stage(left.join(own, "id", "left").join(sets.select("id", "outline"), "id").select(
        "id", F.coalesce("own", F.lit(0)).alias("own"), "outline"), "own")
    rows = rows.join(shares, "id").filter(_alike(F.col("n") - F.col("own"), F.col("n"), F.col("n") - F.col("own")))
    rows = _apart(rows.select("key", "id", "n", "own", "outline"), labels)

    def may(a, b):
        inter = F.least(F.col(f"{a}.n") - F.col(f"{a}.own"), F.col(f"{b}.n") - F.col(f"{b}.own"))
        both = F.col(f"{a}.n") + F.col(f"{b}.n")
        differ = sum((F.bit_count(F.col(f"{a}.outline")[k].bitwiseXOR(F.col(f"{b}.outline")[k])) for k in range(OUTLINE // 64)), F.lit(0))
        return ((F.col(f"{a}.label") != F.col(f"{b}.label")) & _alike(inter, F.col(f"{a}.n"), F.col(f"{b}.n"))
                & (differ <= both - 2 * F.ceil(SIMILARITY * both / (100 + SIMILARITY))))

    centre = common.stage(rows.groupBy("key").agg(F.min(F.struct("own", "id", "n", "label", "outline")).alias("y")), "centres")
    again = (rows.select("key", F.struct("own", "id", "n", "label", "outline").alias("x")).join(centre, "key").filter(may("x", "y"))
             .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())
    again = common.stage(again.join(tried, ["a", "b"], "left_anti"), "tried-again")
    found = common.stage(found.union(_confirmed(again, sets)), "confirmed")
    labels = components(found)

    rows = _apart(rows, labels)
    half = rows.select("key", F.struct("own", "id", "n", "label", "outline").alias("x"))
    rest = (half.join(half.withColumnRenamed("x", "y"), "key")
            .filter((F.col("x.id") < F.col("y.id")) & may("x", "y"))
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    rest = common.stage(rest.join(tried.union(again), ["a", "b"], "left_anti"), "rest")
    if rest.isEmpty():
        return labels
    return components(common.stage(found.union(_confirmed(rest, sets)), "confirmed"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that can be reached) and kept of
    every document."""
    return _classes(*common.keyed(docs)).drop("id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The first document of every component, with all columns."""
    keyed, numbered = common.keyed(docs)
    found = common.stage(_classes(keyed, numbered).select("id", "kept", "n_shingles"), "near-classes")
    if not numbered:
        gone = common.stage(found.filter("not kept").select(F.col("id").alias("__id")), "gone")
        return docs.join(common.sized(gone, gone.count(), 24), docs["doc_id"] == gone["__id"], "left_anti")
    ruled = (keyed.join(found, "id").groupBy(F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
             .agg(F.max("kept").alias("__kept"), F.max("n_shingles").alias("__n")).filter("__kept"))
    stay = docs.join(ruled, common.same(docs["doc_id"], F.col("__id")) & common.same(docs["text"], F.col("__text")))
    return (stay.filter("__n = 0").unionByName(stay.filter("__n > 0").dropDuplicates(["__id", "__text"]))
            .select(*docs.columns))


def _classes(docs: DataFrame, numbered: bool) -> DataFrame:
    """``classes`` with id, the key of ``common.keyed``."""
    profiles = common.stage(_profiles(docs), "profiles")
    reps = common.stage(
        profiles.filter("n > 0").groupBy("set1", "set2", "n").agg(F.min(F.struct("id", "bands")).alias("first"))
        .select("set1", "set2", "n", "first.*"), "classes")
    labels = links(reps.select("id", "n", "bands"), docs)
    member = profiles.select("id", "n", "set1", "set2").join(
        reps.select("set1", "set2", "n", F.col("id").alias("rep")), ["set1", "set2", "n"], "left")
    member = member.withColumn("rep", F.coalesce("rep", "id"))
    if labels is not None:
        member = member.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left")
        member = member.withColumn("rep", F.coalesce("label", "rep"))
    member = member.select("id", F.col("n").alias("n_shingles"), F.col("rep").alias("component"))
    if not numbered:
        return member.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                             (F.col("id") == F.col("component")).alias("kept"), "id")
    names = docs.select("id", "doc_id")
    firsts = names.select(F.col("id").alias("component"), F.col("doc_id").alias("component_id"))
    return (member.join(names, "id").join(firsts, "component")
            .select("doc_id", "n_shingles", "component_id", (F.col("id") == F.col("component")).alias("kept"), "id"))
