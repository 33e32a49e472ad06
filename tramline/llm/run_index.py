"""Substring dedup with a run-length index.

Every byte covered by a 200-byte string that also starts anywhere else goes; copies that
overlap count, and strings are judged on the input.

Documents are cut into stretches of windows that share a winnowed anchor (``seeds``), so
that all windows that can be equal meet under one key whatever the corpus' size. Equal
stretches settle at once. The different stretches of one anchor are a small, highly
repetitive corpus; a task gathers anchors up to ``CHUNK_BYTES`` of it and builds the
run-length index: suffix array, Burrows-Wheeler transform, its runs, and the suffix
positions at run heads and run ends with their match lengths. Within a run the
transform maps neighbours to neighbours, so the match length of any other position is that
of the sampled position before it less the distance: matching statistics stream
over the text from r samples. Positions that match ``window`` bytes elsewhere are marked.

Every anchor takes this way. One with more than ``CROWD`` different stretches (the edge of a
passage that very many documents hold) is first divided into smaller keys, in ever longer
common cores: a window either has half of what it needs to the left of its core or half
of it to the right, so a stretch falls into two parts, each under the key of its longer core.
Equal windows always meet under one key; parts that are equal settle at once, parts
that are alone under their key are done, and keys that an index takes in go to it. A core is a
whole window after eight halvings at most. Rows grow with the stretches, not with
their windows or their pairs.

Defined results: a null or empty text has no bytes and no spans; a text shorter than a
window stays whole; rows that repeat a doc_id, and null ids, are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from . import common, seeds

WINDOW = 200
GRAM = 32
#: Different stretches of one key that an index takes in; a key with more is divided.
CROWD = 512
#: Text of stretches that a task holds before it settles what it can among their halves.
HALVED_BYTES = 16 << 20
#: Text of one index.
CHUNK_BYTES = 1 << 20
#: Text that is hashed at once; each byte takes some ten 8-byte values.
BLOCK = 1 << 20


def suffix_array(symbols: np.ndarray, top: int) -> np.ndarray:
    """Order of all suffixes of symbols (0 <= symbol < top), which must be pairwise different
    within their length, by doubling the sorted prefix."""
    n = len(symbols)
    bits = max(1, int(top).bit_length())
    width = max(1, 62 // bits)
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(width, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(width):
        key = (key << bits) | padded[i: i + n]
    while True:
        order = np.argsort(key)
        ahead = key[order]
        new = np.concatenate([[0], np.cumsum(ahead[1:] != ahead[:-1])])
        if n == 0 or new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        follow = np.zeros(n, np.int64)
        if width < n:
            follow[:-width] = rank[width:] + 1
        key = rank * (n + 1) + follow
        width *= 2


def _lengths(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols from a and from b are equal, for pairs of positions."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    n, step = len(symbols), 0
    while len(live):
        x, y = a[live] + step, b[live] + step
        inside = (x < n) & (y < n)
        equal = inside & (symbols[np.minimum(x, n - 1)] == symbols[np.minimum(y, n - 1)])
        live = live[equal]
        out[live] += 1
        step += 1
    return out


def matching_statistics(texts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each byte of texts (string k in texts[ends[k]:ends[k + 1]]) the length of the longest
    match that starts there and occurs at another position, inside strings."""
    m = len(ends) - 1
    size = np.diff(ends)
    at = np.arange(len(texts)) + np.repeat(np.arange(m), size)  # a different separator behind each string
    symbols = np.empty(len(texts) + m, np.int64)
    symbols[at] = texts.astype(np.int64) + m
    symbols[ends[1:] + np.arange(m)] = np.arange(m)
    n = len(symbols)
    if n < 2:
        return np.zeros(len(texts), np.int64)
    order = suffix_array(symbols, m + 256)
    bwt = symbols[order - 1]
    head = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1  # runs of the transform; the first row is a head too
    best = np.zeros(n, np.int64)
    for sampled, other, edge in ((order[head], order[head - 1], order[0]), (order[head - 1], order[head], order[-1])):
        position = np.concatenate([sampled, [edge]])
        length = np.concatenate([_lengths(symbols, sampled, other), [0]])
        by = np.argsort(position)
        position, length = position[by], length[by]
        run = np.searchsorted(position, np.arange(n), "right") - 1
        statistic = np.where(run >= 0, length[run] - (np.arange(n) - position[run]), 0)
        np.maximum(best, statistic, out=best)
    return best[at]


def _items(data, offsets):
    return data, offsets.astype(np.int64)


def _settled(rows: DataFrame, *more: str) -> DataFrame:
    """Rows as the task left them, with met (all n windows of that place repeat) and alone (one of
    each different stretch, n windows)."""
    equal = Window.partitionBy("key1", "key2", "covered")
    one = equal.orderBy("id", "start")
    met = ~F.col("covered") & ~F.col("many") & (F.count(F.lit(1)).over(equal) > 1)
    return rows.select("key1", "id", "start", "n", "covered", met.alias("met"),
                       (~F.col("covered") & (F.row_number().over(one) == 1)).alias("alone"), *more)


def _gone(rows: DataFrame, window: int) -> DataFrame:
    return rows.filter("covered or met").select(
        "id", "start", F.when(F.col("met"), F.col("n") + (window - 1)).otherwise(F.col("n")).alias("n"))


#: A stretch with its bytes: n windows, and where in body the core begins.
PIECE = T.StructType([
    T.StructField("key1", T.LongType()), T.StructField("id", T.LongType()), T.StructField("start", T.IntegerType()),
    T.StructField("n", T.IntegerType()), T.StructField("core", T.IntegerType()), T.StructField("body", T.BinaryType())])


def _core(body: bytes, key: int, gram: int) -> int:
    """Where the k-gram with that hash first begins."""
    data = np.frombuffer(body, np.uint8)
    at = np.arange(len(data) - gram + 1)
    return int(np.argmax(A.mix(A.Sums(data).of(at, at + gram)).view(np.int64) == key))


def _pieces(texts: DataFrame, window: int, gram: int, crowded: bool) -> DataFrame:
    """PIECE rows of the stretches that an index takes in, or of the crowded ones."""

    def step(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, (text, asked) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                rows = [a for a in asked.as_py() if (a["stretches"] > CROWD) == crowded]
                if rows:
                    bodies = [data[a["start"]: a["start"] + a["n"] + window - 1] for a in rows]
                    cores = [_core(b, a["key1"], gram) if crowded else 0 for a, b in zip(rows, bodies)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([a["key1"] for a in rows], pa.int64()), pa.array([ids[i]] * len(rows), pa.int64()),
                        pa.array([a["start"] for a in rows], pa.int32()), pa.array([a["n"] for a in rows], pa.int32()),
                        pa.array(cores, pa.int32()), pa.array(bodies, pa.binary())], names=PIECE.names)

    return texts.mapInArrow(step, PIECE)


def halves(data, offsets, start, n, core, length: int, window: int):
    """The two parts of stretches (bytes data[offsets[k]:offsets[k + 1]], cores of ``length`` bytes):
    (stretch, key1, key2, first byte in data, start, n, core) of those that have windows. A
    core of a part is longer by half of what a window has besides it."""
    half = (window - length + 1) // 2
    left = np.clip(core - half + 1, 0, n)  # windows with that much before the core
    none = np.zeros(len(n), np.int64)
    of = np.concatenate([np.arange(len(n))] * 2)
    skip, count = np.concatenate([none, left]), np.concatenate([left, n - left])
    place = np.concatenate([core - half, core - left])
    side = np.concatenate([none, none + 1])
    of, skip, count, place, side = (x[count > 0] for x in (of, skip, count, place, side))
    first = offsets[of] + skip
    at = first + place
    key1 = A.mix(A.Sums(data, 0).of(at, at + length + half) + side.astype(np.uint64))
    return of, key1, A.mix(A.Sums(data, 1).of(first, first + count + window - 1)), first, start[of] + skip, count, place


def _halved(pieces: DataFrame, window: int, length: int) -> DataFrame:
    """STRETCH rows, with core and body, of the parts of pieces; settled inside the task."""

    def settled(held):
        size = [len(b) for h in held for b in h[4]]
        ids, start, n, core = (np.concatenate([h[i] for h in held]) for i in range(4))
        joined = b"".join(b for h in held for b in h[4])
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        of, key1, key2, first, start, n, core = halves(np.frombuffer(joined, np.uint8), offsets, start, n, core, length, window)
        rows = seeds.settle(key1, key2, ids[of], start, n, window, False)
        by_place = {p: k for k, p in enumerate(zip(ids[of].tolist(), start.tolist(), strict=True))}
        found = [None if c else by_place[i, s] for i, s, c in zip(*(rows.column(x).to_pylist() for x in ("id", "start", "covered")), strict=True)]
        cores = pa.array([None if k is None else int(core[k]) for k in found], pa.int32())
        bodies = pa.array([None if k is None else joined[first[k]: first[k] + n[k] + window - 1] for k in found], pa.binary())
        return rows.append_column("core", cores).append_column("body", bodies)

    def step(batches):
        held, size = [], 0
        for batch in batches:
            numbers = [batch.column(c).to_numpy().astype(np.int64) for c in ("id", "start", "n", "core")]
            held.append((*numbers, batch.column("body").to_pylist()))
            size += batch.column("body").nbytes
            if size >= HALVED_BYTES:
                yield settled(held)
                held, size = [], 0
        if size:
            yield settled(held)

    return pieces.mapInArrow(step, T.StructType([*seeds.STRETCH.fields, *PIECE.fields[-2:]]))


def _divided(crowd: DataFrame, window: int, gram: int):
    """Frames (id, start, n) of spans that repeat among PIECE rows with one key, whatever their number."""
    length = gram
    while length < window:
        rows = common.stage(_settled(_halved(crowd, window, length), "core", "body"), "halves")
        yield _gone(rows, window)
        length += (window - length + 1) // 2
        alone = rows.filter("alone")
        shared = common.stage(alone.groupBy("key1").agg(F.count(F.lit(1)).alias("stretches")).filter("stretches > 1"), "shared")
        known = alone.join(common.sized(shared, shared.count(), 32), "key1")
        yield _indexed(known.filter(F.col("stretches") <= CROWD), window)
        crowd = known.filter(F.col("stretches") > CROWD).select(*PIECE.names)
        if shared.filter(F.col("stretches") > CROWD).isEmpty():
            return


def _indexed(pieces: DataFrame, window: int) -> DataFrame:
    """(id, start, n): spans that repeat among pieces with one key."""

    def spans(rows):
        ids, starts = (np.concatenate([r[i] for r in rows]) for i in (1, 2))
        bodies = [b for r in rows for b in r[3]]
        ends = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64)
        found = matching_statistics(np.frombuffer(b"".join(bodies), np.uint8), ends) >= window
        hit = np.flatnonzero(found)
        k = np.searchsorted(ends, hit, "right") - 1
        place = starts[k] + hit - ends[k]
        d, s, e = seeds.merged(ids[k], place, place + window)
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(s.astype(np.int32)), pa.array((e - s).astype(np.int32))],
                                          names=["id", "start", "n"])

    def step(batches):
        held, size, last = [], 0, None
        for batch in batches:
            keys = batch.column(0).to_numpy()
            ids, starts = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64)
            bodies = batch.column(3).to_pylist()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]]).tolist()
            for b, e in zip(cuts, cuts[1:]):
                if e == b:
                    continue
                if size >= CHUNK_BYTES and keys[b] != last:
                    yield spans(held)
                    held, size = [], 0
                held.append((keys[b:e], ids[b:e], starts[b:e], bodies[b:e]))
                size += sum(map(len, bodies[b:e]))
                last = keys[b]
        if held:
            yield spans(held)

    return (pieces.select("key1", "id", "start", "body").repartition("key1").sortWithinPartitions("key1")
            .mapInArrow(step, "id long, start int, n int"))


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, start, n): spans of bytes that occur elsewhere; ``docs`` as ``common.keyed`` gives them."""
    rows = common.stage(_settled(seeds.seeded(docs, _items, window, gram, False, BLOCK)), "stretches")
    asked, count = seeds.requests(rows.filter("alone"))
    texts = common.stage(seeds.asked_texts(docs, asked, count), "asked-texts")
    found = _gone(rows, window).unionByName(_indexed(_pieces(texts, window, gram, False), window))
    crowded = texts.filter(F.exists("asked", lambda a: a["stretches"] > CROWD))
    if not crowded.select("id").isEmpty():
        for spans in _divided(_pieces(crowded, window, gram, True), window, gram):
            found = found.unionByName(spans)
    return found


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary: the bytes that stay) per document."""
    docs, _ = common.keyed(docs)
    spans = seeds.spans_by_doc(repeats(docs, window, gram))
    joined = docs.join(spans, "id", "left").select("doc_id", "text", "spans")
    schema = "doc_id {}, n_bytes long, n_removed long, n_spans long, kept binary".format(
        docs.schema["doc_id"].dataType.simpleString())

    def step(batches):
        for batch in batches:
            for row, data, offsets in A.blocks(batch.column(1)):
                lists = batch.column(2).slice(row, len(offsets) - 1)
                gone = A.covered(len(data), *seeds.flat_spans(lists, offsets[:-1]))
                edge = np.zeros(len(data) + 1, bool)
                edge[offsets] = True
                opens = gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]]))
                left = np.concatenate([[0], np.cumsum(~gone)])[offsets]
                runs = np.concatenate([[0], np.cumsum(opens)])[offsets]
                kept = pa.BinaryArray.from_buffers(pa.binary(), len(left) - 1, [
                    None, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(data[~gone])])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(left) - 1), pa.array(np.diff(offsets)),
                    pa.array(np.diff(offsets) - np.diff(left)), pa.array(np.diff(runs)), kept],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(step, schema)
