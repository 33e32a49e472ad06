"""Token-ID output in training order.

The documents of an input split, each with an end id behind it, are one row of token ids
that is cut into sequences of ``length`` ids (the split's last is padded). They are encoded once
and staged with their split and their place in it; with the splits' running totals every
sequence has a number of its own, and N is known. A keyed Feistel permutation over the next
power of four, walked along its cycle until it falls below N, gives each number its
slot, 0 .. N - 1, from key and number alone, so a run that is repeated finds the same order.
What a batch sends to one shard is shuffled as one compressed block.

Slots are partitioned by ranges: shard k holds the slots from k * per_shard on, in order, in one
file of records of equal size, and all shards but the last hold per_shard of them. Slot s
is at byte (s mod per_shard) * stride of shard s // per_shard, so a reader can start, or
resume, at any slot and read on (``read(start=...)``).

A record is number, document, offset (of the first id's document and its place there), count
of ids before the padding, the ids as little-endian uint16, and a line end. Files
are written by Spark's text writer, which commits whole files, so a lost executor leaves
no part of one.

Defined results: a null or empty text is the end id alone; rows that repeat a document are
documents of their own; a null doc_id is written as the least long; an empty table gives
no sequences and no shards.
"""

from __future__ import annotations

import base64
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from . import common

#: Ids of a sequence, slots of a shard (17 MB), and the key of the order.
LENGTH, PER_SHARD, KEY = 512, 16384, 0x5DEECE66D
_FEISTEL_ROUNDS = 4
_NO_ID = -(1 << 63)


def feistel(number: np.ndarray, count: int, key: int) -> np.ndarray:
    """The slot of each number below count: a permutation of range(count)."""
    half = 1
    while 4 ** half < count:
        half += 1
    low = np.uint64((1 << half) - 1)
    out = number.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> np.uint64(half), out[walk] & low
        for r in range(_FEISTEL_ROUNDS):
            mixed = A.mix(right + np.uint64((key * (2 * r + 1) + r) & 0xFFFFFFFFFFFFFFFF))
            left, right = right, left ^ (mixed & low)
        out[walk] = (left << np.uint64(half)) | right
        walk = walk[out[walk] >= count]
    return out.astype(np.int64)


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), len(ranks)


def record_type(length: int) -> np.dtype:
    return np.dtype([("number", "<i8"), ("doc_id", "<i8"), ("offset", "<i4"), ("n_ids", "<i4"),
                     ("ids", "<u2", (length,)), ("end", "S1")])


def _coded(batches, path: str, pattern: str):
    """For each document of a split: (doc_id, its ids as an array, without the end id)."""
    encoding, _ = _encoding(path, pattern)
    for batch in batches:
        ids = batch.column(0).cast(pa.int64()).fill_null(_NO_ID).to_pylist()
        for i in range(0, batch.num_rows, 64):
            for doc, text in zip(ids[i: i + 64], batch.column(1).slice(i, 64).to_pylist()):
                yield doc, np.array(encoding.encode_ordinary(text or ""), np.uint16)


def _records(arrays: np.ndarray) -> pa.Array:
    kind = arrays.dtype
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(kind.itemsize), len(arrays), [None, pa.py_buffer(arrays.tobytes())]).cast(pa.binary())


def _sequences(docs: DataFrame, path: str, pattern: str, length: int) -> DataFrame:
    """(split, at, record: binary) of every sequence; a record's number is its place in the split."""
    kind = record_type(length)

    def sequence(batches):
        from pyspark import TaskContext

        split = TaskContext.get().partitionId()
        end = np.array([_encoding(path, pattern)[1]], np.uint16)
        # parts of documents that wait for their sequence: ids, document, place of the first id in it
        at, waiting, held = 0, [], 0

        def cut(n):
            nonlocal at, held
            ids = np.concatenate([w[0] for w in waiting])
            starts = np.cumsum([0, *(len(w[0]) for w in waiting)])
            use = min(len(ids), n * length)
            flat = np.full(n * length, end[0], np.uint16)
            flat[:use] = ids[:use]
            begins = length * np.arange(n)
            part = np.searchsorted(starts, begins, "right") - 1
            out = np.zeros(n, kind)
            out["number"] = at + np.arange(n)
            out["doc_id"] = np.array([w[1] for w in waiting])[part]
            out["offset"] = np.array([w[2] for w in waiting])[part] + begins - starts[part]
            out["n_ids"] = np.minimum(length, use - begins)
            out["ids"] = flat.reshape(n, length)
            out["end"] = b"\n"
            at += n
            held = len(ids) - use
            waiting[:] = [(w[0][max(use - s, 0):], w[1], w[2] + max(use - s, 0))
                          for w, s in zip(waiting, starts.tolist()) if s + len(w[0]) > use]
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(n, split, np.int32)), pa.array(out["number"]), _records(out)], names=["split", "at", "record"])

        for doc, coded in _coded(batches, path, pattern):
            waiting += [(coded, doc, 0), (end, doc, len(coded))]
            held += len(coded) + 1
            if held >= 256 * length:
                yield cut(held // length)
        if held:
            yield cut(-(-held // length))

    return docs.select("doc_id", "text").mapInArrow(sequence, "split int, at long, record binary")


def _packed(staged: DataFrame, length: int, per_shard: int, key: int) -> tuple[DataFrame, int]:
    """(shard, block) with the sequences of a batch that go to one shard, numbered and compressed, and N."""
    # one row for each split of the input: as many as tasks, whatever the table's rows
    counts = {r["split"]: r["n"] for r in staged.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    begin, total = np.zeros(max(counts, default=0) + 1, np.int64), 0
    for k in sorted(counts):
        begin[k] = total
        total += counts[k]
    shared = staged.sparkSession.sparkContext.broadcast(begin)
    kind = record_type(length)

    def pack(batches):
        import zstandard

        packer = zstandard.ZstdCompressor()
        for batch in batches:
            if batch.num_rows:
                records = np.frombuffer(b"".join(batch.column(2).to_pylist()), kind).copy()
                records["number"] = shared.value[batch.column(0).to_numpy()] + batch.column(1).to_numpy()
                shard = feistel(records["number"], total, key) // per_shard
                order = np.argsort(shard, kind="stable")
                shards, first = np.unique(shard[order], return_index=True)
                blocks = [packer.compress(part.tobytes()) for part in np.split(records[order], first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int32)), pa.array(blocks, pa.binary())], names=["shard", "block"])

    return staged.select("split", "at", "record").mapInArrow(pack, "shard int, block binary"), total


def _unpacked(blocks: DataFrame, length: int, total: int, key: int) -> DataFrame:
    """(shard, slot, record: binary) of the sequences in blocks."""
    kind = record_type(length)

    def unpack(batches):
        import zstandard

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for shard, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                records = np.frombuffer(opener.decompress(block.as_buffer()), kind)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(records), shard, np.int32)), pa.array(feistel(records["number"], total, key)), _records(records)],
                    names=["shard", "slot", "record"])

    return blocks.mapInArrow(unpack, "shard int, slot long, record binary")


def written(docs: DataFrame, path: str, pattern: str, folder: str, *, length: int = LENGTH,
            per_shard: int = PER_SHARD, key: int = KEY) -> str:
    """Write the shards under ``folder`` (any URI that Spark can write) and return the folder of
    this run: shard k is the file in ``shard=k`` there."""
    blocks, total = _packed(common.stage(_sequences(docs, path, pattern, length), "sequences"), length, per_shard, key)
    place = f"{folder}/order-{uuid.uuid4().hex}"
    met = blocks.repartitionById(max(1, -(-total // per_shard)), F.col("shard"))
    ranged = _unpacked(met, length, total, key).sortWithinPartitions("shard", "slot")
    # the text writer puts a line end, the last byte of a record, behind each
    body = F.substring("record", 1, record_type(length).itemsize - 1).cast("string")
    ranged.select("shard", body.alias("value")).write.partitionBy("shard").text(place)
    return place


def read(spark, place: str, length: int = LENGTH, *, per_shard: int = PER_SHARD, start: int = 0) -> DataFrame:
    """slot, shard, number, doc_id, offset, n_ids and ids (binary, padding included) of every record
    from slot ``start`` on; the shards before it are not opened."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(place)
             .withColumn("shard", F.regexp_extract("path", r"shard=(\d+)/", 1).cast("int")))
    kind = record_type(length)

    def step(batches):
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                first = shard * per_shard
                rows = np.frombuffer(content.as_buffer(), kind)[max(start - first, 0):]
                slots = max(start, first) + np.arange(len(rows))
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * length), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows["ids"]).tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), pa.array([shard] * len(rows), pa.int32()),
                     *(pa.array(np.ascontiguousarray(rows[c])) for c in ("number", "doc_id", "offset", "n_ids")), raw.cast(pa.binary())],
                    names=["slot", "shard", "number", "doc_id", "offset", "n_ids", "ids"])

    return (files.filter(F.col("shard") >= start // per_shard).select("shard", "content")
            .mapInArrow(step, "slot long, shard int, number long, doc_id long, offset int, n_ids int, ids binary"))
