"""Target-distribution importance resampling on hashed n-grams, in Arrow kernels.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased
(``ascii_lower``, ``split_pattern_regex``, ``list_flatten``); features are all runs of one
to ``LONGEST`` consecutive words joined by a space, repeats counted, each in the bucket of
its CRC. Inside a task the words of some 512 KB of text are dictionary-encoded; the indices, shifted by
one word and paired with those before, are dictionary-encoded again, so that every distinct
run of words is hashed once: its CRC is that of the shorter run carried over the bytes that
follow (one table lookup per byte of the CRC for each length, made by rule). The buckets of the distinct runs
are taken back to their places.

Two passes read the texts. The first counts features by bucket for raw and target texts (at
most ``buckets`` rows per task, summed before and after one small shuffle; the driver holds
the counts of the buckets). The second takes every feature's gain and sums it by document.
Scores are sorted by range, and a rank is the place in its range after the sizes of the
ranges before it (one number each), so no task sees all rows.

Defined results: a null or empty text, or one without words, has no features and weight 0.
Texts of any length are read whole, one per step if need be. Equal scores are drawn by doc_id
(null first, and as the empty text in the noise's hash), then by weight and n_features; rows
equal in all of these are alike in the result but for their ranks. Repeated rows are documents of their own.
An empty target or no documents give gains of what is there (a bucket without counts on
either side has the ratio of the totals); no documents give no rows. Only doc_id and text
are read; other columns, however named, do not matter.
"""

from __future__ import annotations

import zlib
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sized, stage
from .slices import by_bytes, sums_by_row

#: Between words: every ASCII character that is no digit and no letter (texts are lower-cased first).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, LONGEST = 10_000, 3
#: Bytes up to which a CRC is carried by table; longer words are read byte by byte.
CARRIED = 48
#: Bytes of text that a step takes: its dictionaries stay in a core's cache.
STEP_BYTES = 512 << 10
#: The reflected polynomial of CRC-32 (a fixed value).
_POLYNOMIAL = 0xEDB88320


@cache
def _byte_table() -> np.ndarray:
    """What a CRC's low byte becomes when it is carried over one byte."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, byte >> 1 ^ np.uint32(_POLYNOMIAL), byte >> 1)
    return byte


@cache
def _carry_table() -> np.ndarray:
    """Table [n, k, v]: a CRC whose byte k is v (others 0), carried over n zero bytes."""
    out = np.empty((CARRIED + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(CARRIED):
        out[n + 1] = _byte_table()[out[n] & 0xFF] ^ (out[n] >> 8)
    return out


class Words:
    """The distinct words of a step, with the CRC of each at the start of a run and after a space."""

    def __init__(self, words: pa.StringArray):
        self.words = words
        _, ends, data = words.buffers()
        ends = np.frombuffer(ends, np.int32)[:len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
        data = np.frombuffer(data or b"", np.uint8)
        self.size = np.diff(ends)
        self.long = self.size > CARRIED
        state = np.full(len(words), 0xFFFFFFFF, np.uint32)
        left = np.flatnonzero(~self.long)
        for i in range(CARRIED):
            left = left[self.size[left] > i]
            state[left] = _byte_table()[(state[left] ^ data[ends[left] + i]) & 0xFF] ^ (state[left] >> 8)
        self.first = ~state
        for i in np.flatnonzero(self.long):
            self.first[i] = zlib.crc32(self.bytes(i))
        space = np.full(len(words), zlib.crc32(b" "), np.uint32)
        self.later = self._prolonged(space, np.arange(len(words)), self.first, 0, b"")

    def bytes(self, i: int) -> bytes:
        return self.words[int(i)].as_py().encode()

    def _prolonged(self, crc: np.ndarray, word: np.ndarray, own: np.ndarray, more: int, between: bytes) -> np.ndarray:
        """CRCs of runs prolonged by ``between``, of ``more`` bytes, and a word, whose own CRC is ``own``: the run's,
        carried over as many zero bytes, and the other, bit by bit."""
        table, size = _carry_table(), np.minimum(self.size[word] + more, CARRIED)
        out = own.copy()
        for k in range(4):
            out ^= table[size, k, crc >> np.uint32(8 * k) & np.uint32(0xFF)]
        for i in np.flatnonzero(self.size[word] + more > CARRIED):
            out[i] = zlib.crc32(between + self.bytes(word[i]), int(crc[i]))
        return out

    def appended(self, crc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """CRCs of runs, followed by a space and a word each."""
        return self._prolonged(crc, word, self.later[word], 1, b" ")


def features(texts: pa.StringArray, buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text as ends (one more than texts), and for runs of 1, 2, ... words
    (place of the run's last word, bucket) of every run."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    ends = parts.offsets.to_numpy().astype(np.int64)
    words = pc.list_flatten(parts)
    full = pc.not_equal(words, "")
    ends = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[ends - ends[0]]
    coded = words.filter(full).dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    known = Words(coded.dictionary)
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    at, run, crc = np.arange(len(code)), code, known.first
    out = [(at, (crc % buckets)[run].astype(np.int64))]
    for _ in range(longest - 1):
        # runs that the next word of the same text prolongs: the pair (run, word) is encoded again
        go = np.flatnonzero(at + 1 < len(code))
        go = go[row[at[go]] == row[at[go] + 1]]
        at = at[go] + 1
        pairs = pa.array(run[go] * len(known.size) + code[at]).dictionary_encode()
        run_of, word = np.divmod(pairs.dictionary.to_numpy(), max(1, len(known.size)))
        crc = known.appended(crc[run_of], word)
        run = pairs.indices.to_numpy().astype(np.int64)
        out.append((at, (crc % buckets)[run].astype(np.int64)))
    return ends, out


def _texts(frame: DataFrame, *keep: str) -> DataFrame:
    return frame.select(*keep, F.coalesce("text", F.lit("")).alias("__text"))


def bucket_counts(frame: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket."""

    def step(batches):
        n = np.zeros(buckets, np.int64)
        for part in by_bytes(batches, "__text", STEP_BYTES):
            for _, bucket in features(part.column(0).cast(pa.string()), buckets)[1]:
                n += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], names=["bucket", "n"])

    found = _texts(frame).mapInArrow(step, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in target and raw, rounded down."""
    above = (target + 1.0) * (raw.sum() + float(len(raw)))
    below = (raw + 1.0) * (target.sum() + float(len(target)))
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every text."""

    def step(batches):
        for part in by_bytes(batches, "__text", STEP_BYTES):
            ends, runs = features(part.column(1).cast(pa.string()), len(gain))
            value, size = np.zeros(ends[-1], np.int64), np.zeros(ends[-1], np.int64)
            for at, bucket in runs:
                value[at] += gain[bucket]
                size[at] += 1
            columns = np.diff(ends), sums_by_row(size, ends), sums_by_row(value, ends)
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, columns)], names=["doc_id", "n_words", "n_features", "weight"])

    longs = [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]
    return _texts(docs, "doc_id").mapInArrow(step, T.StructType([docs.schema["doc_id"], *longs]))


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a standard Gumbel number, rounded down, that the seed and the id decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """``scored`` with rank: 1, 2, 3, ... down the scores of the texts of at least ``least_words`` words,
    for ``percent`` in a hundred of them (rounded down), else null."""
    able = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("weight").desc(), F.col("n_features").desc()]
    # the id numbers the rows of each range (upper bits) in order (lower bits); staged, so that it is fixed
    placed = stage(scored.filter(able).orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "ordered")
    split = F.shiftright("place", 33)
    sizes = sorted((r.split, r.n) for r in placed.groupBy(split.alias("split")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = list(accumulate((n for _, n in sizes), initial=0))
    drawn = before[-1] * percent // 100
    # one number per range, up to the one where the draw ends
    table = scored.sparkSession.createDataFrame([(s, b) for (s, _), b in zip(sizes, before) if b < drawn], "of long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    with_rank = (placed.join(sized(table, len(sizes), 16), split == F.col("of"), "left")
                 .withColumn("rank", F.when(rank <= drawn, rank)).drop("place", "of", "before"))
    return with_rank.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, *, seed: int = 42, least_words: int = 20, percent: int = 5, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document: those ranked are drawn without
    replacement in proportion to their importance for the target texts (Gumbel top-k)."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = stage(weighed(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    return ranked(scored, least_words, percent).select("doc_id", "n_features", "weight", "score", "rank")
