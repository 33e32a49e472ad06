"""Token counts: a map-side lookup in two tiers, without a shuffle of pre-tokens.

A text is cut into pre-tokens where no piece of the vocabulary reaches across: before
every run of spaces and before every line end. The ids of a text are those of its
pre-tokens end to end, so its token count is the sum of theirs.

Tier one is a table of frequent pre-tokens and their lengths in tokens. Spark's top-k
sketch reads every whole text (map-side, one sketch per task, merged in two steps; no
pre-token is ever shuffled), the driver encodes the at most ``FREQUENT`` entries and
broadcasts them as two Arrow arrays: at most ``FREQUENT`` times ``WIDTH`` bytes and the
lengths. Tier two is a table in each Python worker: a pre-token that tier one lacks is
encoded by the sentencepiece library when the worker first meets it, and remembered until
some ``REMEMBERED`` others, and as many again, have come after it. The tables decide how often the library is asked, never a result.

Inside a task every step is an Arrow kernel over some 4 MB of text: line ends
are marked, the texts split, the pre-tokens dictionary-encoded, and only the distinct ones
looked up; their lengths are taken back to the places and summed by text. The first text
of every step is also encoded whole by the library, and a different count raises.

Defined results: a null or empty text has 0 bytes and 0 tokens. A text of any length is
counted whole; pre-tokens of over ``LONG`` bytes are encoded each time and not remembered.
Rows are independent: repeated rows and null or tied ids come back as often as they came.
No rows give no rows. Columns of the caller's that are not in ``keep`` go; one that is kept
and named n_bytes, n_tokens or over_limit is refused.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .slices import by_bytes, sums_by_row

SPACE = "▁"
#: Entries of the broadcast table, and bytes of one at most.
FREQUENT, WIDTH = 16_384, 32
#: Pre-tokens that a task's sketch tracks.
TRACKED = 2 * FREQUENT
#: Entries from which a worker's own table begins anew (the one before it is kept), and bytes of one entry.
REMEMBERED, LONG = 300_000, 256


class Lengths:
    """Lengths of pre-tokens by one model: the broadcast table, then the worker's own, then the library."""

    def __init__(self, path: str, frequent: tuple[pa.StringArray, np.ndarray] | None = None):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any(SPACE in n.lstrip(SPACE) for n in names):
            raise ValueError("a piece holds a space after another character: texts cannot be cut at spaces")
        if any("\n" in n for n in names):
            raise ValueError("a piece holds a line end: texts cannot be cut at line ends")
        nothing = (pa.array([], pa.string()), np.zeros(0, np.int64))
        #: (pre-tokens, lengths): the broadcast ones, then the worker's own in two generations
        self.frequent, self.own, self.older = nothing if frequent is None else frequent, nothing, nothing

    def encoded(self, keys: list[str]) -> list[int]:
        """Lengths by the library. A key lacks the space symbol in front, which the library adds; before a
        line end none belongs there."""
        ids = self.library.encode([k.replace(SPACE, " ") for k in keys], num_threads=1)
        return [1 if not k else len(i) - (k[0] == "\n") for k, i in zip(keys, ids, strict=True)]

    def of(self, keys: pa.StringArray) -> np.ndarray:
        """Lengths of distinct keys: each table is asked for what the ones before it lack."""
        out = np.zeros(len(keys), np.int64)
        rest = np.arange(len(keys))
        for names, lengths in (self.frequent, self.own, self.older):
            at = pc.index_in(keys, value_set=names)
            known = at.is_valid().to_numpy(zero_copy_only=False)
            out[rest[known]] = lengths[at.drop_null().to_numpy()]
            keys, rest = keys.filter(pa.array(~known)), rest[~known]
        if len(rest):
            out[rest] = self.encoded(keys.to_pylist())
            short = pc.less_equal(pc.binary_length(keys), LONG)
            if len(self.own[0]) > REMEMBERED:
                self.own, self.older = (keys.slice(0, 0), out[:0]), self.own
            self.own = (pa.concat_arrays([self.own[0], keys.filter(short)]),
                        np.concatenate([self.own[1], out[rest[short.to_numpy(zero_copy_only=False)]]]))
        return out

    def counts(self, texts: pa.StringArray) -> np.ndarray:
        """Tokens of each text, none of them null."""
        spaced = pc.binary_join_element_wise(" ", pc.replace_substring(texts, SPACE, " "), "")
        runs = pc.match_substring(spaced, "  ")
        if pc.any(runs).as_py():
            # of a run of spaces the first stays one, so that a run is cut once; the others go with what follows
            several = pc.replace_substring(spaced.filter(runs), " ", SPACE)
            several = pc.replace_substring_regex(several, f"{SPACE}({SPACE}*)", r" \1")
            spaced = pc.replace_with_mask(spaced, runs, several)
        spaced = pc.if_else(pc.equal(texts, ""), "", pc.replace_substring(spaced, "\n", " \n"))
        parts = pc.split_pattern(spaced, " ")
        ends = parts.offsets.to_numpy().astype(np.int64)
        ends -= ends[0]
        coded = pc.list_flatten(parts).dictionary_encode()
        size = self.of(coded.dictionary)[coded.indices.to_numpy()]
        size[ends[:-1]] = 0  # what stands before the first space: nothing
        return sums_by_row(size, ends)


@lru_cache(maxsize=4)
def _lengths(path: str) -> Lengths:
    """One per Python worker; its own table outlives a task."""
    return Lengths(path)


def frequent(docs: DataFrame, k: int = FREQUENT, tracked: int = TRACKED) -> list[str]:
    """Frequent pre-tokens of all whole texts, at most ``k``, each of 1 to ``WIDTH`` bytes.

    One sketch of bounded size per task; sketches are merged in groups, as many as the square root of the
    shuffle partitions, then those of the groups in one."""
    words = docs.select(F.explode(F.split("text", " ")).alias("w")).filter(F.octet_length("w").between(1, WIDTH))
    groups = round(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5)
    merged = (words.groupBy((F.spark_partition_id() % groups).alias("g"))
              .agg(F.expr(f"approx_top_k_accumulate(w, {tracked})").alias("sketch"))
              # by a key, if only one: a task without sketches then merges none, which Spark cannot
              .groupBy((F.col("g") >= 0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
              .select(F.expr(f"approx_top_k_estimate(sketch, {k})").alias("top")))
    return [x.item for r in merged.collect() for x in r.top if "\n" not in x.item]


def counted(docs: DataFrame, model_path: str, *, limit: int, keep: list[str]) -> DataFrame:
    """``keep`` columns of docs, then n_bytes, n_tokens and over_limit (more than ``limit`` tokens)."""
    own = ("n_bytes", "n_tokens", "over_limit")
    if clash := set(own) & set(keep):
        raise ValueError(f"these columns cannot be kept: {sorted(clash)}")
    names = frequent(docs)
    table = docs.sparkSession.sparkContext.broadcast(
        (pa.array(names, pa.string()), np.array(Lengths(model_path).encoded(names), np.int64)))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    text = "__text"
    source = docs.select(*keep, F.coalesce("text", F.lit("")).alias(text))

    def step(batches):
        known = _lengths(model_path)
        known.frequent = table.value
        for part in by_bytes(batches, text):
            texts = part.column(len(keep)).cast(pa.string())
            n = known.counts(texts)
            if n[0] != len(known.library.encode(texts[0].as_py())):
                raise ValueError(f"token count {n[0]} differs from the library's for a text of {len(texts[0].as_py())} characters")
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), size, pa.array(n)], names=[*keep, *own[:2]])

    out = source.mapInArrow(step, schema)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
