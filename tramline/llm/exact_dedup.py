"""Exact dedup by two-pass Bloom filtering (DataFrame functions only).

Pass 1 counts, for every text hash, the rows that set each of its filter slots and
keeps one bit per slot that more than one row has set: a Bloom filter of hashes that
may be repeated, held as 4 KB bitmap segments. Pass 2 tests every row against it. A
row with a clear bit is alone and passes straight through; only the others shuffle,
into groups of equal texts.

Defined results: a null text counts as empty, so null and blank texts form one group.
Of rows that tie in length and doc_id (repeated rows) exactly one stays. A null doc_id
sorts before every number. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Bits of the filter per row, as in a Bloom filter with two hash functions: about 2 % of the
#: rows that are alone still shuffle.
BITS_PER_ROW = 16
#: The filter is broadcast up to this size; beyond it, rows (44 bytes each, without their
#: texts) meet its segments in a shuffle.
FILTER_BYTES = 64 << 20
_SEGMENT_BITS = 32768  # what bitmap_construct_agg holds


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _slot(digest: str, k: int, slots: int) -> Column:
    return F.pmod(F.xxhash64(F.col(digest), F.lit(k)), F.lit(slots))


def _segments(keys: DataFrame, slots: int) -> DataFrame:
    """(segment, bits): the slots that more than one row sets."""
    each = keys.select(F.explode(F.array_distinct(
        F.array(_slot("digest", 0, slots), _slot("digest", 1, slots)))).alias("slot"))
    twice = each.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.groupBy(F.expr("bitmap_bucket_number(slot)").alias("segment")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))


def _bit(bits: Column, slot: Column) -> Column:
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")), F.lit(0)) == 1


def text_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, chars, digest, row): one narrow row per document, staged once."""
    return common.stage(docs.select(
        F.col("doc_id"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"),
        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row")), "text-keys")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 (and chars) for every row of ``docs``.

    Texts are equal when identical after deleting white space; the longest original text,
    then the smallest doc_id stays.
    """
    keys = text_keys(docs)
    total = keys.count()
    slots = _SEGMENT_BITS
    while slots < BITS_PER_ROW * total:
        slots *= 2
    segments = common.stage(_segments(keys, slots), "filter")
    if slots // 8 <= FILTER_BYTES:
        segments = F.broadcast(segments)
    tested = keys
    for k in (0, 1):
        slot = _slot("digest", k, slots)
        own = segments.select(F.col("segment").alias(f"segment{k}"), F.col("bits").alias(f"bits{k}"))
        tested = (tested.join(own, F.bitmap_bucket_number(slot) == F.col(f"segment{k}"), "left")
                  .withColumn(f"hit{k}", _bit(F.col(f"bits{k}"), slot))
                  .drop(f"segment{k}", f"bits{k}"))
    tested = common.stage(
        tested.select("doc_id", "chars", "digest", "row", (F.col("hit0") & F.col("hit1")).alias("maybe")),
        "tested")
    alone = tested.filter("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest", "chars")
    maybe = tested.filter("maybe")
    best = common.stage(
        maybe.groupBy("digest").agg(
            F.min(F.struct((-F.col("chars")).alias("less"), "doc_id", "row")).alias("first"),
            F.count(F.lit(1)).alias("group_size")), "best")
    met = (maybe.join(best, "digest")
           .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                   (F.col("row") == F.col("first.row")).alias("kept"), "digest", "chars"))
    return (alone.unionByName(met)
            .withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row is found again by doc_id, length and text digest; of rows that repeat all three
    one stays. Columns of the caller's come back as they were, also those named as one that is used here.
    """
    docs, theirs = common.shielded(docs, ("__at", "__text", "__id", "__chars", "__sha", "__stays", "__n"))
    found = common.stage(classes(docs).select(
        F.col("doc_id").alias("__id"), F.col("chars").alias("__chars"),
        F.col("text_sha256").alias("__sha"), "kept"), "classes")
    gone = common.stage(
        found.groupBy("__id", "__chars", "__sha").agg(
            F.max("kept").alias("__stays"), F.count(F.lit(1)).alias("__n"))
        .filter("not __stays or __n > 1"), "gone")
    gone = common.sized(gone, gone.count(), 128)
    keyed = docs.withColumns({
        "__at": F.coalesce(F.length("text"), F.lit(0)).cast("long"),
        "__text": F.sha2(normalised(F.col("text")), 256)})
    on = (common.same(keyed["doc_id"], gone["__id"]) & (keyed["__at"] == gone["__chars"])
          & (keyed["__text"] == gone["__sha"]))
    marked = keyed.join(gone, on, "left")
    plain = marked.filter("__stays is null").select(*docs.columns)
    twins = marked.filter("__stays").dropDuplicates(["doc_id", "__at", "__text"]).select(*docs.columns)
    return plain.unionByName(twins).withColumnsRenamed(theirs)
