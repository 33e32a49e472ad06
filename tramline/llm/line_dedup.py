"""Line dedup by an exact set-similarity join.

A line's tokens are its different words (A-Z lowered, ``[^\\x20\\x09-\\x0D]+``). Lines with equal
sets are one class, represented by its first line (smallest doc_id, then line). Classes with
a Jaccard similarity of 0.8 or more match, and a line goes if it matches an earlier one,
judged on the input: so the first line of each class stays unless an earlier class
matches it. Blank lines have no tokens and stay.

Tokens are ordered by rarity: a table of ``SLOTS`` counts over all tokens, by hash, gives each
a frequency step (a bounded table, whatever the vocabulary; any fixed order is exact, rarity
makes it fast). Two sets can only match if they share one of the first
n - ceil(0.8 n) + 1 tokens, at positions that leave enough tokens behind (prefix and
positional filter), if their sizes are near (length filter), and if 64-bit outlines of the
sets differ in few bits. An outline holds for each bit whether an odd number of tokens falls on
it, so a token that only one set has changes one bit, and large sets do not fill it; two sets of
more than 64 tokens are held against 128 bits. What passes is confirmed on the sets.

Under one token every class is tried with the earliest class there; only those that differ
from it meet the others, so many variants of one line give as many pairs as variants, not
their square. Nothing is capped: a class whose earliest partner is not confirmed meets
all others under the tokens where only that one was tried.

All of it is DataFrame functions; nothing runs in Python on the executors.

Defined results: a null or empty text is one blank line; a document of any length is one
row, its lines are spread; rows that repeat a doc_id, and null ids, are documents of their
own (``common.keyed``), the later ones lose their lines.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Counts that order tokens by rarity.
SLOTS = 1 << 18
#: Sets of more tokens have an outline of two words of 64 bits, others of one.
WIDE = 64
_ENTRY = ("id", "line", "n", "outline", "more", "pos")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACES = "\t\x0b\x0c\r"  # besides the blank; no line holds the newline


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _worded(line: Column) -> Column:
    """Whether a line has tokens; the pattern is only tried on those that do not begin with one."""
    return (line >= "!") | ~line.rlike(r"^[\x20\x09-\x0D]*$")


def _words(line: Column) -> Column:
    """The words of a line, A-Z lowered; lines of ASCII without other spaces than blanks, most of them, the short way
    (``lower`` knows other letters too)."""
    plain = F.octet_length(line) == F.char_length(line)
    for space in _SPACES:
        plain = plain & ~F.contains(line, F.lit(space))
    other = F.translate(line, _UPPER + _SPACES, _UPPER.lower() + " " * len(_SPACES))
    return F.array_remove(F.split(F.when(plain, F.lower(line)).otherwise(other), " "), "")


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.posexplode(lines_of(F.col("text"))).alias("line", "body"))


def _slot(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def _counts(docs: DataFrame) -> DataFrame:
    """(slot, n): how many tokens fall on each slot that has any."""
    words = _lines(docs).select(F.explode(_words(F.col("body"))).alias("word"))
    return words.groupBy(_slot(F.xxhash64("word")).alias("slot")).agg(F.count(F.lit(1)).alias("n"))


def _rarity(docs: DataFrame) -> Column:
    """An array: for each slot a step that grows with the count of its tokens, in what a byte holds."""
    steps = ["-128"] * SLOTS
    for slot, n in _counts(docs).collect():  # at most SLOTS rows, whatever the table's size
        steps[slot] = str(min(250, 1 + int(6 * math.log2(n))) - 128)
    return F.split(F.lit(",".join(steps)), ",").cast("array<bigint>")


def _codes(words: Column, steps: Column) -> Column:
    """A line's tokens as different numbers, sorted, the rarest first: step, then hash."""
    hashes = F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))
    # never null, said to Spark: so it sorts them as plain numbers
    return F.sort_array(F.transform(hashes, lambda h: F.shiftleft(
        F.coalesce(F.get(steps, _slot(h)), F.lit(0).cast("long")), 56).bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1)))))


def _parity(codes: Column) -> Column:
    """64 bits: whether an odd number of the codes falls on each."""
    return F.aggregate(codes, F.lit(0).cast("long"), lambda bits, c: bits.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), c.bitwiseAND(F.lit(63)).cast("int"))))


def _classes(docs: DataFrame) -> DataFrame:
    """(id, line, n, outline, more, prefix): one row per class, by its first line; more: the outline's second word."""
    steps = _rarity(docs)
    sets = _lines(docs).select("id", "line", _codes(_words(F.col("body")), steps).alias("codes"))
    n, codes = F.size("codes"), F.col("codes")
    second = F.when(n > WIDE, _parity(F.filter(codes, lambda c: c.bitwiseAND(F.lit(64)) != 0))).otherwise(F.lit(0).cast("long"))
    shaped = sets.select(
        "id", "line", F.xxhash64(codes).alias("key1"), F.xxhash64(F.lit(1), codes).alias("key2"), n.alias("n"),
        _parity(codes).alias("folded"), second.alias("more"),
        F.slice(codes, F.lit(1), n - F.expr("cast((4 * size(codes) + 4) div 5 as int)") + 1).alias("prefix"))
    first = shaped.groupBy("key1", "key2").agg(F.min(F.struct(
        "id", "line", "n", F.col("folded").bitwiseXOR(F.col("more")).alias("outline"), "more", "prefix")).alias("f"))
    return common.stage(first.select("f.*").filter("n > 0"), "classes")


def _enough(inter: Column, a: Column, b: Column) -> Column:
    """Jaccard similarity of 0.8 or more."""
    return 9 * inter >= 4 * (a + b)


def _near(differ: Column, a: Column, b: Column) -> Column:
    """Few enough tokens that one of the sets lacks for a similarity of 0.8: a ninth of both sizes."""
    return 9 * differ <= a + b


def _may(x: str, y: str) -> Column:
    """Outline, length and positional filters for two entries under one token."""
    nx, ny = F.col(f"{x}_n"), F.col(f"{y}_n")
    one, two = (F.col(f"{x}_{o}").bitwiseXOR(F.col(f"{y}_{o}")) for o in ("outline", "more"))
    return (_near(F.bit_count(one.bitwiseXOR(two)), nx, ny)  # folded: the outline of one word
            & ((F.least(nx, ny) <= WIDE) | _near(F.bit_count(one) + F.bit_count(two), nx, ny))
            & _enough(F.least(nx - F.col(f"{x}_pos"), ny - F.col(f"{y}_pos")), nx, ny))


def _before(x: str, y: str) -> Column:
    return (F.col(f"{x}_id") < F.col(f"{y}_id")) | ((F.col(f"{x}_id") == F.col(f"{y}_id")) & (F.col(f"{x}_line") < F.col(f"{y}_line")))


def _place(x: str) -> Column:
    return F.struct(F.col(f"{x}_id").alias("id"), F.col(f"{x}_line").alias("line"))


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (x, y), places of lines, whose sets match."""
    places = common.stage(pairs.select("x.*").union(pairs.select("y.*")).distinct().withColumnsRenamed(
        {"id": "__id", "line": "__line"}), "places")
    wanted = common.sized(places, places.count(), 40)
    ids = wanted.select("__id").distinct()
    some = docs.join(ids, F.col("id") == F.col("__id"), "left_semi")
    sets = _lines(some).join(wanted, (F.col("id") == F.col("__id")) & (F.col("line") == F.col("__line")), "left_semi").select(
        F.struct("id", "line").alias("place"), F.array_distinct(F.transform(_words(F.col("body")), lambda w: F.xxhash64(w))).alias("words"))
    sets = common.stage(sets, "sets")
    both = (pairs.join(sets.select(F.col("place").alias("x"), F.col("words").alias("of_x")), "x")
            .join(sets.select(F.col("place").alias("y"), F.col("words").alias("of_y")), "y"))
    return both.filter(_enough(F.size(F.array_intersect("of_x", "of_y")), F.size("of_x"), F.size("of_y"))).select("x", "y")


def matched(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, line) of the classes that match an earlier one."""
    classes = classes.filter("n >= 4")  # smaller sets match equal ones only

    def by_token(name, some=classes):  # never null, said to Spark: else each use gets null filters, and a shuffle, of its own
        entries = some.select("id", "line", "n", "outline", "more", F.posexplode("prefix").alias("pos", "token"))
        return entries.select(F.coalesce("token", F.lit(0)).alias("token"), *(
            F.coalesce(c, F.lit(0)).alias(f"{name}_{c}") for c in _ENTRY))

    earliest = Window.partitionBy("token").orderBy("y_id", "y_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # column by column: a struct of them would be made, and shuffled, beside them
    first = by_token("y").select("*", *(F.first(f"y_{c}").over(earliest).alias(f"x_{c}") for c in _ENTRY))
    later = first.filter(_before("x", "y")).withColumn("star", _may("x", "y"))

    def met(rows, others):
        pairs = rows.select("token", *(f"y_{c}" for c in _ENTRY)).join(others, "token")
        return pairs.filter(_may("z", "y") & _before("z", "y")).select(_place("z").alias("x"), _place("y").alias("y"))

    # one plan, so the entries are shuffled by token once for both kinds of pairs; stars: tokens under which only x was tried
    tried = common.stage(
        later.filter("star").select(_place("x").alias("x"), _place("y").alias("y"), "token")
        .union(met(later.filter("not star"), by_token("z")).withColumn("token", F.lit(None).cast("long")))
        .groupBy("x", "y").agg(F.collect_list("token").alias("stars")), "pairs")
    pairs = tried.select("x", "y")
    found = common.stage(_confirmed(pairs, docs).select("y").distinct(), "matched")
    # those whose earliest partner only seemed to match, and that no other one has matched; under their other tokens they met all
    again = common.stage(tried.select("y", F.explode("stars").alias("token")).join(found, "y", "left_anti")
                         .select("token", F.col("y.id").alias("id"), F.col("y.line").alias("line")).distinct(), "again")
    n = again.count()
    if n:
        few = common.sized(again, n, 40)
        some = classes.join(common.sized(again.select("id", "line").distinct(), n, 32), ["id", "line"], "left_semi")
        rows = common.stage(by_token("y", some).join(few.withColumnsRenamed({"id": "y_id", "line": "y_line"}), ["token", "y_id", "y_line"], "left_semi"), "rows")
        tokens = common.stage(rows.groupBy("token").agg(
            F.max("y_id").alias("last"), F.min("y_n").alias("least"), F.max("y_n").alias("most")), "tokens")
        # before they are shuffled: those that any row of their token may meet, by place and size
        others = by_token("z").alias("z").join(
            common.sized(tokens, tokens.count(), 40).alias("t"),
            (F.col("z.token") == F.col("t.token")) & (F.col("z_id") <= F.col("last"))
            & (5 * F.col("z_n") >= 4 * F.col("least")) & (4 * F.col("z_n") <= 5 * F.col("most")), "left_semi")
        more = common.stage(met(rows, others).distinct().join(pairs, ["x", "y"], "left_anti"), "more")
        found = common.stage(found.union(_confirmed(more, docs).select("y")).distinct(), "matched")
    return found.select("y.id", "y.line")


def kept_lines(docs: DataFrame) -> DataFrame:
    """(id, kept: sorted numbers of the lines with tokens that stay); ``docs`` as ``common.keyed`` gives them."""
    classes = _classes(docs)
    gone = matched(classes, docs)
    stay = classes.select("id", "line").join(gone, ["id", "line"], "left_anti")
    return stay.groupBy("id").agg(F.sort_array(F.collect_list("line")).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept (numbers of the lines with tokens that stay) and text (all
    lines that stay) of every document."""
    keyed, _ = common.keyed(docs)
    found = kept_lines(keyed)
    joined = keyed.join(found, "id", "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<int>")))
    lines = lines_of(F.col("text"))
    worded = F.size(F.filter(lines, _worded))
    text = F.array_join(F.filter(lines, lambda s, i: ~_worded(s) | F.array_contains("kept", i)), "\n")
    return joined.select("doc_id", F.size(lines).cast("long").alias("n_lines"),
                         (worded - F.size("kept")).cast("long").alias("n_removed"), "kept", text.alias("text"))


def summary(docs: DataFrame) -> DataFrame:
    """``deduplicated`` without texts: the documents' texts are only counted, not moved."""
    keyed, _ = common.keyed(docs)
    found = kept_lines(keyed)
    lines = lines_of(F.col("text"))
    worded = F.size(F.filter(lines, _worded))
    counted = keyed.select("id", "doc_id", F.size(lines).cast("long").alias("n_lines"), worded.alias("worded"))
    return counted.join(found, "id", "left").select(
        "doc_id", "n_lines", (F.col("worded") - F.coalesce(F.size("kept"), F.lit(0))).cast("long").alias("n_removed"),
        F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))
