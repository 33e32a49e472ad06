"""Each operator against its plain version, on tables with nulls, blank, tied, repeated, very long
and no rows at all, and extra columns named as the operators' own."""

import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F

import brute
from conftest_llm import bag, docs, frame, rows  # noqa: F401
from tramline.llm import (arrays, common, decontaminate, exact_dedup, extend_dedup, line_dedup, near_dedup, ordinal_quality, pieces, pii, run_index,
                          seeds, training_order)

MODEL = P.path("piece_bpe_32k.model")
BENCH = "item_id long, text string"


def test_pii(docs, rows):
    found = pii.marked(docs, keep=["doc_id", "text"]).collect()
    assert len(found) == len(rows)
    for r in found:
        want = brute.pii(r.text or "")
        assert [tuple(s) for s in r.base] == want
        assert set(want) <= {tuple(s) for s in r.spans}
        order = [(pii.TYPES.index(s.kind), s.start, s.end) for s in r.spans]
        assert order == sorted(order)


def test_pii_base_patterns_on_noise():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choices("abZ.@@-+%_ 0123456789..  ()é4", k=rng.randint(0, 50)))
        assert pii.base_spans(text) == brute.pii(text), text


def test_pii_field_learns_spans_that_the_patterns_miss(spark):
    rng = random.Random(4)
    texts = [f"call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} or write ab{i}.{rng.randint(1, 99)}@mail{i % 7}.example.com now" for i in range(120)]
    train = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    field = pii.trained(train)
    text = "please call (626) 555-1660 or write xy.12 (at) mail3.example.com now"
    assert pii.base_spans(text) == []
    found = {(k, text[s:e]) for k, s, e in pii.all_spans(text, [], field)}
    assert ("phone", "626) 555-1660") in found or ("phone", "(626) 555-1660") in found
    assert any(k == "email" for k, _ in found)
    assert pii.all_spans("nothing to see at all here", [], field) == []


def test_pii_field_reads_texts_without_digits_and_at_signs(spark):
    rng = random.Random(4)
    name = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 8)))
    texts = [f"please write to {name()}.{name()}@{name()}.example.com about it" for _ in range(120)]
    body = "please write to {}.{} (at) {}.example.com about it"
    masked = [body.format(name(), name(), name()) for _ in range(20)]
    rows = [*enumerate(texts), *enumerate(masked, 1000)]
    found = {r.doc_id: r for r in pii.marked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in enumerate(masked):
        assert not found[1000 + i].base
        assert any(s.kind == "email" and s.start <= text.index("(at)") < s.end for s in found[1000 + i].spans), text


def test_pii_dynamic_programme_is_the_best_segmentation():
    rng = np.random.default_rng(5)
    field = pii.Field(rng.normal(size=(len(pii.TYPES), pii._SLOTS)), rng.normal(size=(len(pii.TYPES),) * 2))
    text = "a 1 b2 @c 4"
    tokens = [m.span() for m in pii._TOKEN.finditer(text)]
    pot = field.potentials(text, tokens)

    def every(i, before):
        if i == len(tokens):
            yield 0.0, ()
            return
        for (a, j), (_, score) in pot.items():
            if a == i:
                for y in range(len(pii.TYPES)):
                    if np.isfinite(score[y]):
                        for s, rest in every(j, y):
                            yield s + score[y] + field.follows[before, y], ((i, j, y), *rest)

    assert list(max(every(0, 0))[1]) == field.best(text, tokens)


def test_sentencepiece(docs, rows):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = pieces.encoded(docs, MODEL).collect()
    assert "n" in found[0].asDict() if found else not rows
    want = [(d, lib.encode(t or "")) for d, t in rows]
    assert bag((r.doc_id, r.ids, r.decoded, r.n_tokens) for r in found) == bag((d, i, lib.decode(i), len(i)) for d, i in want)
    as_text = pieces.encoded(docs, MODEL, ids_as="text", keep=["doc_id"]).collect()
    assert bag((r.doc_id, r.ids) for r in as_text) == bag((d, ",".join(map(str, i))) for d, i in want)


def test_sentencepiece_on_noise():
    model, rng = pieces.PieceModel(MODEL), random.Random(6)
    alphabet = [*"abcdethéèß \n\t  ▁.,!AB12\x00​😀漢字", "  ", "\r\n", "<s>", "</s>", "<0x41>", " "]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(2000)] + ["a" * 3000, " " * 500, "▁", " x", "x "]
    got = model.texts(texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids == ",".join(map(str, model.library.encode(text))), text
    flat = [list(map(int, g.split(","))) if g else [] for g in got]
    ends = np.concatenate([[0], np.cumsum([len(f) for f in flat])])
    decoded = model.decode(np.array([i for f in flat for i in f], np.int32), ends).to_pylist()
    assert decoded == [model.library.decode(f) for f in flat]


def test_line_dedup(docs, rows):
    want = brute.lines(rows)
    found = line_dedup.deduplicated(docs).collect()
    assert bag((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in found) == bag(want)
    short = line_dedup.summary(docs).collect()
    assert bag((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in short) == bag(want)
    for r in found:
        assert sum(bool(x.strip(" \t\n\v\f\r")) for x in r.text.split("\n")) == len(r.kept)


def test_line_dedup_partner_that_is_not_the_earliest(spark):
    words = [f"w{i}" for i in range(20)]
    early, other = words[:12] + [f"e{i}" for i in range(8)], words
    rows = [(1, " ".join(early)), (2, " ".join(other)), (3, " ".join([*other[:-1], "z"])), (4, "x"), (5, "x")]
    found = line_dedup.summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in found) == bag(brute.lines(rows))
    assert {r.doc_id for r in found if r.n_removed} == {3, 5}


def test_line_dedup_tries_again_only_under_tokens_of_a_star(spark, monkeypatch):
    """Of a line whose earliest partner is not confirmed, tokens under which it met all others are not tried again."""
    staged, stage = {}, common.stage

    def kept(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(common, "stage", kept)
    words = [f"w{i}" for i in range(20)]
    # under all tokens of 2 and 3 that 1 has, 1 is a star whose outline passes; under the others they meet each other
    monkeypatch.setattr(line_dedup, "_near", lambda differ, a, b: F.lit(True))
    early = words[:12] + [f"e{i}" for i in range(8)]
    rows = [(1, " ".join(early)), (2, " ".join(words)), (3, " ".join([*words[:-1], "z"])), (4, " ".join([*words[:9], *"abcdefghijk"]))]
    rows += [(5, " ".join(["p", "q", "r", "s", "w18"])), (6, " ".join(["p", "q", "r", "s", "w19"]))]
    found = line_dedup.summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in found) == bag(brute.lines(rows))
    lines = {(r.y_id, r.y_line) for r in staged["rows"].collect()}
    prefixes = {(r.id, r.line): len(r.prefix) for r in staged["classes"].collect()}
    assert lines and staged["rows"].count() < sum(prefixes[p] for p in lines)


def test_line_dedup_runs_no_python_on_the_executors(spark, monkeypatch):
    plans, stage = {}, common.stage

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(common, "stage", seen)
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[1:], "z"]) + "\n\t\x0b"), (3, "\tÉa B\x0cc d É\rx\n b Éa c D x É"),
            (4, "b éa c d x é"), (5, "\x0b\x0c\r"), (6, None), (7, "A\u0085b\nA\u0085B"), (8, " !\n!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.localCheckpoint()
    found = line_dedup.summary(docs)
    assert {"classes", "pairs"} <= set(plans)
    for name, plan in plans.items():
        assert not re.search("Python|Pandas|Arrow", plan), name
    for last in (found, line_dedup._counts(common.keyed(docs)[0])):
        assert not re.search("Python|Pandas|Arrow", last._jdf.queryExecution().executedPlan().toString())
    assert bag((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in found.collect()) == bag(brute.lines(rows))


def test_line_dedup_long_lines_with_a_word_in_common_are_no_pairs(spark, monkeypatch):
    """Outlines that many words fill let every pair of long lines meet on their sets."""
    tried, confirmed = [], line_dedup._confirmed

    def counted(pairs, docs):
        tried.append(pairs.count())
        return confirmed(pairs, docs)

    monkeypatch.setattr(line_dedup, "_confirmed", counted)
    rng = random.Random(5)
    line = [rng.sample([f"w{j}" for j in range(300)], 150) for _ in range(12)]
    rows = [(i, " ".join(["shared", *words])) for i, words in enumerate(line)]
    rows += [(12, " ".join(["shared", *line[5][:-1], "z"])), (13, " ".join(["shared", *line[7], "z"]))]
    found = line_dedup.summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in found) == bag(brute.lines(rows))
    assert {r.doc_id for r in found if r.n_removed} == {12, 13}
    assert sum(tried) <= 4, tried


def _items(rows):
    long = [t for _, t in rows if t and len(t.split()) > 40]
    return ([(1, " ".join(long[0].split()[5:25])), (10, long[1]), (2, long[1].upper()), (None, " ".join(long[2].split()[:11]))] if long else []) + [
        (3, None), (4, "..."), (5, "one two"), (5, "nothing like it in any of the texts of this little table"), (6, "x" * 30)]


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_decontamination(spark, docs, rows, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = _items(rows)
    bench = spark.createDataFrame(items, BENCH)
    want = brute.decontamination(rows, items)
    found = decontaminate.judged(docs, bench, keep=["doc_id"]).collect()
    assert bag((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found) == bag(want)
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert bag(r.doc_id for r in clean.collect()) == bag(w[0] for w in want if not w[4])


def test_decontamination_without_benchmark(spark, docs, rows):
    found = decontaminate.judged(docs, spark.createDataFrame([], BENCH)).collect()
    assert len(found) == len(rows) and not any(r.contaminated or r["items"] for r in found)


def test_decontamination_with_a_long_and_a_one_word_item(spark):
    rng = random.Random(13)
    words = [f"w{rng.randrange(3000)}" for _ in range(50_000)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "zebra")], BENCH)
    rows = [(1, " ".join(words[100:160])), (2, "a zebra here"), (3, " ".join(words)), (4, " ".join(words[:9]) + " x"), (5, "w1 " * 30),
            (6, "z " + " ".join(words[-12:]) + " " + " ".join(words[:10]))]
    found = {r.doc_id: r for r in decontaminate.judged(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert {d: (r.n_hit, r["items"]) for d, r in found.items()} == {
        1: (60, ["1"]), 2: (1, ["2"]), 3: (50_000, ["1"]), 4: (0, []), 5: (0, []), 6: (22, ["1"])}
    queries = decontaminate.Queries([("1", " ".join(words)), ("2", "zebra")], 10)
    assert sum(v.nbytes for v in vars(queries).values() if isinstance(v, np.ndarray)) < 64 * len(words)


def test_longest_matches(spark):
    rows = [(1, "a b c d e f g h i j k l m"), (2, "x d e f g h i j k l m n o p"), (3, None)]
    bench = spark.createDataFrame([(9, "c d e f g h i j k l m n o")], BENCH)
    found = {r.start: (r.n_words, r.doc_id, r.doc_start) for r in decontaminate.longest_matches(
        spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert found == {0: (11, 1, 2), 1: (12, 2, 1), 2: (11, 2, 2), 3: (10, 2, 3)}


def test_substring_dedup(docs, rows):
    found = extend_dedup.deduplicated(docs).collect()
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == bag(brute.substrings(rows))


def test_substring_dedup_in_small_steps(docs, rows, monkeypatch):
    monkeypatch.setattr(seeds, "HELD", 50)
    found = extend_dedup.deduplicated(docs, window=9, gram=3).collect()
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == bag(brute.substrings(rows, 9))


@pytest.mark.parametrize("window", [200, 40])
def test_run_index_dedup(docs, rows, window):
    found = run_index.deduplicated(docs, window=window, gram=16).collect()
    assert bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == bag(_places(rows, window))


def _places(rows, window):
    return brute.repeats(rows, window)


def test_run_index_dedup_with_a_crowd(spark, monkeypatch):
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdefgh ", k=260))
    rows = [(i, "".join(rng.choices("abcdefgh ", k=rng.randint(0, 120))) + passage + "".join(rng.choices("abcdefgh ", k=rng.randint(0, 120))))
            for i in range(60)]
    want = bag(brute.repeats(rows, 60))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for crowd in (4, 512):
        monkeypatch.setattr(run_index, "CROWD", crowd)
        found = run_index.deduplicated(table, window=60, gram=16).collect()
        assert bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == want


def test_run_index_dedup_divides_a_hot_anchor(spark, monkeypatch):
    """5,000 different stretches of one anchor: rows grow with the stretches, not with their windows."""
    rng = random.Random(18)
    passage = "".join(rng.choices("abcdefgh ", k=80))
    rows = [(i, "".join(rng.choices("abcdefgh ", k=40)) + passage[rng.choice((0, 0, 3, 9)):] + "".join(rng.choices("abcdefgh ", k=30)))
            for i in range(5000)]
    made, asked, stage = [], [], common.stage

    def counted(df, name):
        staged = stage(df, name)
        if name == "halves":
            made.append(staged.filter("not covered").count())
        if name == "asked-texts":
            asked.extend(staged.selectExpr("inline(asked)").filter(f"stretches > {run_index.CROWD}").selectExpr("count(1)", "sum(n)").first())
        return staged

    monkeypatch.setattr(common, "stage", counted)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = run_index.deduplicated(table, window=60, gram=16).collect()
    assert bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == bag(brute.repeats(rows, 60))
    stretches, windows = asked
    assert stretches >= 5000 and 1 <= len(made) <= 6 and made[0] <= 2 * stretches, (made, asked)
    assert sum(made) < windows / 2, (made, asked)


def test_halves_cover_each_window_once():
    rng = random.Random(19)
    window, gram = 30, 6
    data = np.frombuffer("".join(rng.choices("ab", k=4000)).encode(), np.uint8)
    offsets, start, n, core = [0], [], [], []
    for _ in range(60):
        count = rng.randint(1, window - gram + 1)
        start.append(rng.randrange(1000))
        n.append(count)
        core.append(rng.randint(count - 1, window - gram))
        offsets.append(offsets[-1] + count + window - 1)
    parts = [np.array(x, np.int64) for x in (offsets[:-1], start, n, core)]
    length = gram
    while length < window:
        of, key1, _, first, begin, count, place = run_index.halves(data, parts[0], parts[1], parts[2], parts[3], length, window)
        length += (window - length + 1) // 2
        assert sum(count) == sum(n) and (place >= count - 1).all() and (place + length <= window).all()
        same = {}
        for k, f, p in zip(key1.tolist(), first.tolist(), place.tolist(), strict=True):
            assert same.setdefault(k, data[f + p: f + p + length].tobytes()) == data[f + p: f + p + length].tobytes()
        parts = [first, begin, count, place]
    assert set(parts[2].tolist()) == {1}


def test_matching_statistics():
    rng = random.Random(9)
    for _ in range(60):
        texts = ["".join(rng.choices("ab", k=rng.randint(0, 25))).encode() for _ in range(rng.randint(1, 6))]
        ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = run_index.matching_statistics(np.frombuffer(b"".join(texts), np.uint8), ends)
        places = [(k, i) for k, t in enumerate(texts) for i in range(len(t))]

        def common_length(a, b):
            x, y = texts[a[0]][a[1]:], texts[b[0]][b[1]:]
            return next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))

        assert got.tolist() == [max((common_length(p, q) for q in places if q != p), default=0) for p in places]


def test_training_order(spark, docs, rows):
    place = training_order.written(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, f"{common.shared_folder(spark)}/order", length=16, per_shard=8)
    found = training_order.read(spark, place, 16, per_shard=8).collect()
    encoding, end = training_order._encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    n = len(found)
    assert sorted(r.number for r in found) == sorted(r.slot for r in found) == list(range(n))
    assert all(r.slot == brute.feistel(r.number, n, training_order.KEY) and r.shard == r.slot // 8 for r in found)
    sizes = [len(list(g)) for _, g in itertools.groupby(sorted(r.shard for r in found))]
    assert all(size == 8 for size in sizes[:-1])
    later = training_order.read(spark, place, 16, per_shard=8, start=n // 2 + 3).collect()
    assert bag(later) == bag(r for r in found if r.slot >= n // 2 + 3)
    got = [i for r in sorted(found, key=lambda r: r.number) for i in np.frombuffer(r.ids, "<u2")[: r.n_ids].tolist()]
    documents, held = [], []
    for i in got:
        held.append(i)
        if i == end:
            documents.append(held)
            held = []
    assert not held
    whole = [(training_order._NO_ID if d is None else d, [*encoding.encode_ordinary(t or ""), end]) for d, t in rows]
    assert bag(documents) == bag(ids for _, ids in whole)
    for r in found:  # a record begins in the document and at the place that it says
        begin = np.frombuffer(r.ids, "<u2")[: r.n_ids].tolist()
        own = [ids[r.offset:] for d, ids in whole if d == r.doc_id]
        assert any(o and o[: len(begin)] == begin[: len(o)] for o in own)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(count):
    slots = training_order.feistel(np.arange(count), count, 12345)
    assert sorted(slots.tolist()) == list(range(count))
    if count >= 1000:
        assert slots.tolist() != list(range(count)) and slots.tolist() != training_order.feistel(np.arange(count), count, 54321).tolist()


def _ratings(spark, n):
    rng = random.Random(10)
    texts, ratings = [], []
    for i in range(n):
        grade = rng.choice([0, 1, 2, 2])
        words = [rng.choice(["lora", "mipo", "kest", "dune", "vall", "brio"]) for _ in range(rng.randint(20, 60))]
        if grade == 0:
            words[rng.randrange(len(words))] = "vile"
            words[rng.randrange(len(words))] = "nasty"
        if grade == 1:
            words = [w.upper() + "!!" for w in words]
        texts.append((i, " ".join(words)))
        ratings.append((i, grade))
    return spark.createDataFrame(texts, "doc_id long, text string"), ratings


def test_quality_classifier_on_held_out_rows(spark):
    texts, ratings = _ratings(spark, 900)
    train = spark.createDataFrame(ratings[:500], "doc_id long, grade int")
    found = {r.doc_id: r for r in ordinal_quality.judged(texts, train).collect()}
    held = ratings[500:]
    assert np.mean([found[i].selected == (g == 2) for i, g in held]) > 0.97
    means = [np.mean([found[i].expected_grade for i, g in held if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]


def test_quality_fit_holds_few_arrays_of_all_features(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(ordinal_quality, "_STEPS", 2)
    rng, rows, each = np.random.default_rng(3), 4000, 500
    slots, values = rng.integers(0, 1 << ordinal_quality.BITS, rows * each), rng.random(rows * each)
    first, grades = np.arange(rows + 1) * each, rng.integers(0, 3, rows)
    tracemalloc.start()
    ordinal_quality.fit(slots, values, first, grades)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 * len(slots)  # besides the arrays given: the values that count and two of a step


def test_quality_classifier_on_odd_tables(spark, docs, rows):
    labels = spark.createDataFrame([(d, i % 2, i % 5 == 0) for i, (d, _) in enumerate(rows) if i % 2] + [(None, 1, True), (1, None, True)],
                                   "doc_id long, quality int, toxic boolean").withColumn("toxic", F.col("toxic").cast("int"))
    found = ordinal_quality.judged(docs, ordinal_quality.rated(labels))
    assert found.count() == len(rows)
    assert ordinal_quality.selected(docs, ordinal_quality.rated(labels)).columns == docs.columns
    none = ordinal_quality.selected(docs, ordinal_quality.rated(labels.limit(0)))
    assert none.count() == len(rows)


def test_near_dedup(docs, rows):
    found = near_dedup.classes(docs).collect()
    want = brute.near(rows)
    assert bag((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == bag(want)
    stay = near_dedup.deduplicated(docs)
    assert stay.columns == docs.columns
    assert bag(r.doc_id for r in stay.collect()) == bag(w[0] for w in want if w[3])


def test_near_dedup_links_that_miss_the_centre(spark):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    found = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == bag(brute.near(rows))


def test_components(spark):
    rng = random.Random(12)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(50)]
    pairs = [(min(p), max(p)) for p in pairs if p[0] != p[1]]
    label = {x: x for p in pairs for x in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    found = near_dedup.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.id: r.label for r in found} == label


def test_exact_dedup(docs, rows):
    want = brute.exact(rows)
    found = exact_dedup.classes(docs).collect()
    assert bag((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) == bag(want)
    stay = exact_dedup.deduplicated(docs)
    assert stay.columns == docs.columns
    assert bag(r.doc_id for r in stay.collect()) == bag(w[0] for w in want if w[3])


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_exact_dedup_with_and_without_broadcast(spark, limit, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILTER_BYTES", limit)
    rows = [(i, f"text {i % 700}") for i in range(900)]
    found = exact_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) == bag(brute.exact(rows))


def test_native_operator_runs_no_python(docs):
    plan = exact_dedup.classes(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_results_without_broadcasts(docs, rows, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    found = extend_dedup.deduplicated(docs).collect()
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == bag(brute.substrings(rows))
    near = near_dedup.classes(docs).collect()
    assert bag((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near) == bag(brute.near(rows))


def test_word_hashes_tell_words_apart():
    data = np.frombuffer("ab ba ab é b a aab".encode(), np.uint8)
    words = arrays.Words(data, np.array([0, len(data)]), arrays.SPACED_WORD)
    hashes = words.hashes(data)
    spelled = [bytes(data[s:e]) for s, e in zip(words.start, words.end)]
    assert len(set(hashes.tolist())) == len(set(spelled)) and hashes[0] == hashes[2]
    assert hashlib.sha256 and frame


def test_exact_dedup_gives_back_columns_named_as_its_own(spark):
    names = ["__at", "__text", "__id", "__chars", "__sha", "__stays", "__n"]
    rows = [(1, "a b", -5), (2, "ab", -6), (3, "c", -7), (3, "c", -7)]
    table = spark.createDataFrame([(d, t, *[x] * len(names)) for d, t, x in rows], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    found = exact_dedup.deduplicated(table)
    assert found.columns == table.columns
    assert bag(tuple(r) for r in found.collect()) == bag([(1, "a b", *[-5] * len(names)), (3, "c", *[-7] * len(names))])
