"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (decontaminate, exact_dedup, extend_dedup, importance, line_dedup, near_dedup, ordinal_quality, pieces, pii, run_index,
               token_counts, training_order, vector_codes)
from .common import read_table, shared_folder


def piece_model() -> str:
    """The public merge-type vocabulary; its file is the operator's parameter."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_pii(spark, sf_dir):
    found = pii.marked(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = [F.size(pii.of_kind("base", k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"),
                        pii.joined("spans").alias("spans"))


def op2_sentencepiece(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    coded = pieces.encoded(docs, piece_model(), ids_as="text", keep=["doc_id"])
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_line_dedup(spark, sf_dir):
    found = line_dedup.summary(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.concat_ws(",", F.col("kept").cast("array<string>")), 256).alias("kept_sha256"))


def op4_decontamination(spark, sf_dir):
    found = decontaminate.judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                 keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op5_substring_dedup(spark, sf_dir):
    found = extend_dedup.deduplicated(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_training_order(spark, sf_dir):
    """The shards that were written, read again: one row per slot."""
    import public_tokenizers as P

    place = training_order.written(read_table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN,
                                   f"{shared_folder(spark)}/training-order")
    found = training_order.read(spark, place)
    return found.select("slot", "shard", "number", "doc_id", "offset", "n_ids", F.sha2("ids", 256).alias("ids_sha256"))


def op7_quality_classifier(spark, sf_dir):
    ratings = ordinal_quality.rated(read_table(spark, sf_dir, "labels"))
    return ordinal_quality.judged(read_table(spark, sf_dir, "documents"), ratings, keep=["doc_id"])


def op8_near_dedup(spark, sf_dir):
    return near_dedup.classes(read_table(spark, sf_dir, "documents")).drop("id")


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.classes(read_table(spark, sf_dir, "documents")).drop("chars")


def op10_run_index_dedup(spark, sf_dir):
    found = run_index.deduplicated(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_vector_codes(spark, sf_dir):
    return vector_codes.compressed(read_table(spark, sf_dir, "embeddings"))


def op12_token_counts(spark, sf_dir):
    return token_counts.counted(read_table(spark, sf_dir, "documents"), piece_model(), limit=4096, keep=["doc_id"])


def op13_importance_resampling(spark, sf_dir):
    return importance.resampled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_line_dedup": op3_line_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_training_order": op6_training_order,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_near_dedup": op8_near_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_run_index_dedup": op10_run_index_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_token_counts": op12_token_counts,
    "op13_importance_resampling": op13_importance_resampling,
}

def _vector_codes_sql(rounds: int = 4) -> str:
    """Product quantisation by measuring every part against every entry."""
    nearest = """
             a{r} as materialized (
                select x.r, x.p, arg_min(b.i, (list_inner_product(x.x, x.x) - 2 * list_inner_product(x.x, b.x)
                                               + list_inner_product(b.x, b.x)) * 256 + b.i) as i,
                       min(list_inner_product(x.x, x.x) - 2 * list_inner_product(x.x, b.x) + list_inner_product(b.x, b.x)) as d
                from x join b{r} b on x.p = b.p group by x.r, x.p),"""
    moved = """
             b{n} as materialized (
                select b.p, b.i, coalesce(m.x, b.x) as x from b{r} b left join (
                    select p, i, list(floor(s / n) order by k) as x from (
                        select p, i, k, sum(v) as s, count(*) as n from (
                            select x.p, a.i, unnest(range(1, len(x.x) + 1)) as k, unnest(x.x) as v
                            from x join a{r} a on x.r = a.r and x.p = a.p)
                        group by p, i, k) group by p, i) m on b.p = m.p and b.i = m.i),"""
    passes = "".join(nearest.format(r=r) + moved.format(r=r, n=r + 1) for r in range(rounds)) + nearest.format(r=rounds)
    return f"""
        with v as materialized (
                select vec_id, label, list_transform(embedding, lambda c: cast(floor(1024 * c) as double)) as e,
                       row_number() over (order by vec_id nulls first, embedding) as r
                from embeddings where len(embedding) > 0
                  and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
             x as materialized (
                select r, p, list_slice(e, p * len(e) // 4 + 1, (p + 1) * len(e) // 4) as x
                from (select r, e, unnest(range(4)) as p from v)),
             b0 as materialized (select p, r - 1 as i, x from x where r <= 256),{passes}
             c as materialized (
                select v.vec_id, v.label, a.code, a.error from v join (
                    select r, string_agg(printf('%02x', i), '' order by p) as code, cast(sum(d) as bigint) as error
                    from a{rounds} group by r) a on v.r = a.r)
        select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
               (select sha256(string_agg(cast(cast(c as bigint) as varchar), ',' order by p, i, k))
                from (select p, i, unnest(range(1, len(x) + 1)) as k, unnest(x) as c from b{rounds})) as codebooks_sha256
        from c"""


def _importance_sql() -> str:
    """CRC-32 by half bytes over the hexadecimal spelling of each distinct feature."""
    table = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w"""
    runs = " union all ".join(
        f"""select side, r, array_to_string(list_slice(w, s, s + {n - 1}), ' ') as f
                 from (select side, r, w, unnest(range(1, len(w) - {n - 2})) as s from t)""" for n in (1, 2, 3))
    half = "list_reduce(list_transform(string_split(regexp_replace(hex(encode(f)), '(.)(.)', '\\2\\1', 'g'), ''), " \
           "lambda c: cast(strpos('123456789ABCDEF', c) as bigint)), " \
           f"lambda a, x: xor(a >> 4, {table}[xor(a & 15, x) + 1]), cast(4294967295 as bigint))"
    return rf"""
        with d as materialized (select doc_id, row_number() over () as r, {words} from documents),
             t as materialized (select 0 as side, r, w from d union all
                                select 1, row_number() over (), w from (select {words} from benchmark)),
             f as materialized (select side, r, f, count(*) as n from ({runs}) group by side, r, f),
             c as materialized (select f, xor({half}, 4294967295) % 10000 as b from (select distinct f from f)),
             g as materialized (
                select b, cast(floor(1000 * ln(((t + 1) * (sum(s) over () + 10000)) / ((s + 1) * (sum(t) over () + 10000)))) as bigint) as gain
                from (select b, cast(coalesce(sum(n) filter (side = 0), 0) as double) as s,
                             cast(coalesce(sum(n) filter (side = 1), 0) as double) as t
                      from f join c on f.f = c.f group by b)),
             w as (select r, sum(n) as n, sum(n * gain) as weight
                   from f join c on f.f = c.f join g on c.b = g.b where side = 0 group by r),
             u as (select doc_id, len(w) as words, cast(coalesce(n, 0) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
                          cast('0x' || substr(sha256('42:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) as h
                   from d left join w on d.r = w.r),
             v as (select doc_id, n_features, weight, words,
                          weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from u),
             k as (select *, row_number() over (partition by words >= 20 order by score desc, doc_id nulls first, weight desc, n_features desc) as place,
                          count(*) over (partition by words >= 20) as able from v)
        select doc_id, n_features, weight, score, case when words >= 20 and place <= 5 * able // 100 then place end as rank from k"""


ORACLE_SQL = {
    "op13_importance_resampling": _importance_sql(),
    "op11_vector_codes": _vector_codes_sql(),
    "op4_decontamination": r"""
        with t as (select doc_id, regexp_extract_all(
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
             b as (select item_id, regexp_extract_all(
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
             q as (select distinct item_id, least(10, len(w)) as n,
                          array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') as body
                   from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from b where len(w) > 0)),
             v as (select doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') as body
                   from (select doc_id, w, unnest(range(1, len(w) + 1)) as s from t),
                        (select distinct n from q) where s + n - 1 <= len(w)),
             h as (select doc_id, s, v.n, item_id from v join q on v.n = q.n and v.body = q.body),
             i as (select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
                   from (select distinct doc_id, cast(item_id as varchar) as name from h) group by doc_id),
             p as (select doc_id, count(distinct p) as n_hit
                   from (select doc_id, unnest(range(s, s + n)) as p from h) group by doc_id)
        select t.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
               coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from t left join i on t.doc_id = i.doc_id left join p on t.doc_id = p.doc_id""",
    "op5_substring_dedup": r"""
        with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
             v as (select doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') as body
                   from (select doc_id, w, unnest(range(1, len(w) - 18)) as s from t)),
             g as (select doc_id, s, row_number() over (partition by body order by doc_id, s) > 1 as later from v),
             h as (select distinct doc_id, unnest(range(s, s + 20)) as p from g where later),
             x as (select doc_id, w, unnest(range(1, len(w) + 1)) as p from t),
             k as (select x.doc_id, x.p, x.w[x.p] as word, h.p is not null as gone
                   from x left join h on x.doc_id = h.doc_id and x.p = h.p),
             a as (select doc_id, count(*) filter (gone) as n_removed,
                          coalesce(string_agg(word, ' ' order by p) filter (not gone), '') as body
                   from k group by doc_id)
        select t.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
               sha256(coalesce(body, '')) as kept_sha256
        from t left join a on t.doc_id = a.doc_id""",
    "op9_exact_dedup": r"""
        with t as (select doc_id, length(coalesce(text, '')) as chars,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as body
                   from documents),
             r as (select doc_id, sha256(body) as text_sha256,
                          first_value(doc_id) over w as keep_id,
                          row_number() over w as place,
                          count(*) over (partition by body) as group_size
                   from t window w as (partition by body order by chars desc, doc_id))
        select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from r""",
}
