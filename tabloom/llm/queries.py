"""Queries of the corpus operators with their SQL twins, and the tokenizer files they take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.llm import (alignment, byte_bpe, decontaminate, licenses, line_dedup, near_dup, pii, quality_mil, quality_rules, sharding,
                         token_count, url_filter, vector_codes)
from tabloom.llm.common import in_fit_fold, table

#: Name of the module that knows the tokenizer files; a parameter of the calls below.
BYTE_VOCABULARY, BYTE_JSON, PIECE_MODEL = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_tokenizer() -> tuple[bytes, str]:
    import public_tokenizers

    return byte_bpe.read_ranks(tokenizer(BYTE_VOCABULARY)), public_tokenizers.PATTERN


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_overlaps(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = byte_tokenizer()
    coded = byte_bpe.encode(table(spark, folder, "documents"), ranks, pattern)
    both = byte_bpe.decode(coded, ranks)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


def op4_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.duplicate_classes(table(spark, folder, "documents")).select("doc_id", "class_id")


def op5_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [pii.n_spans(k).alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.joined_spans(pii.BASE).cast("binary"), 256).alias("base_sha256"), pii.joined_spans(pii.KINDS).alias("spans"),
                        sum((pii.n_spans(k) for k in pii.KINDS[1:]), pii.n_spans(pii.KINDS[0])).alias("n_spans"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_mil.fit_quality(docs, table(spark, folder, "labels"))
    return quality_mil.score_quality(docs, model).select("doc_id", (~in_fit_fold(F.col("doc_id"))).alias("held_out"), "score", "predicted")


def op8_token_count(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, tokenizer(PIECE_MODEL)).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return done.select("doc_id", "n_lines", "n_exact", "n_near", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("kept_md5"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = quality_rules.fit_rules(docs, table(spark, folder, "labels"))
    return quality_rules.apply_rules(docs, rules).select("doc_id", *quality_rules.STATS, "base_failed", "kept")


#: Fixed values of the query's contract: (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("bad_share", 6).alias("bad_share"), F.round("bound", 6).alias("bound"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.code_vectors(table(spark, folder, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    aligned = alignment.align_tokens(docs, tokenizer(BYTE_JSON), tokenizer(PIECE_MODEL), digest=True)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_byte_bpe, op3_licenses, op4_near_dup, op5_jump_shards, op6_personal_data,
                                   op7_quality, op8_token_count, op9_line_dedup, op10_quality_rules, op11_url_filter, op12_vector_codes, op13_token_alignment, pipeline)}



def _vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds written out one after another; whole numbers below 2^53 are exact in doubles."""
    near = """n{i} as materialized (select r, j, arg_min(e, dist * {e} + e) as e, min(dist) as dist from (
            select p.r, p.j, c.e, list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x) as dist
            from p join c{i} c using (j)) group by r, j),"""
    move = """c{k} as materialized (select c.j, c.e, coalesce(m.x, c.x) as x from c{i} c left join (
            select j, e, list(floor(total / n) order by i) as x from (
            select j, e, i, sum(v) as total, count(*) as n from (select n.j, n.e, unnest(p.x) as v, generate_subscripts(p.x, 1) as i from n{i} n join p using (r, j)) group by j, e, i)
            group by j, e) m using (j, e)),"""
    steps = "".join(near.format(i=i, e=entries) + (move.format(i=i, k=i + 1) if i < rounds else "") for i in range(rounds + 1))
    return f"""
        with k as (select row_number() over (order by vec_id, embedding) - 1 as r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
                   where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        p as materialized (select r, j, v[j * (len(v) // {parts}) + 1 : (j + 1) * (len(v) // {parts})] as x from k, range({parts}) y(j)),
        c0 as materialized (select j, r as e, x from p where r < {entries}),
        {steps}
        codes as (select r, string_agg(printf('%02x', e), '' order by j) as code, cast(sum(dist) as bigint) as error from n{rounds} group by r),
        by_label as (select label, cast(sum(error) as bigint) as label_error from k join codes using (r) group by label)
        select vec_id, code, error, label_error, (select sha256(string_agg(array_to_string(list_transform(x, lambda v: cast(v as bigint)::varchar), ','), ',' order by j, e)) from c{rounds}) as codebooks_sha256
        from k join codes using (r) join by_label on k.label is not distinct from by_label.label"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op1_decontaminate": f"""
        with d as (select row_number() over () as r, doc_id, coalesce({_WORDS.format('text')}, []) as w from documents),
        i as (select coalesce(cast(item_id as varchar), '') as item_id, coalesce({_WORDS.format('text')}, []) as w from benchmark),
        windows as (select distinct item_id, w[k : least(k + 12, len(w))] as v
                    from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as k from i where len(w) > 0)),
        sizes as (select distinct len(v) as n from windows),
        places as (select r, n, k, w[k : k + n - 1] as v from
                   (select r, w, n, unnest(range(1, len(w) - n + 2)) as k from d, sizes where len(w) >= n)),
        met as (select p.r, p.k, p.n, x.item_id from places p join windows x on p.v = x.v),
        hits as (select r, count(distinct h) as n_hit from (select r, unnest(range(k, k + n)) as h from met) group by r),
        names as (select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
                  from (select distinct r, item_id from met) group by r)
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
        from d left join hits using (r) left join names using (r)""",
    "op4_near_dup": f"""
        with recursive d as (select doc_id, md5(coalesce(text, '')) as t, coalesce({_WORDS.format('text')}, []) as w from documents),
        texts as (select t, min(doc_id) as first_id, any_value(w) as w from d group by t),
        sh as (select distinct t, array_to_string(w[k : k + 4], ' ') as s from (select t, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as k from texts where len(w) > 0)),
        n as (select t, count(*) as c from sh group by t),
        pairs as (select a.t as x, b.t as y, count(*) as m from sh a join sh b on a.s = b.s and a.t < b.t group by a.t, b.t),
        links as (select x, y from pairs join n p on x = p.t join n q on y = q.t where m >= 0.8 * (p.c + q.c - m)),
        both_ways as (select x, y from links union select y, x from links),
        reach as (select t as x, t as y from texts union select r.x, b.y from reach r join both_ways b on r.y = b.x),
        named as (select r.x as t, min(first_id) as class_id from reach r join texts on texts.t = r.y group by r.x)
        select doc_id, class_id from d join named using (t)""",
    "op9_line_dedup": r"""
        with d as (select doc_id, text, md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as r, string_split(coalesce(text, ''), chr(10)) as ls from documents),
        l as (select doc_id, r, k - 1 as k, trim(ls[k], ' ') as line from (select distinct doc_id, r, ls, unnest(range(1, len(ls) + 1)) as k from d)),
        o as (select *, row_number() over (order by doc_id, r, k) as place from l where regexp_matches(line, '[^\x20\x09-\x0D]')),
        firsts as (select line, min(place) as place from o group by line),
        near as (select a.line, min(b.place) as place from firsts a join firsts b on length(b.line) between length(a.line) - 1 and length(a.line) + 1
                 and length(a.line) >= 20 and length(b.line) >= 20 and a.line <> b.line and levenshtein(a.line, b.line) = 1 group by a.line),
        judged as (select o.r, o.k, o.place > f.place as exact, o.place <= f.place and n.place < o.place as near
                   from o join firsts f using (line) left join near n using (line)),
        taken as (select r, count(*) filter (exact) as n_exact, count(*) filter (near) as n_near, list(k) filter (exact or near) as gone from judged group by r)
        select doc_id, cast(case when text is null then 0 else len(ls) end as bigint) as n_lines, coalesce(n_exact, 0) as n_exact, coalesce(n_near, 0) as n_near,
               md5(case when coalesce(len(gone), 0) = 0 then coalesce(text, '')
                   else coalesce(array_to_string(list_transform(list_filter(range(0, len(ls)), lambda i: not list_contains(gone, i)), lambda i: ls[i + 1]), chr(10)), '') end) as kept_md5
        from d left join taken using (r)""",
    "op11_url_filter": r"""
        with recursive rules(verdict, rh, rp) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        u as (select row_number() over () as r, page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                     coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
        met as (select r, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(verdict, length(rh || rp)) as verdict from u, rules
                where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by r),
        named as (select distinct host, regexp_replace(regexp_replace(host, '^.*@', ''), '\.?(:[0-9]*)?$', '') as site from u),
        places as (select host, case when regexp_matches(site, '(^|\.)[0-9]+$') then site else regexp_extract(site, '([^.]*\.)?[^.]*$') end as domain from named),
        h as (select *, case when regexp_matches(domain, '(^|\.)[0-9]+$') or not contains(domain, '.') then '' else regexp_replace(domain, '^[^.]*\.', '') end as suffix from places),
        seen as (select suffix, domain, host, count(*)::double as n, (count(*) filter (verdict = 'block'))::double as bad from u join met using (r) join h using (host) group by all),
        root as (select (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) as base from seen),
        sx as (select suffix, sum(n) as n, sum(bad) as bad from seen group by suffix), dx as (select suffix, domain, sum(n) as n, sum(bad) as bad from seen group by all),
        levels as (select 0 as l, '' as parent, n, bad from sx union all select 1, suffix, n, bad from dx union all select 2, domain, n, bad from seen),
        by_parent as (select l, parent, count(*) as k, sum(n) as nn, sum(bad) as bb, sum(n * n) as n2, sum(bad * bad / n) as q from levels group by all),
        s as (select l, sum(k) as k, count(*) as p, sum(nn) as n, sum(bb) as bad, sum(n2 / nn) as sizes, sum(q) as q, sum(bb * bb / nn) as parents from by_parent group by l),
        t as (select l, k, p, n, (q - parents) / nullif(k - p, 0) as btw, (bad - q) / nullif(n - k, 0) as ins, (n - sizes) / nullif(k - p, 0) as sz from s),
        w as (select *, btw + (sz - 1) * ins as whole from t),
        m as (select i as l, case when n is null or k <= p or n <= k or whole <= 0 then 10.0 when (btw - ins) / whole <= 0 then 10000.0
                     else least(10000.0, greatest(1.0, 1 / ((btw - ins) / whole) - 1)) end as m from range(3) x(i) left join w on w.l = i),
        known as (select h.host, coalesce(seen.n, 0) as n, coalesce(seen.bad, 0) as bad, coalesce(dx.n, 0) as nd, coalesce(dx.bad, 0) as bd, coalesce(sx.n, 0) as ns, coalesce(sx.bad, 0) as bs
                  from h left join seen using (host) left join dx on dx.domain = h.domain left join sx on sx.suffix = h.suffix),
        prior as (select known.*, m2.m as m2, (bd - bad + m1.m * ((bs - bd + m0.m * base) / (ns - nd + m0.m))) / (nd - n + m1.m) as q
                  from known, root, m m0, m m1, m m2 where m0.l = 0 and m1.l = 1 and m2.l = 2),
        post as (select host, bad + m2 * q as a, n - bad + m2 * (1 - q) as b from prior),
        judged as (select host, a / (a + b) as mean, greatest(0.0, a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1))) as bound from post)
        select page_id, host, path, rule, coalesce(verdict, case when bound > 0.5 then 'block' else 'allow' end) as verdict,
               round(mean, 6) as bad_share, round(bound, 6) as bound
        from u left join met using (r) join judged using (host)""",
    "op12_vector_codes": _vector_codes_sql(),
}
