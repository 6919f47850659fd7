"""Column functions on the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tabloom.catalog.registry import query
from tabloom.functions import scalar as S
from tabloom.operators import frame as R


@query("fn_decode", """SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN 1 WHEN nullif(o_orderstatus, 'P') IS NULL THEN 2 ELSE 0 END AS code FROM orders""")
def _(t):
    status = F.nullif("o_orderstatus", F.lit("P"))
    return t.orders.select("o_orderkey", S.decode(status, "F", 1, None, 2, default=0).alias("code"))


@query("fn_nvl_subquery", """SELECT s_suppkey, coalesce(nullif(s_nationkey, 3), (SELECT avg(nullif(s_nationkey, 3)) FROM supplier)) AS nation FROM supplier""")
def _(t):
    t.supplier.selectExpr("s_suppkey", "nullif(s_nationkey, 3) AS nation").createOrReplaceTempView("supplier_nation")
    return t.spark.sql("""SELECT s_suppkey, nvl(cast(nation AS double), (SELECT avg(nation) FROM supplier_nation)) AS nation
        FROM supplier_nation""")


@query("fn_isin_token", "SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('1-URGENT', '5-LOW') THEN o_orderpriority END AS p FROM orders")
def _(t):
    return t.orders.select("o_orderkey", S.null_tokens("o_orderpriority", ["1-URGENT", "5-LOW"]).alias("p"))


@query("fn_fill_default", "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'S') AS status FROM orders")
def _(t):
    made = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return made.na.fill("S", ["status"])


@query("fn_round", "SELECT p_partkey, round_even(p_size / 4.0, 0) AS even, round(p_retailprice / 7, 3) AS three FROM part")
def _(t):
    return t.part.select("p_partkey", F.bround(F.col("p_size") / 4.0).alias("even"),
                         F.round(F.col("p_retailprice") / 7, 3).alias("three"))


@query("fn_str_slice", "SELECT doc_id, substr(text, 3, 8) AS part FROM documents")
def _(t):
    return t.documents.select("doc_id", S.str_slice("text", 2, 10).alias("part"))


@query("fn_str_split", "SELECT doc_id, string_split(text, ' ') AS words FROM documents")
def _(t):
    return t.documents.select("doc_id", F.split("text", " ").alias("words"))


@query("fn_str_strip", r"SELECT doc_id, trim(chr(10) || ' ' || text || chr(9), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text FROM documents")
def _(t):
    return t.documents.select("doc_id", S.strip(F.concat(F.lit("\n "), "text", F.lit("\t"))).alias("text"))


@query("fn_prefix_strip", "SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#1') THEN substr(p_brand, 8) END AS rest FROM part")
def _(t):
    return t.part.select("p_partkey", S.after_prefix("p_brand", "Brand#1").alias("rest"))


@query("fn_upper_set", "SELECT DISTINCT upper(p_type) AS value FROM part")
def _(t):
    return t.part.select(F.upper("p_type").alias("value")).distinct()


@query("fn_basename", r"SELECT page_id, regexp_extract(url, '([^/\\]*)$', 1) AS name FROM pages")
def _(t):
    return t.pages.select("page_id", S.basename("url").alias("name"))


# resolution by link kind, like the library: absolute, protocol, root, query, fragment, relative
_URL_JOIN = r"""WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) AS href FROM pages)
SELECT page_id, href, CASE WHEN href = '' THEN url WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
 WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-z]+:)', 1) || href
 WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href
 WHEN starts_with(href, '?') THEN regexp_replace(url, '[?#].*$', '') || href
 WHEN starts_with(href, '#') THEN regexp_replace(url, '#.*$', '') || href
 WHEN regexp_replace(url, '[?#].*$', '') = regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/' || href
 ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || href END AS full_url FROM l"""


@query("fn_url_join", _URL_JOIN)
def _(t):
    from tabloom.sources.dumps import extract_links

    links = extract_links(t.pages.select("page_id", "html")).join(t.pages.select("page_id", "url"), "page_id")
    return links.select("page_id", "href", S.url_join(F.col("url"), "href").alias("full_url"))


@query("fn_regex_extract", r"""SELECT doc_id, regexp_extract_all(text, '([A-Z][a-z]+)\.', 1) AS words FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.regexp_extract_all("text", F.lit(r"([A-Z][a-z]+)\."), F.lit(1)).alias("words"))


@query("fn_hms", """SELECT event_id, format('{}:{:02d}:{:05.2f}', (event_id * 37 // 3600)::BIGINT, ((event_id * 37 % 3600) // 60)::BIGINT, (event_id * 37 % 60)::DOUBLE) AS hms FROM events""")
def _(t):
    return t.events.select("event_id", S.hms(F.col("event_id") * 37).alias("hms"))


@query("fn_bytes", """WITH s AS (SELECT doc_id, n_chars, (n_chars * 1000)::DOUBLE AS b FROM documents)
SELECT doc_id, CASE WHEN b >= 1073741824 THEN format('{:.2f}GB', b / 1073741824) WHEN b >= 1048576 THEN format('{:.2f}MB', b / 1048576)
 WHEN b >= 1024 THEN format('{:.2f}KB', b / 1024) ELSE format('{:.2f}B', b) END AS size FROM s""")
def _(t):
    return t.documents.select("doc_id", S.human_size(F.col("n_chars") * 1000).alias("size"))


@query("fn_sha1", "SELECT doc_id, sha1(text) AS sha1 FROM documents")
def _(t):
    return t.documents.select("doc_id", F.sha1("text").alias("sha1"))


@query("fn_math", """SELECT p_partkey, round(ln(p_size), 9) AS ln, round(sqrt(p_size), 9) AS root, pow(p_size, 2.0) AS square,
round(exp(p_size / 50.0::DOUBLE), 9) AS exp, abs(p_size - 25) AS gap FROM part""")
def _(t):
    s = F.col("p_size")
    return t.part.select("p_partkey", F.round(F.log(s), 9).alias("ln"), F.round(F.sqrt(s), 9).alias("root"),
                         F.pow(s, 2.0).alias("square"), F.round(F.exp(s / 50.0), 9).alias("exp"),
                         F.abs(s - 25).alias("gap"))


@query("fn_sigmoid", """SELECT event_id, round(1 / (1 + exp(-value / 100)), 9) AS s, round(1 / (1 + exp(-value / 100)) * (1 - 1 / (1 + exp(-value / 100))), 9) AS slope FROM events""")
def _(t):
    x = F.col("value") / 100
    return t.events.select("event_id", F.round(S.sigmoid(x), 9).alias("s"), F.round(S.sigmoid_prime(x), 9).alias("slope"))


@query("fn_elliot", "SELECT event_id, (value - 50) / (1 + abs(value - 50)) AS e FROM events")
def _(t):
    return t.events.select("event_id", S.elliot(F.col("value") - 50).alias("e"))


@query("fn_note", """WITH n AS (SELECT DISTINCT p_size, 69 + 12 * log2(p_size * 20 / 440.0::DOUBLE) AS n FROM part)
SELECT p_size, round(n, 9) AS number, (['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'])[(round_even(n, 0)::INT % 12) + 1] || trunc(round_even(n, 0) / 12 - 1)::INT AS note FROM n""")
def _(t):
    f = F.col("p_size") * 20
    return t.part.select("p_size").distinct().select(
        "p_size", F.round(S.note_number(f), 9).alias("number"), S.note_name(S.note_number(f)).alias("note"))


@query("fn_clip", "SELECT l_orderkey, l_linenumber, greatest(5.0::DOUBLE, least(40.0::DOUBLE, l_quantity)) AS q FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", S.clip("l_quantity", 5.0, 40.0).alias("q"))


@query("fn_json_get", "SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events")
def _(t):
    from tabloom.sources.tables import parse_json

    return parse_json(t.events, "props", "k long", "p").select("event_id", "p.k")


@query("fn_json_make", """SELECT n_nationkey, '{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS json FROM nation""")
def _(t):
    return t.nation.select("n_nationkey", F.to_json(F.struct("n_name", "n_regionkey")).alias("json"))


@query("fn_map", """SELECT event_id, coalesce((props ->> '$.missing')::BIGINT, -1) AS missing, (props ->> '$.k') IS NOT NULL AS has_k,
json_keys(props) AS keys, [(props ->> '$.k')::BIGINT] AS vals FROM events""")
def _(t):
    m = t.events.withColumn("m", F.from_json("props", "map<string,bigint>"))
    return m.select("event_id", F.coalesce(F.try_element_at("m", F.lit("missing")), F.lit(-1)).cast("long").alias("missing"),
                    F.map_contains_key("m", "k").alias("has_k"), F.map_keys("m").alias("keys"), F.map_values("m").alias("vals"))


@query("fn_array", """WITH e AS (SELECT vec_id, unnest(embedding) AS value, generate_subscripts(embedding, 1) - 1 AS pos, len(list_distinct(embedding)) AS distinct_values, embedding[3] AS third FROM embeddings)
SELECT vec_id, pos::INT AS pos, value, third, distinct_values::INT AS distinct_values FROM e""")
def _(t):
    return t.embeddings.select("vec_id", F.element_at("embedding", 3).alias("third"),
                               F.size(F.array_distinct("embedding")).alias("distinct_values"),
                               F.posexplode("embedding").alias("pos", "value"))


@query("fn_format_number", "SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price FROM orders")
def _(t):
    return t.orders.select("o_orderkey", S.thousands("o_totalprice", 2).alias("price"))


@query("concat_dt", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def _(t):
    from tabloom.sources.tables import combine_ts

    text = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("d"), F.date_format("ts", "HH:mm:ss").alias("h"))
    return text.select("event_id", combine_ts(F.col("d"), F.col("h")).alias("at"))


@query("cast_numeric_ts", "SELECT event_id, ts FROM events")
def _(t):
    from tabloom.sources.tables import cast_ts

    return t.events.select("event_id", F.col("ts").cast("string").alias("ts")).withColumn("ts", cast_ts("ts"))


@query("cast_ts_coerce", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS date FROM orders")
def _(t):
    from tabloom.sources.tables import cast_ts

    text = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "0/0/0000").otherwise(
        F.col("o_orderdate").cast("string")).alias("date"))
    return text.withColumn("date", cast_ts("date", coerce=True))


@query("udf_row", "SELECT p_partkey, round_even(p_size / 2.205, 0) AS kg FROM part")
def _(t):
    @F.pandas_udf("double")
    def to_kg(s: pd.Series) -> pd.Series:
        return (s / 2.205).round()

    return R.with_expr(t.part, "kg", to_kg("p_size")).select("p_partkey", "kg")


@query("udf_agg", "SELECT l_returnflag, count(*) AS n, round(avg(l_extendedprice), 6) AS mean, round(stddev_pop(l_extendedprice), 6) AS own FROM lineitem GROUP BY 1")
def _(t):
    """A caller's aggregate: count, mean and squares around the mean per Arrow batch in Python, merged by Spark, so that a
    hot group is never gathered and large values do not cancel."""
    def partial(batches):
        for b in batches:
            g = b.groupby("l_returnflag", dropna=False)["l_extendedprice"]
            yield pd.DataFrame({"n": g.count(), "m": g.mean(), "q": g.var(ddof=0) * g.count()}).reset_index()

    parts = t.lineitem.select("l_returnflag", "l_extendedprice").mapInPandas(partial, "l_returnflag string, n long, m double, q double")
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"))

    def merge(a, p):
        n, d = a["n"] + p["n"], p["m"] - a["m"]
        share = F.when(n > 0, p["n"] / n).otherwise(0.0)
        return F.struct(n.alias("n"), (a["m"] + d * share).alias("m"), (a["q"] + p["q"] + d * d * a["n"] * share).alias("q"))

    # one row per batch and group: gathered in runs, so that no list grows with the table
    runs = parts.groupBy("l_returnflag", F.spark_partition_id().alias("run")).agg(F.collect_list(F.struct("n", "m", "q")).alias("parts"))
    once = runs.select("l_returnflag", F.aggregate("parts", state, merge).alias("s"))
    whole = once.groupBy("l_returnflag").agg(F.sum("s.n").alias("n"), (F.sum(F.col("s.m") * F.col("s.n")) / F.sum("s.n")).alias("mean"), F.collect_list("s").alias("parts"))
    merged = whole.select("l_returnflag", "n", F.round("mean", 6).alias("mean"), F.aggregate("parts", state, merge).alias("s"))
    return merged.select("l_returnflag", "n", "mean", F.round(F.sqrt(F.col("s.q") / F.col("s.n")), 6).alias("own"))


@query("udf_loss", "SELECT round(sqrt(avg(pow(l_quantity - l_linenumber, 2))), 9) AS loss FROM lineitem")
def _(t):
    from tabloom.operators.metrics import loss

    return loss(t.lineitem, "round(sqrt(avg(pow(l_quantity - l_linenumber, 2))), 9)")
