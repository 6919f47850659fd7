"""Filters, projections, joins, aggregates, sorts, set operations, SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.catalog.registry import Tables, query
from tabloom.operators import aggregates as A, frame as R, joins as J
from tabloom.plans.draws import uniform_sql

# ---------------------------------------------------------------- projections and filters


@query("select_cols", "SELECT p_partkey, p_name FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name")


@query("drop_cols", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem")
def _(t):
    return R.drop_cols(t.lineitem, ["l_extendedprice", "l_discount", "l_tax", "l_linestatus", "not_there"])


@query("filter_eq", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")


@query("filter_range", "SELECT p_partkey, p_size FROM part WHERE p_size >= 10 AND p_size <= 20")
def _(t):
    return R.between(t.part, "p_size", 10, 20).select("p_partkey", "p_size")


@query("filter_range_open", "SELECT p_partkey, p_size FROM part WHERE p_size > 10 AND p_size < 20")
def _(t):
    return R.between(t.part, "p_size", 10, 20, inclusive=False).select("p_partkey", "p_size")


@query("filter_period_key", """SELECT event_id, ts, value FROM events
WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00' AND user_id = 8""")
def _(t):
    out = R.select_period(t.events, "ts", _ts("2024-01-05 00:00:00"), _ts("2024-01-20 00:00:00"), "user_id", 8)
    return out.select("event_id", "ts", "value")


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("filter_year", "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1998")
def _(t):
    return R.of_year(t.orders, "o_orderdate", 1998).select("o_orderkey", "o_orderdate")


@query("filter_null", "SELECT c_custkey FROM customer WHERE nullif(c_mktsegment, 'MACHINERY') IS NULL")
def _(t):
    return t.customer.filter(F.nullif("c_mktsegment", F.lit("MACHINERY")).isNull()).select("c_custkey")


@query("dropna", """SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal >= 0""")
def _(t):
    made = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("s_acctbal"))
    return made.na.drop("any")


@query("drop_zero_marker", "SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0")
def _(t):
    return R.drop_markers(t.lineitem, ["l_discount", "l_tax"]).select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query("update_where", """SELECT p_partkey, CASE WHEN p_size > 40 THEN 40 ELSE p_size END AS p_size FROM part""")
def _(t):
    return R.update_where(t.part, F.col("p_size") > 40, "p_size", 40).select("p_partkey", "p_size")


@query("rename_cols", "SELECT r_regionkey AS id, r_name AS name FROM region")
def _(t):
    return R.rename_cols(t.region, ["id", "name"])


@query("add_col_fn", "SELECT p_partkey, round_even(p_size / 2.0, 0)::BIGINT AS half FROM part")
def _(t):
    return R.with_expr(t.part, "half", F.bround(F.col("p_size") / 2.0).cast("long")).select("p_partkey", "half")


@query("replace_values", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS o_orderstatus FROM orders""")
def _(t):
    return R.replace_values(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": 0, "O": 1})


@query("with_row_id", "SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label FROM embeddings")
def _(t):
    return R.with_row_id(t.embeddings.select("vec_id", "label"), ["vec_id"])


@query("reject_prefilter", "SELECT doc_id, upper(lang) AS lang FROM documents WHERE contains(text, 'the')")
def _(t):
    return R.contains_text(t.documents, "text", "the").select("doc_id", F.upper("lang").alias("lang"))


@query("trim_range", "SELECT conv_id, turn, role FROM conversations WHERE turn BETWEEN 1 AND 3")
def _(t):
    return R.trim_range(t.conversations, "turn", 1, 3).select("conv_id", "turn", "role")


# ---------------------------------------------------------------- joins


@query("join_lookup", """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_name FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _(t):
    out = J.join_lookup(t.lineitem, t.part.select("p_partkey", "p_name"), "l_partkey", "p_partkey")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "p_name")


@query("join_natural", """SELECT o_orderkey AS key, o_totalprice, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def _(t):
    a = t.orders.select(F.col("o_orderkey").alias("key"), "o_totalprice")
    b = t.lineitem.select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_quantity")
    return J.join_natural(a, b)


@query("join_index", """SELECT l_shipdate AS date, l_orderkey, l_linenumber, l_quantity, day_total FROM lineitem
JOIN (SELECT l_shipdate AS d, sum(l_quantity) AS day_total FROM lineitem GROUP BY 1) ON l_shipdate = d""")
def _(t):
    rows = t.lineitem.select(F.col("l_shipdate").alias("date"), "l_orderkey", "l_linenumber", "l_quantity")
    return J.join_on(rows, rows.groupBy("date").agg(F.sum("l_quantity").alias("day_total")), "date")


@query("join_checked", """SELECT s_suppkey, s_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def _(t):
    names = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return J.join_checked(t.supplier.select("s_suppkey", "s_nationkey"), names, ["s_nationkey"])


@query("join_dummies", """SELECT o_orderkey, o_orderstatus, (o_orderstatus = 'F')::INT AS "o_orderstatus-F",
(o_orderstatus = 'O')::INT AS "o_orderstatus-O", (o_orderstatus = 'P')::INT AS "o_orderstatus-P" FROM orders""")
def _(t):
    from tabloom.operators.features import encode_single_dummy

    return encode_single_dummy(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"])


@query("map_lookup", """SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey""")
def _(t):
    some = t.nation.filter("n_regionkey < 3")
    return J.map_values(t.customer, "c_nationkey", some, "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


@query("cross_grid", """SELECT r_regionkey, sum(abs(n_nationkey - 2 * r_regionkey - 1))::BIGINT AS loss FROM region, nation GROUP BY 1""")
def _(t):
    return J.grid_eval(t.region.select("r_regionkey"), t.nation, "sum(abs(n_nationkey - 2 * $r_regionkey - 1))")


@query("cross_corners", """WITH s AS (SELECT max(p_size) AS hs, min(p_size) AS ls, max(p_retailprice) AS hp, min(p_retailprice) AS lp FROM part)
SELECT a.v AS p_size, b.v AS p_retailprice FROM (SELECT hs AS v FROM s UNION ALL SELECT ls FROM s) a, (SELECT hp AS v FROM s UNION ALL SELECT lp FROM s) b""")
def _(t):
    return J.corner_grid(t.part, ["p_size", "p_retailprice"])


@query("cross_max_distance", """WITH m AS (SELECT var_samp(p_size) AS a, covar_samp(p_size, p_retailprice) AS b, var_samp(p_retailprice) AS d,
 max(p_size) AS hs, min(p_size) AS ls, max(p_retailprice) AS hp, min(p_retailprice) AS lp FROM part),
c AS (SELECT x.v AS p_size, y.v AS p_retailprice FROM (SELECT hs AS v FROM m UNION ALL SELECT ls FROM m) x, (SELECT hp AS v FROM m UNION ALL SELECT lp FROM m) y)
SELECT c.p_size::DOUBLE AS p_size, c.p_retailprice, round(max(sqrt((pow(c.p_size - p.p_size, 2) * m.d
 - 2 * (c.p_size - p.p_size) * (c.p_retailprice - p.p_retailprice) * m.b
 + pow(c.p_retailprice - p.p_retailprice, 2) * m.a) / (m.a * m.d - m.b * m.b))), 6) AS dist
FROM c, part p, m GROUP BY 1, 2""")
def _(t):
    cols = ["p_size", "p_retailprice"]
    inverse = A.inverse_covariance(t.part, cols)
    out = J.max_distance(J.corner_grid(t.part, cols), t.part, cols, inverse)
    return out.withColumn("dist", F.round("dist", 6))


# redirects: chains of up to 63 steps, shorter ones that run into each other, circles of two, and some that lead into these
_REDIRECTS = """SELECT 'C' || c_custkey AS title, 'C' || (c_custkey - 1) AS redirect FROM customer WHERE c_custkey % 64 <> 0
UNION ALL SELECT 'P' || p_partkey, 'P' || CASE p_partkey % 50 WHEN 1 THEN p_partkey + 1 WHEN 2 THEN p_partkey - 1 ELSE p_partkey - (p_partkey % 7 + 1) END FROM part
WHERE p_partkey % 50 IN (1, 2) OR p_partkey % 4 <> 0"""


@query("resolve_redirects", f"""WITH RECURSIVE r AS ({_REDIRECTS}), reach(title, goal) AS (SELECT title, redirect FROM r UNION SELECT reach.title, r.redirect FROM reach JOIN r ON r.title = reach.goal),
ends AS (SELECT title, goal FROM reach WHERE goal NOT IN (SELECT title FROM r)),
links AS (SELECT o_orderkey AS source_article_id, CASE WHEN o_orderkey % 2 = 0 THEN 'C' || o_custkey ELSE 'P' || (o_custkey + 1) END AS name FROM orders),
named AS (SELECT source_article_id, CASE WHEN r.title IS NULL THEN name ELSE ends.goal END AS target FROM links LEFT JOIN r ON r.title = name LEFT JOIN ends ON ends.title = name),
a AS (SELECT p_partkey AS article_id, 'P' || p_partkey AS title FROM part UNION ALL SELECT -c_custkey, 'C' || c_custkey FROM customer)
SELECT source_article_id, target, article_id AS target_article_id FROM named LEFT JOIN a ON target = a.title""")
def _(t):
    named = lambda kind, n: F.concat(F.lit(kind), n)
    k, c = F.col("p_partkey"), F.col("c_custkey")
    step = F.when(k % 50 == 1, k + 1).when(k % 50 == 2, k - 1).otherwise(k - (k % 7 + 1))
    redirects = t.customer.filter(c % 64 != 0).select(named("C", c).alias("title"), named("C", c - 1).alias("redirect")).unionByName(
        t.part.filter((k % 50).isin(1, 2) | (k % 4 != 0)).select(named("P", k).alias("title"), named("P", step).alias("redirect")))
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    links = t.orders.select(order.alias("source_article_id"), F.when(order % 2 == 0, named("C", cust)).otherwise(named("P", cust + 1)).alias("target_article_name"))
    articles = t.part.select(k.alias("article_id"), named("P", k).alias("title")).unionByName(t.customer.select((-c).alias("article_id"), named("C", c).alias("title")))
    return J.resolve_redirects(links, redirects, articles)


@query("subq_correlated", """SELECT a.l_returnflag, sum(a.l_quantity) / (SELECT count(*) FROM lineitem b WHERE b.l_returnflag = a.l_returnflag) AS per_row
FROM lineitem a GROUP BY a.l_returnflag""")
def _(t):
    t.view("lineitem")
    return t.spark.sql("""SELECT a.l_returnflag, sum(a.l_quantity) /
        max((SELECT count(*) FROM lineitem b WHERE b.l_returnflag = a.l_returnflag)) AS per_row
        FROM lineitem a GROUP BY a.l_returnflag""")


@query("shift_diff_join", """WITH n AS (SELECT l_orderkey, l_linenumber, l_extendedprice, lead(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS x,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i FROM lineitem)
SELECT l_orderkey, (i + 1)::BIGINT AS i, round(x - l_extendedprice, 6) AS price_diff FROM n WHERE x IS NOT NULL""")
def _(t):
    """Each line against the one before it, as an equi join of a table with itself shifted by one position."""
    return J.shift_diff(t.lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_extendedprice", "i", "price_diff").withColumn("price_diff", F.round("price_diff", 6))


# ---------------------------------------------------------------- aggregates


@query("agg_mean_by", "SELECT l_returnflag, avg(l_quantity) AS mean_l_quantity, avg(l_linenumber) AS mean_l_linenumber FROM lineitem GROUP BY 1")
def _(t):
    return A.mean_by(t.lineitem, ["l_returnflag"], ["l_quantity", "l_linenumber"])


@query("agg_sum_by_date", "SELECT l_shipdate, sum(l_quantity) AS total FROM lineitem GROUP BY 1")
def _(t):
    return A.sum_by(t.lineitem, ["l_shipdate"], "l_quantity")


@query("agg_sum_by_weekday", "SELECT (isodow(l_shipdate) - 1)::INT AS dow, dayname(l_shipdate) AS weekday, sum(l_quantity) AS total FROM lineitem GROUP BY 1, 2")
def _(t):
    return A.sum_by_weekday(t.lineitem, "l_shipdate", "l_quantity")


@query("agg_sum_two_keys", """SELECT l_shipdate, l_partkey, p_name, sum(l_quantity) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")
def _(t):
    totals = A.sum_by(t.lineitem, ["l_shipdate", "l_partkey"], "l_quantity")
    return J.join_lookup(totals, t.part.select("p_partkey", "p_name"), "l_partkey", "p_partkey")


@query("agg_sum_week_item", """SELECT (date_diff('day', DATE '1995-01-02', l_shipdate::DATE) // 7)::BIGINT AS week, l_partkey, sum(l_quantity) AS total
FROM lineitem GROUP BY 1, 2""")
def _(t):
    from tabloom.operators.timeseries import calendar_features

    weeks = calendar_features(t.lineitem.select("l_shipdate", "l_partkey", "l_quantity"), "l_shipdate", "1995-01-02")
    return A.sum_by(weeks, ["week", "l_partkey"], "l_quantity")


@query("agg_sum_weekday_item", """SELECT (isodow(l_shipdate) - 1)::INT AS dow, dayname(l_shipdate) AS weekday, l_partkey, sum(l_quantity) AS total
FROM lineitem GROUP BY 1, 2, 3""")
def _(t):
    return A.sum_by_weekday(t.lineitem, "l_shipdate", "l_quantity", "l_partkey")


@query("agg_multi", """SELECT l_partkey, l_suppkey, l_shipdate, avg(l_quantity) AS sales, max(l_linenumber) AS lines FROM lineitem GROUP BY 1, 2, 3""")
def _(t):
    return A.agg_by(t.lineitem, ["l_partkey", "l_suppkey", "l_shipdate"],
                    {"sales": ("avg", "l_quantity"), "lines": ("max", "l_linenumber")})


@query("agg_popular", """SELECT p_partkey AS item_id, p_name AS name, sum(l_quantity) AS item_count FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_partkey, p_name ORDER BY item_count DESC""")
def popular(t: Tables) -> DataFrame:
    return A.popular_items(t.lineitem, t.part, "l_partkey", "l_quantity", "p_partkey", "p_name")


@query("agg_count_mean", "SELECT o_orderpriority, count(o_custkey) AS n, avg(o_custkey) AS mean FROM orders GROUP BY 1")
def _(t):
    return A.count_mean(t.orders, "o_orderpriority", "o_custkey")


@query("agg_first_last_date", "SELECT l_partkey, min(l_shipdate) AS launch, max(l_shipdate) AS stop FROM lineitem WHERE l_quantity > 0 GROUP BY 1")
def _(t):
    return A.launch_stop_dates(t.lineitem, "l_partkey", "l_shipdate", "l_quantity")


@query("agg_nunique", "SELECT count(DISTINCT user_id) AS n_unique FROM events")
def _(t):
    return A.nunique(t.events, "user_id")


@query("agg_is_unique", "SELECT count(*) > count(DISTINCT (l_orderkey, l_linenumber)) AS has_duplicates FROM lineitem")
def _(t):
    return A.has_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("agg_null_counts", """WITH j AS (SELECT event_id, c_custkey, c_acctbal FROM events LEFT JOIN customer ON user_id = 3 * c_custkey)
SELECT 'c_custkey' AS "column", count(*) - count(c_custkey) AS nulls FROM j UNION ALL SELECT 'c_acctbal', count(*) - count(c_acctbal) FROM j""")
def _(t):
    c = t.customer.select("c_custkey", "c_acctbal", (3 * F.col("c_custkey")).alias("user_id"))
    j = t.events.join(c, "user_id", "left").select("event_id", "c_custkey", "c_acctbal")
    return A.null_counts(j, positive_only=True)


@query("agg_null_by_month", """SELECT month(o_orderdate)::INT AS month, count(*) FILTER (nullif(o_orderstatus, 'P') IS NULL) AS o_orderstatus,
count(*) FILTER (nullif(o_orderpriority, '5-LOW') IS NULL) AS o_orderpriority FROM orders GROUP BY 1""")
def _(t):
    made = t.orders.withColumns({
        "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
        "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW"))})
    return A.null_counts_by(made, F.month("o_orderdate"), "month", ["o_orderstatus", "o_orderpriority"])


@query("agg_minmax", "SELECT min(ts) AS first, max(ts) AS last FROM events")
def _(t):
    return A.time_range(t.events, "ts")


@query("agg_shape", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def _(t):
    return A.shape(t.lineitem)


@query("agg_median", "SELECT median(l_extendedprice) AS median FROM lineitem")
def _(t):
    return A.median(t.lineitem, "l_extendedprice")


@query("agg_mode", "SELECT o_orderpriority AS mode FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1")
def _(t):
    return A.mode_(t.orders, "o_orderpriority")


@query("agg_sd", "SELECT round(stddev_samp(l_quantity), 8) AS sd_sample, round(stddev_pop(l_quantity), 8) AS sd_population FROM lineitem")
def _(t):
    out = A.spread(t.lineitem, "l_quantity")
    return out.select(F.round("sd_sample", 8).alias("sd_sample"), F.round("sd_population", 8).alias("sd_population"))


@query("agg_missing_ratio", """SELECT count(DISTINCT user_id) AS stations, count(*) AS actual,
count(DISTINCT user_id) * 10.0::DOUBLE * 24 * 1095 AS expected, round(1 - count(*) / (count(DISTINCT user_id) * 10.0::DOUBLE * 24 * 1095), 9) AS missing_ratio FROM events""")
def _(t):
    return A.missing_ratio(t.events, "user_id", "ts", 6.0, 3).withColumn("missing_ratio", F.round("missing_ratio", 9))


@query("agg_max_gap", """SELECT max(floor(epoch_us(ts) / 1e6 - epoch_us(p) / 1e6)) / 60 AS max_gap_minutes FROM
(SELECT ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)""")
def _(t):
    return A.max_gap_minutes(t.events, "user_id", "ts", "event_id")


@query("agg_corr_matrix", """WITH c AS (SELECT corr(l_quantity, l_quantity) AS qq, corr(l_quantity, l_extendedprice) AS qp, corr(l_extendedprice, l_extendedprice) AS pp FROM lineitem),
m AS (SELECT 'l_quantity' AS a, 'l_quantity' AS b, qq AS corr FROM c UNION ALL SELECT 'l_quantity', 'l_extendedprice', qp FROM c
UNION ALL SELECT 'l_extendedprice', 'l_quantity', qp FROM c UNION ALL SELECT 'l_extendedprice', 'l_extendedprice', pp FROM c)
SELECT a, b, round(corr, 6) AS corr FROM m WHERE corr > 0.1""")
def _(t):
    return A.corr_matrix(t.lineitem, ["l_quantity", "l_extendedprice"], 0.1).withColumn("corr", F.round("corr", 6))


@query("agg_cov_matrix", """WITH c AS (SELECT var_samp(l_quantity) AS qq, covar_samp(l_quantity, l_linenumber) AS qp, var_samp(l_linenumber) AS pp FROM lineitem)
SELECT 'l_quantity' AS a, 'l_quantity' AS b, round(qq, 6) AS cov FROM c UNION ALL SELECT 'l_quantity', 'l_linenumber', round(qp, 6) FROM c
UNION ALL SELECT 'l_linenumber', 'l_quantity', round(qp, 6) FROM c UNION ALL SELECT 'l_linenumber', 'l_linenumber', round(pp, 6) FROM c""")
def _(t):
    return A.cov_matrix(t.lineitem, ["l_quantity", "l_linenumber"]).withColumn("cov", F.round("cov", 6))


@query("agg_value_counts", """SELECT o_orderpriority, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM orders), 2) AS pct FROM orders GROUP BY 1""")
def _(t):
    return A.value_shares(t.orders, "o_orderpriority")


@query("agg_histogram", """WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
SELECT least(floor((l_quantity - lo) / ((hi - lo) / 10.0::DOUBLE)), 9)::INT AS bin, count(*) AS n FROM lineitem, s GROUP BY 1""")
def _(t):
    return A.histogram(t.lineitem, "l_quantity", 10)


@query("agg_crosstab", """SELECT quality, count(*) FILTER (toxic = 0) AS "0", count(*) FILTER (toxic = 1) AS "1" FROM labels GROUP BY 1""")
def _(t):
    return A.crosstab(t.labels, "quality", "toxic")


@query("agg_best_of", """SELECT l_returnflag, l_linestatus, min(l_extendedprice) AS error, arg_min(l_orderkey, (l_extendedprice, l_orderkey)) AS cycle FROM lineitem GROUP BY 1, 2""")
def _(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", F.col("l_extendedprice").alias("error"),
                             F.col("l_orderkey").alias("cycle"))
    ranked = rows.withColumn("at", F.struct("error", "cycle"))
    return A.best_cycle(ranked, ["l_returnflag", "l_linestatus"], "at").drop("at")


@query("agg_sum_squared", """WITH a AS (SELECT p_brand AS name, avg(p_size) AS v FROM part GROUP BY 1), b AS (SELECT p_brand AS name, avg(p_partkey) AS v FROM part GROUP BY 1)
SELECT round(sqrt(sum((a.v - b.v) * (a.v - b.v))), 6) AS distance FROM a JOIN b USING (name)""")
def _(t):
    a = t.part.groupBy(F.col("p_brand").alias("name")).agg(F.avg("p_size").alias("v"))
    b = t.part.groupBy(F.col("p_brand").alias("name")).agg(F.avg("p_partkey").alias("v"))
    return A.rank_diff(a, b, "name", "v").withColumn("distance", F.round("distance", 6))


@query("agg_running_total", """WITH c AS (SELECT doc_id, n_chars AS completed, sum(n_chars) OVER (ORDER BY doc_id)::BIGINT AS total FROM documents)
SELECT doc_id, completed, total, total // 100000 > (total - completed) // 100000 AS message FROM c""")
def _(t):
    reports = t.documents.select("doc_id", F.col("n_chars").alias("completed"))
    return A.progress(reports, ["doc_id"])


@query("sql_rate", "SELECT quality, avg(toxic) AS rate FROM labels GROUP BY 1")
def _(t):
    t.view("labels")
    return t.spark.sql("""SELECT a.quality, sum(a.toxic) / max((SELECT count(*) FROM labels b WHERE a.quality = b.quality)) AS rate
        FROM labels a GROUP BY a.quality ORDER BY 1""")


@query("rate_by", "SELECT quality, avg(toxic) AS rate FROM labels GROUP BY 1")
def _(t):
    return A.rate_by(t.labels, "quality", "toxic")


# ---------------------------------------------------------------- sort, limit, sets


@query("sort_desc", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey")
def _(t):
    return t.part.select("p_partkey", "p_retailprice").orderBy(F.desc_nulls_last("p_retailprice"), "p_partkey")


@query("sort_group", "SELECT p_brand, avg(p_size) AS mean_p_size FROM part GROUP BY 1 ORDER BY 1")
def _(t):
    return A.mean_by(t.part, ["p_brand"], ["p_size"]).orderBy("p_brand")


@query("head_tail", """(SELECT 'head' AS side, event_id, ts FROM events ORDER BY ts, event_id LIMIT 5) UNION ALL (SELECT 'tail', event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 5)""")
def _(t):
    e = t.events.select("event_id", "ts")
    return (R.head(e, 5, ["ts", "event_id"]).select(F.lit("head").alias("side"), "event_id", "ts")
            .unionByName(R.tail(e, 5, ["ts", "event_id"]).select(F.lit("tail").alias("side"), "event_id", "ts")))


@query("slice_rows", "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 10 OFFSET 20")
def _(t):
    return R.slice_rows(t.part.select("p_partkey", "p_name"), ["p_name", "p_partkey"], 20, 30)


@query("topk_importance", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def _(t):
    return R.topk(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", 25, "p_partkey")


@query("shuffle_rows", "SELECT vec_id, label FROM embeddings")
def _(t):
    return R.shuffle(t.embeddings.select("vec_id", "label"), 7)


@query("union_rows", "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier")
def _(t):
    return R.union([t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")),
                    t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))])


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def _(t):
    return R.distinct_values(t.orders, "o_orderpriority")


@query("set_difference", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def _(t):
    taken = t.lineitem.filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return R.except_ids(t.part.select("p_partkey"), taken, "p_partkey")


@query("split_random", f"SELECT o_orderkey, CASE WHEN {uniform_sql(42, 'o_orderkey')} < 0.25 THEN 'test' ELSE 'train' END AS side FROM orders")
def _(t):
    train, test = R.split_random(t.orders.select("o_orderkey"), 0.25, ["o_orderkey"])
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query("split_block", """SELECT vec_id, CASE WHEN row_number() OVER (ORDER BY vec_id) <= floor((SELECT count(*) FROM embeddings) * 0.9) THEN 'train' ELSE 'test' END AS side FROM embeddings""")
def _(t):
    train, test = R.split_block(t.embeddings.select("vec_id"), ["vec_id"], 0.9)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query("split_solution", """WITH n AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS i, floor((SELECT count(*) FROM embeddings) * 0.9) AS cut FROM embeddings)
SELECT 'train' AS part, vec_id, label::DOUBLE AS label FROM n WHERE i <= cut UNION ALL SELECT 'test', vec_id, NULL FROM n WHERE i > cut
UNION ALL SELECT 'solution', vec_id, label FROM n WHERE i > cut UNION ALL SELECT 'sample', vec_id, 0.64 FROM n WHERE i > cut""")
def _(t):
    parts = R.competition_split(t.embeddings.select("vec_id", "label"), ["vec_id"], 0.9, "label", 0.64)
    parts["test"] = parts["test"].withColumn("label", F.lit(None))
    return R.union([p.select(F.lit(n).alias("part"), "vec_id", F.col("label").cast("double").alias("label"))
                    for n, p in parts.items()])


# ---------------------------------------------------------------- SQL


@query("sql_prepare", """SELECT s_suppkey, CASE n_regionkey WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE -1 END AS code,
round(coalesce(CASE WHEN s_acctbal >= 0 THEN s_acctbal END, (SELECT avg(CASE WHEN s_acctbal >= 0 THEN s_acctbal END) FROM supplier)), 6) AS acctbal
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def _(t):
    t.view("nation")
    t.supplier.selectExpr("s_suppkey", "s_nationkey", "if(s_acctbal >= 0, s_acctbal, null) AS s_acctbal").createOrReplaceTempView("known_supplier")
    return t.spark.sql("""SELECT s_suppkey, decode(n_regionkey, 0, 1, 1, 0, -1) AS code,
        round(nvl(s_acctbal, (SELECT avg(s_acctbal) FROM known_supplier)), 6) AS acctbal
        FROM known_supplier JOIN nation ON s_nationkey = n_nationkey""")
