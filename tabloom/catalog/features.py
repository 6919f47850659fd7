"""Encoders, imputers, outliers and profiles on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.catalog.registry import Tables, query
from tabloom.functions.scalar import normal_quantile_sql, normal_tail_sql
from tabloom.operators import features as FE, profiling as PR


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("enc_dummy", """SELECT o_orderkey, (o_orderstatus = 'F')::INT AS "o_orderstatus-F", (o_orderstatus = 'O')::INT AS "o_orderstatus-O", (o_orderstatus = 'P')::INT AS "o_orderstatus-P" FROM orders""")
def _(t):
    return FE.encode_dummy(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query("enc_dummy_drop_first", """SELECT o_orderkey, (o_orderstatus = 'O')::INT AS "o_orderstatus-O", (o_orderstatus = 'P')::INT AS "o_orderstatus-P" FROM orders""")
def _(t):
    return FE.encode_dummy(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", drop_first=True)


@query("enc_single_dummy", """SELECT o_orderkey, o_orderpriority, (o_orderpriority = '1-URGENT')::INT AS "o_orderpriority-1-URGENT" FROM orders""")
def _(t):
    return FE.encode_single_dummy(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["1-URGENT"])


@query("enc_index", """SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INT AS o_orderpriority FROM orders""")
def _(t):
    return FE.encode_index(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority")[0]


@query("enc_zscore", """SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_samp(l_quantity) FROM lineitem), 8) AS l_quantity FROM lineitem""")
def _(t):
    return _round(FE.encode_zscore(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), ["l_quantity"]), 8, "l_quantity")


@query("enc_zscore_pop", """SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 8) AS l_quantity FROM lineitem""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return _round(FE.encode_zscore(rows, ["l_quantity"], ddof=0), 8, "l_quantity")


@query("enc_range", """WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - lo) / (hi - lo) * 2 - 1, 9) AS l_quantity FROM lineitem, s""")
def _(t):
    return _round(FE.encode_range(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity"), 9, "l_quantity")


@query("enc_minmax", """WITH s AS (SELECT min(p_size) AS a, max(p_size) AS b, min(p_retailprice) AS c, max(p_retailprice) AS d FROM part)
SELECT p_partkey, round((p_size - a) / (b - a)::DOUBLE, 9) AS p_size, round((p_retailprice - c) / (d - c), 9) AS p_retailprice FROM part, s""")
def _(t):
    return _round(FE.minmax(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"]), 9, "p_size", "p_retailprice")


@query("enc_standard", """SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part), 8) AS p_size FROM part""")
def _(t):
    return _round(FE.standardize(t.part.select("p_partkey", "p_size"), ["p_size"]), 8, "p_size")


@query("enc_ratio_features", """SELECT p_partkey, x - y AS f_diff, round(x / y, 9) AS f_ratio, pow(x, 2.0) AS f_pow, round(ln(x), 9) AS f_log, round(sqrt(x), 9) AS f_sqrt,
1 + 5 * x + 8 * pow(x, 2.0) AS f_poly, 2 + 5 * pow(x * y, 2.0) + 4 * x * y AS f_poly2, round(1 / (5 * x + 8 * pow(x, 2.0)), 12) AS f_rpoly,
round(1 / (2 + 5 * pow(x * y, 2.0) + 4 * x * y), 14) AS f_rpoly2 FROM (SELECT p_partkey, p_size::DOUBLE AS x, (p_partkey % 9 + 1)::DOUBLE AS y FROM part)""")
def _(t):
    rows = t.part.select("p_partkey", "p_size", (F.col("p_partkey") % 9 + 1).alias("y"))
    out = _round(FE.engineered(rows, "p_size", "y").drop("p_size", "y"), 9, "f_ratio", "f_log", "f_sqrt")
    return _round(_round(out, 12, "f_rpoly"), 14, "f_rpoly2")


@query("enc_target_smooth", """WITH g AS (SELECT avg(o_custkey) AS g FROM orders), s AS (SELECT o_orderpriority AS c, count(o_custkey) AS n, avg(o_custkey) AS m FROM orders GROUP BY 1)
SELECT o_orderkey, o_orderpriority, round((n * m + 5 * g) / (n + 5), 8) AS encoded FROM orders JOIN s ON c = o_orderpriority, g""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_custkey")
    out = FE.target_encode(rows, None, "o_orderpriority", "o_custkey", 5.0).drop("o_custkey")
    return _round(out, 8, "encoded")


@query("imp_median", """WITH p AS (SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN p_size END AS s FROM part)
SELECT p_partkey, coalesce(s, (SELECT median(s) FROM p))::DOUBLE AS s FROM p""")
def _(t):
    rows = t.part.select("p_partkey", F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("s"))
    return FE.impute_median(rows, ["s"])


@query("imp_mean", """WITH p AS (SELECT s_suppkey, CASE WHEN s_nationkey > 4 THEN s_nationkey END AS n FROM supplier) SELECT s_suppkey, coalesce(n, (SELECT avg(n) FROM p))::DOUBLE AS n FROM p""")
def _(t):
    return FE.impute_mean(t.supplier.select("s_suppkey", F.when(F.col("s_nationkey") > 4, F.col("s_nationkey")).alias("n")), ["n"])


@query("imp_mode", """WITH p AS (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS p FROM orders)
SELECT o_orderkey, coalesce(p, (SELECT p FROM p WHERE p IS NOT NULL GROUP BY p ORDER BY count(*) DESC, p LIMIT 1)) AS p FROM p""")
def _(t):
    return FE.impute_mode(t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("p")), "p")


@query("out_sd", """WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS d FROM lineitem WHERE l_extendedprice > 1000)
SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice > 1000 THEN l_extendedprice END AS price FROM lineitem, s WHERE NOT l_extendedprice > 1000 OR abs(l_extendedprice - m) < 2 * d""")
def _(t):
    price = F.when(F.col("l_extendedprice") > 1000, F.col("l_extendedprice"))
    return FE.remove_outliers(t.lineitem.select("l_orderkey", "l_linenumber", price.alias("price")), "price", 2.0)


@query("to_xy", """SELECT doc_id, quality::DOUBLE AS label, [1 - quality, quality]::INT[] AS onehot, 'classification' AS kind FROM labels""")
def _(t):
    rows, kind = FE.to_xy(t.labels, "quality", ["toxic"])
    return rows.select("doc_id", "label", "onehot", F.lit(kind).alias("kind"))


# p-value of the moment test
_JB = """jb AS (SELECT exp(-any_value(n) / 6 * (pow(avg(pow(x - m, 3)) / pow(avg(pow(x - m, 2)), 1.5), 2) + pow(avg(pow(x - m, 4)) / pow(avg(pow(x - m, 2)), 2) - 3, 2) / 4) / 2) AS p
FROM v, (SELECT avg(x) AS m, count(*) AS n FROM v))"""
_PROFILE = f"""WITH v AS (SELECT p_size AS x FROM part), {_JB}
SELECT 'p_size' AS name, 'int' AS type, count(*) AS rows, avg(p_size) AS mean, round(stddev_samp(p_size), 8) AS sd, median(p_size)::DOUBLE AS median, min(p_size)::DOUBLE AS min, max(p_size)::DOUBLE AS max,
NULL AS mode, count(DISTINCT p_size) AS "unique", 0::BIGINT AS missing, (SELECT CASE WHEN p > 0.05 THEN 'zscore' ELSE 'normalize' END FROM jb) AS action FROM part
UNION ALL SELECT 'p_brand', 'str', count(*), NULL, NULL, NULL, NULL, NULL, (SELECT b FROM (SELECT CASE WHEN p_size > 5 THEN p_brand END AS b FROM part) WHERE b IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), count(DISTINCT CASE WHEN p_size > 5 THEN p_brand END) + 1, count(*) FILTER (p_size <= 5), 'dummy' FROM part
UNION ALL SELECT 'p_code', 'str', count(*), NULL, NULL, NULL, NULL, NULL, min('c' || p_partkey), count(*), 0, 'ignore' FROM part"""


def _parts(t: Tables) -> DataFrame:
    return t.part.select("p_size", F.when(F.col("p_size") > 5, F.col("p_brand")).alias("p_brand"),
                         F.concat(F.lit("c"), "p_partkey").alias("p_code"))


@query("prof_columns", _PROFILE)
def _(t):
    return _round(PR.profile(_parts(t)).drop("p"), 8, "sd")


@query("prof_action", f"SELECT name, CASE WHEN name = 'p_size' THEN 'target' ELSE action END AS action FROM ({_PROFILE})")
def _(t):
    return PR.profile(_parts(t), target="p_size").select("name", "action")


@query("prof_normality", """WITH m AS (SELECT avg(l_quantity) AS m, count(*) AS n FROM lineitem), c AS (SELECT any_value(n) AS n, avg(pow(l_quantity - m, 2)) AS m2, avg(pow(l_quantity - m, 3)) AS m3, avg(pow(l_quantity - m, 4)) AS m4 FROM lineitem, m)
SELECT 'l_quantity' AS name, round(n / 6 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4), 6) AS stat FROM c""")
def _(t):
    return _round(PR.normality(t.lineitem, ["l_quantity"]).select("name", "stat"), 6, "stat")


_RANKED = " UNION ALL ".join(f"SELECT '{c}' AS name, {c}::DOUBLE AS v, row_number() OVER (ORDER BY {c}) AS i, count(*) OVER () AS n FROM lineitem" for c in ("l_quantity", "l_extendedprice"))


@query("prof_normality_rank", f"""WITH r AS ({_RANKED}), q AS (SELECT name, v, n, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p FROM r),
s AS (SELECT name, any_value(n) AS n, pow(corr(v, {normal_quantile_sql('p', 'tail')}), 2) AS stat FROM (SELECT *, {normal_tail_sql('p')} AS tail FROM q) GROUP BY name)
SELECT name, n, round(stat, 8) AS stat, round((ln(1 - stat) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n)))) / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))), 6) AS z FROM s""")
def _(t):
    out = PR.normality_by_rank(t.lineitem, ["l_quantity", "l_extendedprice"])
    return _round(_round(out, 8, "stat"), 6, "z")


@query("prof_positive", "SELECT DISTINCT CASE WHEN quality = 1 THEN 'y' END AS token FROM labels WHERE quality = 1")
def _(t):
    words = t.labels.select(F.when(F.col("quality") == 1, "y").otherwise("n").alias("q"))
    token = PR.find_positive(words, "q")
    return t.spark.range(1).select(F.lit(token).alias("token"))


@query("prof_task_type", "SELECT CASE WHEN count(DISTINCT quality) = 2 THEN 'binary-classification' ELSE 'classification' END AS a, 'regression' AS b FROM labels")
def _(t):
    return t.spark.range(1).select(F.lit(PR.task_type(t.labels, "quality", False)).alias("a"),
                                   F.lit(PR.task_type(t.labels, "quality", True)).alias("b"))


@query("prof_apply", f"""WITH v AS (SELECT s_nationkey AS x FROM supplier), {_JB}, s AS (SELECT min(x) AS lo, max(x) AS hi, avg(x) AS m, stddev_pop(x) AS sd FROM v)
SELECT s_suppkey::VARCHAR AS k, round(CASE WHEN p > 0.05 THEN (s_nationkey - m) / sd ELSE (s_nationkey - lo) / (hi - lo)::DOUBLE END, 9) AS n FROM supplier, s, jb""")
def _(t):
    rows = t.supplier.select(F.col("s_suppkey").cast("string").alias("k"), F.col("s_nationkey").alias("n"))
    plan = PR.profile(rows, ["n"])
    return _round(PR.apply_plan(rows, plan), 9, "n")


@query("prof_categorical", """WITH c AS (SELECT 'o_orderpriority' AS name, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY 2)
SELECT name, count(*) AS n_unique, NULL::BIGINT AS pct_unique, '[' || string_agg(v || ':' || format('{:.2f}', round(100 * n / (SELECT count(*) FROM orders), 2)) || '%', ',' ORDER BY n DESC, v) || ']' AS "values" FROM c GROUP BY 1
UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey), floor(100 * count(DISTINCT o_custkey) / count(*))::BIGINT, NULL FROM orders""")
def _(t):
    return PR.profile_categorical(t.orders, ["o_orderpriority", "o_orderstatus", "o_custkey"])
