"""Metrics and importance: labels scored by a number computed from the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.catalog.registry import Tables, query
from tabloom.functions import scalar as S
from tabloom.operators import metrics as M, ranking as RK
from tabloom.plans.draws import permutation_sql, uniform_sql

# score: hundredths, so that thresholds repeat; yhat: above one half
SCORED = """(SELECT l.doc_id, l.quality AS y, l.toxic, CAST(d.n_chars % 100 AS DOUBLE) / 100 AS score, (CAST(d.n_chars % 100 AS DOUBLE) / 100 > 0.5)::INT AS yhat
FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
CLASSES = "(SELECT event_id, event_id % 3 AS y, (event_id * 7 // 5) % 4 AS yhat FROM events)"


def scored(t: Tables) -> DataFrame:
    score = (F.col("n_chars") % 100).cast("double") / 100
    rows = t.labels.join(t.documents.select("doc_id", score.alias("score")), "doc_id")
    return M.classify(rows.select("doc_id", F.col("quality").alias("y"), "toxic", "score"), "score", 0.5, "yhat")


def classes(t: Tables) -> DataFrame:
    n = F.col("event_id")
    return t.events.select("event_id", (n % 3).alias("y"), F.expr("event_id * 7 div 5 % 4").alias("yhat"))


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("ev_threshold", f"SELECT doc_id, yhat FROM {SCORED}")
def _(t):
    return scored(t).select("doc_id", "yhat")


@query("ev_argmax", "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS predicted FROM embeddings")
def _(t):
    return M.classify_argmax(t.embeddings, "embedding").select("vec_id", "predicted")


@query("ev_confusion_counts", f"""WITH c AS (SELECT count(*) FILTER (y = 1) AS positives, count(*) FILTER (y <> 1) AS negatives, count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y <> 1 AND yhat <> 1) AS tn,
count(*) FILTER (y <> 1 AND yhat = 1) AS fp, count(*) FILTER (y = 1 AND yhat <> 1) AS fn FROM {SCORED})
SELECT *, tp / positives AS tpr, tn / negatives AS tnr, fp / negatives AS fpr, fn / positives AS fnr FROM c""")
def _(t):
    return M.confusion_counts(scored(t), "y", "yhat")


@query("ev_accuracy", f"SELECT avg((y = yhat)::INT) AS accuracy FROM {SCORED}")
def _(t):
    return M.accuracy(scored(t), "y", "yhat")


@query("ev_prf", f"""WITH c AS (SELECT count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y <> 1 AND yhat = 1) AS fp, count(*) FILTER (y = 1 AND yhat <> 1) AS fn FROM {SCORED})
SELECT tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 12) AS f1 FROM c""")
def _(t):
    return _round(M.precision_recall_f1(scored(t), "y", "yhat"), 12, "f1")


@query("ev_f1_per_class", f"""WITH s AS (SELECT y AS label, 1 AS t, 0 AS p, (y = yhat)::INT AS h FROM {CLASSES} UNION ALL SELECT yhat, 0, 1, 0 FROM {CLASSES}),
g AS (SELECT label, sum(t) AS t, sum(p) AS p, sum(h) AS h FROM s GROUP BY 1)
SELECT label, CASE WHEN p > 0 THEN h::DOUBLE / p END AS precision, CASE WHEN t > 0 THEN h::DOUBLE / t END AS recall, 2 * h::DOUBLE / (t + p) AS f1 FROM g""")
def _(t):
    return M.f1_per_class(classes(t), "y", "yhat")


@query("ev_confusion", f"""WITH l AS (SELECT DISTINCT unnest([y, yhat]) AS v FROM {CLASSES}), c AS (SELECT a.v AS actual, b.v AS predicted FROM l a, l b),
n AS (SELECT c.*, count(x.y) AS n FROM c LEFT JOIN {CLASSES} x ON x.y = actual AND x.yhat = predicted GROUP BY 1, 2)
SELECT actual, predicted, n, coalesce(n / nullif(sum(n) OVER (PARTITION BY actual), 0), 0)::DOUBLE AS share FROM n""")
def _(t):
    return M.confusion_matrix(classes(t), "y", "yhat", normalize=True)


_ROC = f"""SELECT threshold, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS pp, sum(n) OVER () AS nn, p, n FROM
(SELECT score AS threshold, count(*) FILTER (y = 1) AS p, count(*) FILTER (y <> 1) AS n FROM {SCORED} GROUP BY 1) WINDOW w AS (ORDER BY threshold DESC)"""


@query("ev_roc_auc", f"SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, (tp / pp)::DOUBLE AS tpr, (fp / nn)::DOUBLE AS fpr FROM ({_ROC})")
def _(t):
    return M.roc(scored(t), "y", "score").drop("area")


@query("ev_auc", f"SELECT round(sum(n / nn * (2 * tp - p) / (2 * pp)), 10) AS auc FROM ({_ROC})")
def _(t):
    return _round(M.auc(scored(t), "y", "score"), 10, "auc")


@query("ev_auc_per_class", """WITH f AS (SELECT label AS c, unnest(embedding) AS s, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings),
r AS (SELECT k::VARCHAR AS label, (k = c)::INT AS y, s FROM f WHERE k IN (SELECT label FROM embeddings) UNION ALL SELECT 'micro', (k = c)::INT, s FROM f),
g AS (SELECT label, s, sum(y) AS p, count(*) - sum(y) AS n FROM r GROUP BY 1, 2),
c AS (SELECT label, p, n, sum(p) OVER (PARTITION BY label ORDER BY s DESC) AS tp, sum(p) OVER (PARTITION BY label) AS pp, sum(n) OVER (PARTITION BY label) AS nn FROM g)
SELECT label, round(sum(n / nn * (2 * tp - p) / (2 * pp))::DOUBLE, 9) AS auc FROM c GROUP BY 1""")
def _(t):
    rows = t.embeddings.select("label", "embedding")
    classes = sorted(r["label"] for r in rows.select("label").distinct().collect())  # at most one per element of a vector
    return _round(M.auc_per_class(rows, "label", "embedding", classes), 9, "auc")


@query("ev_logloss", f"""SELECT round(avg(CASE WHEN y = 1 THEN -ln(greatest(0.01, least(0.99, score))) ELSE -ln(1 - greatest(0.01, least(0.99, score))) END), 9) AS log_loss FROM {SCORED}""")
def _(t):
    return _round(M.log_loss(scored(t), "y", "score", 0.01), 9, "log_loss")


_FIT = "(SELECT l_orderkey, l_linenumber, l_quantity AS y, l_linenumber * 5.0::DOUBLE AS yhat FROM lineitem)"


def _fit(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", F.col("l_quantity").alias("y"), (F.col("l_linenumber") * 5.0).alias("yhat"))


@query("ev_r2", f"SELECT round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y)), 9) AS r2 FROM {_FIT}")
def _(t):
    return _round(M.r2(_fit(t), "y", "yhat"), 9, "r2")


@query("ev_mse_rmse", f"SELECT avg((y - yhat) * (y - yhat)) AS mse, sqrt(avg((y - yhat) * (y - yhat))) AS rmse FROM {_FIT}")
def _(t):
    return M.mse_rmse(_fit(t), "y", "yhat")


@query("ev_lift_chart", "SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS position, o_totalprice AS y, o_custkey AS yhat FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("y"), F.col("o_custkey").alias("yhat"))
    return M.regression_chart(rows, "y", "yhat", "o_orderkey")


@query("ev_sae", "SELECT sum(abs(2.0 * p_size + 10 - p_partkey))::DOUBLE AS sae FROM part")
def _(t):
    return M.sae(t.part, "p_size", "p_partkey", (2.0, 10.0))


@query("win_decile", f"""WITH r AS (SELECT y, row_number() OVER (ORDER BY score DESC, doc_id) - 1 AS i, count(*) OVER () AS n FROM {SCORED})
SELECT greatest(1, ceil(10 * i / (n - 1)))::INT AS bucket, sum(y)::BIGINT AS tp, count(*) AS n, sum(y) / count(*) AS score FROM r GROUP BY 1""")
def _(t):
    return M.decile_table(scored(t), "y", "score", "doc_id")


# ---------------------------------------------------------------- importance

FEATURES = ["l_quantity", "l_linenumber", "l_suppkey"]


@query("imp_corr_rank", """WITH c AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS a, abs(corr(l_linenumber, l_extendedprice)) AS b, abs(corr(l_suppkey, l_extendedprice)) AS c FROM lineitem)
SELECT 'l_quantity' AS name, round(a / (a + b + c), 8) AS importance FROM c UNION ALL SELECT 'l_linenumber', round(b / (a + b + c), 8) FROM c UNION ALL SELECT 'l_suppkey', round(c / (a + b + c), 8) FROM c""")
def _(t):
    return _round(RK.corr_rank(t.lineitem, FEATURES, "l_extendedprice"), 8, "importance")


ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice"]
_ORDER = ", ".join(ORDER)
# least squares for three inputs: the normal equations of centred columns, solved by Cramer's rule
_OLS = """c AS (SELECT covar_pop(l_quantity, l_quantity) AS aa, covar_pop(l_quantity, l_linenumber) AS ab, covar_pop(l_quantity, l_suppkey) AS ac, covar_pop(l_linenumber, l_linenumber) AS bb,
 covar_pop(l_linenumber, l_suppkey) AS bc, covar_pop(l_suppkey, l_suppkey) AS cc, covar_pop(l_quantity, l_extendedprice) AS ay, covar_pop(l_linenumber, l_extendedprice) AS b_y,
 covar_pop(l_suppkey, l_extendedprice) AS cy, avg(l_quantity) AS ma, avg(l_linenumber) AS mb, avg(l_suppkey) AS mc, avg(l_extendedprice) AS my FROM lineitem),
e AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM c),
ols AS (SELECT (ay * (bb * cc - bc * bc) - ab * (b_y * cc - bc * cy) + ac * (b_y * bc - bb * cy)) / det AS wa, (aa * (b_y * cc - cy * bc) - ay * (ab * cc - bc * ac) + ac * (ab * cy - b_y * ac)) / det AS wb,
 (aa * (bb * cy - bc * b_y) - ab * (ab * cy - b_y * ac) + ay * (ab * bc - bb * ac)) / det AS wc, ma, mb, mc, my FROM e)"""


def _moved_sql(seed: int = 42) -> str:
    """Rows with the value that each input gets from the permutation of its column."""
    n = "SELECT count(*) FROM lineitem"
    perms = ",\n".join(permutation_sql(f"m{i}", n, seed + i) for i in range(3))
    return f"""{perms},
r AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}) - 1 AS p FROM lineitem),
z AS (SELECT r.*, qa.l_quantity AS pa, qb.l_linenumber AS pb, qc.l_suppkey AS pc FROM r JOIN m0 ON m0.v = r.p JOIN r qa ON qa.p = m0.p JOIN m1 ON m1.v = r.p JOIN r qb ON qb.p = m1.p
 JOIN m2 ON m2.v = r.p JOIN r qc ON qc.p = m2.p)"""


def _perturb_sql() -> str:
    miss = "l_extendedprice - my - wa * ({a} - ma) - wb * ({b} - mb) - wc * ({c} - mc)"
    cols = {"a": "l_quantity", "b": "l_linenumber", "c": "l_suppkey"}
    one = lambda k, new: miss.format(**{**cols, k: new})
    return f"""{_OLS}, {_moved_sql()},
q AS (SELECT avg(pow({one('a', 'pa')}, 2)) AS ea, avg(pow({one('b', 'pb')}, 2)) AS eb, avg(pow({one('c', 'pc')}, 2)) AS ec FROM z, ols),
perturb AS (SELECT 'l_quantity' AS name, ea AS error FROM q UNION ALL SELECT 'l_linenumber', eb FROM q UNION ALL SELECT 'l_suppkey', ec FROM q)"""


@query("imp_perturb", f"""WITH RECURSIVE {_perturb_sql()}
SELECT name, round(error / 1e6, 4) AS error, round(error / (SELECT max(error) FROM perturb), 7) AS importance FROM perturb""")
def _(t):
    rows, model = _linear(t)
    error = F.pow(F.col("prediction") - F.col("l_extendedprice"), 2.0)
    rank = RK.perturbation_rank(rows, FEATURES, model.transform, error, order=ORDER)
    return rank.select("name", F.round(F.col("error") / 1e6, 4).alias("error"), F.round("importance", 7).alias("importance"))


_SIGMOID = "1 / (1 + exp(-(0.08::double * ({a} - 25) - 0.2::double * ({b} - 4) + 0.001::double * {c})))"


@query("imp_perturb_classes", f"""WITH RECURSIVE {_moved_sql(7)},
s AS (SELECT CASE WHEN l_extendedprice > 30000 THEN 1 ELSE 0 END AS y, {_SIGMOID.format(a='pa', b='l_linenumber', c='l_suppkey')} AS qa,
 {_SIGMOID.format(a='l_quantity', b='pb', c='l_suppkey')} AS qb, {_SIGMOID.format(a='l_quantity', b='l_linenumber', c='pc')} AS qc FROM z),
e AS (SELECT 'l_quantity' AS name, avg(-ln(CASE WHEN y = 1 THEN qa ELSE 1 - qa END)) AS error FROM s UNION ALL
 SELECT 'l_linenumber', avg(-ln(CASE WHEN y = 1 THEN qb ELSE 1 - qb END)) FROM s UNION ALL SELECT 'l_suppkey', avg(-ln(CASE WHEN y = 1 THEN qc ELSE 1 - qc END)) FROM s)
SELECT name, round(error, 7) AS error, round(error / (SELECT sum(error) FROM e), 7) AS importance FROM e""")
def _(t):
    """A caller's classifier, scored by log loss; importances sum to 1."""
    a, b, c = (F.col(f) for f in FEATURES)
    rows = t.lineitem.select(*ORDER, (F.col("l_extendedprice") > 30000).cast("int").alias("y"))
    odds = 0.08 * (a - 25) - 0.2 * (b - 4) + 0.001 * c
    rank = RK.perturbation_rank(rows, FEATURES, lambda x: x.withColumn("p", 1 / (1 + F.exp(-odds))), RK.row_log_loss("y", "p"), seed=7, to_sum=True, order=ORDER)
    return rank.select("name", F.round("error", 7).alias("error"), F.round("importance", 7).alias("importance"))


def _linear(t: Tables):
    from tabloom.operators.models import pipeline
    from pyspark.ml.regression import LinearRegression

    rows = t.lineitem.select(*ORDER)
    return rows, pipeline(LinearRegression(labelCol="l_extendedprice"), FEATURES).fit(rows)


def _extra_trees_sql(trees: int, depth: int, names: list[str], y: str) -> str:
    """The levels written out one after another, with the same draws."""
    n = len(names)
    out = [f"d AS (SELECT {', '.join(f'{c}::double AS x{i}' for i, c in enumerate(names))}, {y} - (SELECT avg({y}) FROM lineitem) AS y FROM lineitem)",
           f"a0 AS (SELECT t.t, 1 AS node, d.* FROM d, range({trees}) t(t))"]
    for level in range(depth):
        ranges = ", ".join(f"min(x{i}) AS lo{i}, max(x{i}) AS hi{i}" for i in range(n))
        cuts = ", ".join(f"CASE WHEN lo{i} < hi{i} THEN lo{i} + {uniform_sql(0, 't', 'node', str(i))} * (hi{i} - lo{i}) END AS c{i}" for i in range(n))
        lefts = ", ".join(f"count(*) FILTER (x{i} <= c{i}) AS l{i}, coalesce(sum(a.y) FILTER (x{i} <= c{i}), 0) AS s{i}" for i in range(n))
        rows = " UNION ALL ".join(f"SELECT t, node, {i} AS f, c{i} AS cut, s{i} * s{i} / l{i} + (s - s{i}) * (s - s{i}) / (n - l{i}) - s * s / n AS gain FROM v{level} WHERE l{i} > 0 AND l{i} < n"
                                  for i in range(n))
        value = "CASE f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(n)) + " END"
        out += [f"w{level} AS (SELECT t, node, count(*) AS n, sum(y) AS s, {ranges} FROM a{level} GROUP BY t, node HAVING count(*) >= 2)",
                f"k{level} AS MATERIALIZED (SELECT t, node, n, s, {cuts} FROM w{level})",
                f"v{level} AS MATERIALIZED (SELECT k.*, l.* EXCLUDE (t, node) FROM k{level} k JOIN (SELECT a.t, a.node, {lefts} FROM a{level} a JOIN k{level} k ON a.t = k.t AND a.node = k.node GROUP BY a.t, a.node) l ON k.t = l.t AND k.node = l.node)",
                f"b{level} AS MATERIALIZED (SELECT t, node, arg_max(f, gain) AS f, arg_max(cut, gain) AS cut, max(gain) AS gain FROM ({rows}) GROUP BY t, node HAVING max(gain) > 1e-12 * (SELECT sum(y * y) FROM d))",
                f"a{level + 1} AS MATERIALIZED (SELECT a.t, 2 * a.node + ({value} > cut)::INT AS node, {', '.join(f'x{i}' for i in range(n))}, y FROM a{level} a JOIN b{level} b ON a.t = b.t AND a.node = b.node)"]
    splits = " UNION ALL ".join(f"SELECT t, f, gain FROM b{level}" for level in range(depth))
    labels = ", ".join(f"({i}, '{c}')" for i, c in enumerate(names))
    return f"""WITH {', '.join(out)}, g AS ({splits}), tot AS (SELECT t, sum(gain) AS total FROM g GROUP BY t),
e AS (SELECT f, sum(gain / total) / (SELECT count(*) FROM tot) AS importance, count(*) AS splits FROM g JOIN tot USING (t) GROUP BY f)
SELECT name, round(coalesce(importance, 0), 6) AS importance, coalesce(splits, 0) AS splits FROM (VALUES {labels}) v(i, name) LEFT JOIN e ON e.f = v.i"""


@query("imp_forest", _extra_trees_sql(50, 3, FEATURES, "l_extendedprice"))
def _(t):
    from tabloom.operators.extra_trees import fit_extra_trees

    forest = fit_extra_trees(t.lineitem, FEATURES, "l_extendedprice", trees=50, depth=3)
    splits = forest.nodes.groupBy("feature").agg(F.count("*").alias("splits"))
    names = t.spark.createDataFrame(list(enumerate(FEATURES)), "feature int, name string")
    counted = names.join(splits, "feature", "left").select("name", F.coalesce("splits", F.lit(0)).cast("long").alias("splits"))
    return _round(forest.importances(), 6, "importance").join(counted, "name")


_WEIGHTS = """weights AS (SELECT unnest(['l_quantity', 'l_linenumber', 'l_suppkey']) AS name, unnest([abs(wa), abs(wb), abs(wc)]) / (abs(wa) + abs(wb) + abs(wc)) AS w FROM ols)"""


@query("imp_weight", f"WITH {_OLS}, {_WEIGHTS} SELECT name, round(w, 7) AS importance FROM weights")
def _(t):
    _, model = _linear(t)
    rank = RK.weight_rank(t.spark, FEATURES, [[w] for w in model.stages[-1].coefficients.toArray()])
    return _round(rank, 7, "importance")


@query("imp_hybrid", f"""WITH RECURSIVE {_perturb_sql()}, {_WEIGHTS},
k AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS a, abs(corr(l_linenumber, l_extendedprice)) AS b, abs(corr(l_suppkey, l_extendedprice)) AS c FROM lineitem),
corrs AS (SELECT unnest(['l_quantity', 'l_linenumber', 'l_suppkey']) AS name, unnest([a, b, c]) / (a + b + c) AS c FROM k),
shares AS (SELECT name, error / (SELECT sum(error) FROM perturb) AS p FROM perturb),
raw AS (SELECT name, w + p * 0.25 + c * 0.75 AS raw FROM weights JOIN shares USING (name) JOIN corrs USING (name))
SELECT name, round(raw / (SELECT sum(raw) FROM raw), 7) AS importance FROM raw""")
def _(t):
    rows, model = _linear(t)
    weights = RK.weight_rank(t.spark, FEATURES, [[w] for w in model.stages[-1].coefficients.toArray()])
    error = F.pow(F.col("prediction") - F.col("l_extendedprice"), 2.0)
    perturb = RK.perturbation_rank(rows, FEATURES, model.transform, error, to_sum=True, order=ORDER)
    return _round(RK.hybrid_rank(weights, perturb, RK.corr_rank(rows, FEATURES, "l_extendedprice"), d=0.25), 7, "importance")


def _stability_sql(kind: str) -> str:
    """The gradient steps as a recursive query over the moments of standardised columns."""
    names = ["a", "b", "c"]
    z = lambda c, t="lineitem": f"(({c}) - (SELECT avg({c}) FROM {t})) / (SELECT stddev_pop({c}) FROM {t})"
    grown = ", ".join(f"w{x} + (g{x} - ({' + '.join(f'w{o} * r{min(x, o)}{max(x, o)}' for o in names)})) / 3" for x in names)
    error = lambda i: "1 - 2 * (" + " + ".join(f"w{x} * {f'p{i}y' if x == i else f'g{x}'}" for x in names) + ") + " + " + ".join(
        f"w{x} * w{o} * {f'r{min(x, o)}{max(x, o)}' if (x == i) == (o == i) else f'p{i}{o if x == i else x}'}" for x in names for o in names)
    moments = ", ".join([*[f"avg(z{x} * z{o}) AS r{x}{o}" for i, x in enumerate(names) for o in names[i:]], *[f"avg(z{x} * zy) AS g{x}" for x in names],
                         *[f"avg(q{x} * z{o}) AS p{x}{o}" for x in names for o in names if o != x], *[f"avg(q{x} * zy) AS p{x}y" for x in names]])
    value = {"weight": lambda x: f"abs(w{x}) / nullif(tw, 0)", "perturb": lambda x: f"e{x} / te",
             "hybrid": lambda x: f"(abs(w{x}) / nullif(tw, 0) + 0.5 * e{x} / te + 0.5 * abs(g{x}) / tg) / 2"}
    gap = " + ".join(f"pow({value[kind](x)} - b{x}, 2)" for x in names)
    return f"""WITH RECURSIVE {_moved_sql()},
s AS (SELECT avg(l_quantity) AS ma, stddev_pop(l_quantity) AS sa, avg(l_linenumber) AS mb, stddev_pop(l_linenumber) AS sb, avg(l_suppkey) AS mc, stddev_pop(l_suppkey) AS sc,
 avg(l_extendedprice) AS my, stddev_pop(l_extendedprice) AS sy FROM lineitem),
zz AS (SELECT (l_quantity - ma) / sa AS za, (l_linenumber - mb) / sb AS zb, (l_suppkey - mc) / sc AS zc, (l_extendedprice - my) / sy AS zy, (pa - ma) / sa AS qa, (pb - mb) / sb AS qb, (pc - mc) / sc AS qc FROM z, s),
m AS (SELECT {moments} FROM zz),
t(n, wa, wb, wc) AS (SELECT 0, 0.0::double, 0.0::double, 0.0::double UNION ALL SELECT n + 1, {grown} FROM t, m WHERE n < 500),
x AS (SELECT t.*, m.*, abs(wa) + abs(wb) + abs(wc) AS tw, abs(ga) + abs(gb) + abs(gc) AS tg, {', '.join(f'{error(i)} AS e{i}' for i in names)} FROM t, m),
y AS (SELECT *, ea + eb + ec AS te FROM x), base AS (SELECT abs(wa) / tw AS ba, abs(wb) / tw AS bb, abs(wc) / tw AS bc FROM x WHERE n = 500)
SELECT n AS length, round(sqrt({gap}), 7) AS distance FROM y, base WHERE n BETWEEN 1 AND 20"""


@query("imp_stability", _stability_sql("weight"))
def _(t):
    return _round(RK.rank_stability(t.lineitem, FEATURES, "l_extendedprice", range(1, 21), order=ORDER), 7, "distance")


@query("imp_stability_perturb", _stability_sql("perturb"))
def _(t):
    return _round(RK.rank_stability(t.lineitem, FEATURES, "l_extendedprice", range(1, 21), kind="perturb", order=ORDER), 7, "distance")


@query("imp_stability_hybrid", _stability_sql("hybrid"))
def _(t):
    return _round(RK.rank_stability(t.lineitem, FEATURES, "l_extendedprice", range(1, 21), kind="hybrid", order=ORDER), 7, "distance")
