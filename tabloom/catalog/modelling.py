"""MLlib training and scoring, forecasts, fuzzy clustering and rating."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.catalog.registry import Tables, query
from tabloom.catalog.series import daily_flag
from tabloom.operators import models as MD, timeseries as TS
from tabloom.operators.boosting import fit_boosted


def _passengers(t: Tables) -> DataFrame:
    """A survival style table: label from a noisy rule over mixed columns with gaps."""
    bal = F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal"))
    label = (F.col("c_acctbal") / 10000 + (F.xxhash64("c_custkey") % 100) / 400 > 0.4).cast("double")
    return t.customer.select("c_custkey", bal.alias("bal"), "c_mktsegment", F.col("c_nationkey").cast("double").alias("nation"), label.alias("label"))


def _share(condition):
    return F.avg(condition.cast("int"))


@query("ml_logistic", "SELECT count(*) AS n, round(avg((c_acctbal IS NOT NULL)::INT), 3) AS rows_share, true AS beats_majority FROM customer")
def _(t):
    """At the likelihood's maximum the mean probability is the share of ones; ``rows_share`` is their ratio."""
    from pyspark.ml.functions import vector_to_array
    from tabloom.operators.features import encode_dummy, impute_median

    rows = encode_dummy(impute_median(_passengers(t), ["bal"]), "c_mktsegment", drop_first=True)
    names = [c for c in rows.columns if c not in ("c_custkey", "label")]
    model = MD.fit_logistic(rows, names, "label", maxIter=200, tol=1e-10)
    scored = model.transform(rows).withColumn("p", vector_to_array("probability")[1])
    ones = _share(F.col("label") == 1)
    return scored.agg(F.count("*").alias("n"), F.round(F.avg("p") / ones, 3).alias("rows_share"),
                      (_share(F.col("label") == F.col("prediction")) >= F.greatest(ones, 1 - ones)).alias("beats_majority"))


@query("ml_forest_clf", "SELECT count(*) AS n, round(avg((c_acctbal > 2750)::INT), 9) AS above, true AS reaches_rule FROM customer")
def _(t):
    """Against the best single threshold, known here as the labels are made of the balance and noise."""
    rows = _passengers(t).na.fill(0.0, ["bal"]).join(t.customer.select("c_custkey", "c_acctbal"), "c_custkey")
    model = MD.fit_forest(rows, ["bal", "nation"], "label", ["c_mktsegment"], trees=50, seed=0)
    above = (F.col("c_acctbal") > 2750).cast("double")
    return model.transform(rows).agg(F.count("*").alias("n"), F.round(F.avg(above), 9).alias("above"),
                                     (_share(F.col("label") == F.col("prediction")) >= _share(F.col("label") == above) - 0.06).alias("reaches_rule"))


# what no function of the two inputs can explain: the variance inside their cells
_FLOOR = """(WITH c AS (SELECT l_extendedprice AS y, avg(l_extendedprice) OVER (PARTITION BY l_quantity, l_linenumber) AS m FROM lineitem)
SELECT count(*) AS n, round(1 - avg(pow(y - m, 2)) / var_pop(y), 8) AS best_r2 FROM c)"""
INPUTS = ["l_quantity", "l_linenumber"]


def _against_floor(t: Tables, scored: DataFrame, *more) -> DataFrame:
    """Determination of the predictions next to that of the cell means."""
    cells = t.lineitem.groupBy(*INPUTS).agg(F.count("*").alias("n"), F.avg("l_extendedprice").alias("m"), F.var_pop("l_extendedprice").alias("v"))
    whole = t.lineitem.agg(F.var_pop("l_extendedprice").alias("v")).first()["v"]
    best = cells.agg(F.sum("n").alias("n"), (1 - F.sum(F.col("n") * F.col("v")) / F.sum("n") / F.lit(whole)).alias("r2")).first()
    d = F.col("l_extendedprice") - F.col("prediction")
    return scored.agg(F.count("*").alias("n"), F.round(F.lit(best["r2"]), 8).alias("best_r2"), (1 - F.avg(d * d) / F.lit(whole) > best["r2"] - 0.02).alias("near_best"), *more)


@query("ml_forest_reg", f"SELECT n, best_r2, true AS near_best FROM {_FLOOR}")
def _(t):
    model = MD.fit_forest_reg(t.lineitem, INPUTS, "l_extendedprice", trees=100, maxDepth=20)
    return _against_floor(t, model.transform(t.lineitem))


@query("ml_gbt", f"SELECT n, best_r2, true AS near_best, round((SELECT avg(l_extendedprice) FROM lineitem), 4) AS mean_prediction, 101::BIGINT AS history, true AS falls FROM {_FLOOR}")
def _(t):
    """100 rounds; without a penalty the mean prediction is the mean of the target, and the loss falls in every round."""
    model = fit_boosted(t.lineitem, INPUTS, "l_extendedprice", rounds=100, depth=2)
    out = _against_floor(t, model.predict(t.lineitem), F.round(F.avg("prediction"), 4).alias("mean_prediction"))
    history = model.history_table(t.spark)
    before = history.select((F.col("round") + 1).alias("round"), F.col("train").alias("before"))
    falls = history.join(before, "round").agg(F.bool_and(F.col("train") <= F.col("before") * (1 + 1e-9)).alias("falls")).first()["falls"]
    return out.withColumns({"history": F.lit(history.count()).cast("long"), "falls": F.lit(falls)})


@query("ml_gbt_classes", """SELECT count(*) AS n, round(avg((c_acctbal < 1000)::INT), 9) AS low, true AS learned, true AS held_out_falls, true AS stopped_or_done FROM customer""")
def _(t):
    """Softmax with a held-out quarter: three classes that repeat along the balance."""
    rows = t.customer.select("c_custkey", F.col("c_acctbal").alias("x"), F.pmod(F.floor(F.col("c_acctbal") / 1000), F.lit(3)).cast("int").alias("label"))
    model = fit_boosted(rows, ["x"], "label", classes=[0, 1, 2], held_out=F.col("c_custkey") % 4 == 0, rounds=100, depth=2, patience=10)
    scored = model.predict(rows)
    evals = [h[2] for h in model.history]
    return scored.agg(F.count("*").alias("n"), F.round(_share(F.col("x") < 1000), 9).alias("low"),
                      (_share(F.when(F.col("c_custkey") % 4 == 0, F.col("label") == F.col("prediction"))) > 0.85).alias("learned"),
                      F.lit(min(evals) < 0.5 * evals[0]).alias("held_out_falls"), F.lit(len(model.trees) == 100 or len(model.trees) - model.best_round == 10).alias("stopped_or_done"))


@query("ml_grid", """WITH o AS (SELECT var_pop(l_quantity) AS a, covar_pop(l_quantity, l_linenumber) AS b, var_pop(l_linenumber) AS d, covar_pop(l_quantity, l_extendedprice) AS e, covar_pop(l_linenumber, l_extendedprice) AS f,
 var_pop(l_extendedprice) AS v FROM lineitem)
SELECT 4 AS candidates, round(sqrt(v - (e * (e * d - b * f) + f * (a * f - b * e)) / (a * d - b * b)), 4) AS least_rmse, 1.0::DOUBLE AS ratio FROM o""")
def _(t):
    """The best cross-validated error against that of least squares on all rows."""
    search = MD.grid_search(t.lineitem.select("l_quantity", "l_linenumber", "l_extendedprice"), ["l_quantity", "l_linenumber"],
                            "l_extendedprice", {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.5]}, folds=5)
    c = t.lineitem.agg(F.var_pop("l_quantity").alias("a"), F.covar_pop("l_quantity", "l_linenumber").alias("b"), F.var_pop("l_linenumber").alias("d"), F.covar_pop("l_quantity", "l_extendedprice").alias("e"),
                       F.covar_pop("l_linenumber", "l_extendedprice").alias("f"), F.var_pop("l_extendedprice").alias("v"))
    least = c.select(F.expr("sqrt(v - (e * (e * d - b * f) + f * (a * f - b * e)) / (a * d - b * b))").alias("least"))
    scores = search.avgMetrics
    return least.select(F.lit(len(scores)).alias("candidates"), F.round("least", 4).alias("least_rmse"), F.round(F.lit(min(scores)) / F.col("least"), 1).alias("ratio"))


def _windows(t: Tables) -> DataFrame:
    rows = TS.calendar_features(daily_flag(t), "date").select("flag", "date", "sales", "dow", "doy")
    made = TS.supervised(rows, ["flag"], ["date"], ["sales"], window=29, lag=30)
    return made.join(rows.select("flag", "date", "dow", "doy"), ["flag", "date"])


@query("ml_linear_forecast", """WITH d AS (SELECT l_returnflag, l_shipdate, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
w AS (SELECT row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate) AS i, lead(q, 30) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate) AS ahead FROM d)
SELECT count(*) AS n, round(avg(ahead), 5) AS mean_prediction, true AS beats_naive FROM w WHERE i > 29 AND ahead IS NOT NULL""")
def _(t):
    """Least squares with an intercept: the mean prediction is the mean of what came."""
    windows = _windows(t)
    model, label = MD.fit_demand(windows, "sales", 29, 30, ["dow", "doy"])
    scored = MD.score_demand(model, windows)
    ours, naive = F.col("prediction") - F.col(label), F.col("sales_now") - F.col(label)
    return scored.agg(F.count("*").alias("n"), F.round(F.avg("prediction"), 5).alias("mean_prediction"), (F.avg(ours * ours) < F.avg(naive * naive)).alias("beats_naive"))


@query("ml_seasonal_forecast", """WITH d AS (SELECT l_returnflag AS f, l_shipdate AS d, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), g AS (SELECT f, min(d) AS lo, max(d) AS hi, round(avg(q), 1) AS mean FROM d GROUP BY f)
SELECT f AS series, date_diff('day', lo, hi) + 366 AS days, 365::BIGINT AS future, true AS ordered, true AS mean_kept, true AS beats_mean FROM g""")
def _(t):
    """History and a year ahead; the fit keeps the mean of the series to a hundredth of it and beats it as a forecast."""
    series = daily_flag(t)
    out = MD.seasonal_forecast(series, "flag", "date", "sales", 365)
    both = out.join(series.select(F.col("flag").cast("string").alias("series"), "date", "sales"), ["series", "date"], "left")
    d = F.col("yhat") - F.col("sales")
    return both.groupBy("series").agg(
        F.count("*").alias("days"), F.count_if("future").alias("future"),
        F.bool_and((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))).alias("ordered"),
        (F.abs(F.avg(d)) < 0.01 * F.avg("sales")).alias("mean_kept"), (F.avg(d * d) < F.var_pop("sales")).alias("beats_mean"))


@query("ml_change_points", """SELECT l_returnflag AS series, 25::BIGINT AS candidates, true AS inside FROM lineitem GROUP BY 1""")
def _(t):
    bends = MD.seasonal_forecast(daily_flag(t), "flag", "date", "sales", 1, weights=True)
    span = daily_flag(t).groupBy(F.col("flag").cast("string").alias("series")).agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return bends.join(span, "series").groupBy("series").agg(F.count("*").alias("candidates"), F.bool_and((F.col("change") > F.col("lo")) & (F.col("change") < F.col("hi"))).alias("inside"))


@query("ml_mlp", """WITH c AS (SELECT CASE WHEN c_acctbal < 3000 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END AS k FROM customer)
SELECT sum(m)::BIGINT AS n, round(max(m) / sum(m), 9) AS majority, true AS beats_majority FROM (SELECT k, count(*) AS m FROM c GROUP BY k)""")
def _(t):
    x = F.col("c_acctbal") / 10000
    rows = t.customer.select(x.alias("a"), (x * x).alias("b"), F.when(F.col("c_acctbal") < 3000, 0.0).when(F.col("c_acctbal") < 6000, 1.0).otherwise(2.0).alias("label"))
    scored = MD.fit_mlp(rows, ["a", "b"], "label", 3, rounds=200, seed=1).transform(rows)
    majority = F.greatest(*[_share(F.col("label") == k) for k in range(3)])
    return scored.agg(F.count("*").alias("n"), F.round(majority, 9).alias("majority"), (_share(F.col("label") == F.col("prediction")) > majority + 0.1).alias("beats_majority"))


@query("ml_two_cluster", "SELECT count(*) AS n, count(*) FILTER (o_totalprice > 250000) AS expensive, true AS separates FROM orders")
def _(t):
    """A forest learned on three quarters names the expensive orders: their number, and that of the predictions within a hundredth of all rows."""
    rows = t.orders.select(F.col("o_totalprice").alias("x"), (F.col("o_totalprice") > 250000).cast("double").alias("label"))
    train = rows.filter(F.pmod(F.xxhash64("x"), F.lit(4)) > 0)
    scored = MD.fit_forest(train, ["x"], "label", trees=50).transform(rows)
    one, said = F.count_if(F.col("label") == 1), F.count_if(F.col("prediction") == 1)
    return scored.agg(F.count("*").alias("n"), one.alias("expensive"), ((F.abs(one - said) <= F.count("*") * 0.01) & (_share(F.col("label") == F.col("prediction")) > 0.98)).alias("separates"))


def _cmeans_sql(counts: range, rounds: int) -> str:
    """All models for a fixed number of rounds, written out one after another."""
    steps = []
    for i in range(rounds):
        steps.append(f"""n{i} AS (SELECT c, k, p, x, y, 1 / greatest(pow(x - cx, 2) + pow(y - cy, 2), 1e-16) AS w FROM d JOIN m{i} ON true),
u{i} AS MATERIALIZED (SELECT c, k, x, y, w / sum(w) OVER (PARTITION BY c, p) AS u FROM n{i}),
m{i + 1} AS MATERIALIZED (SELECT c, k, sum(u * u * x) / sum(u * u) AS cx, sum(u * u * y) / sum(u * u) AS cy FROM u{i} GROUP BY c, k),""")
    return f"""WITH d AS (SELECT p_partkey AS p, p_size::DOUBLE AS x, p_retailprice / 20 AS y FROM part),
s AS (SELECT row_number() OVER (ORDER BY p) - 1 AS k, x AS cx, y AS cy FROM d), m0 AS (SELECT c, k, cx, cy FROM s, range({counts.start}, {counts.stop}) r(c) WHERE k < c),
{' '.join(steps)}
f AS (SELECT c, sum(u * u) / (SELECT count(*) FROM d) AS coefficient FROM u{rounds - 1} GROUP BY c)
SELECT c::INT AS c, round(coefficient, 7) AS coefficient, {rounds} AS rounds FROM f"""


@query("ml_fuzzy_coefficients", _cmeans_sql(range(2, 11), 6))
def _(t):
    """The partition coefficient for 2 to 10 centres, from the same six scans."""
    rows = t.part.select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") / 20).alias("y"))
    start = [(r["x"], r["y"]) for r in rows.orderBy("p_partkey").limit(10).collect()]
    out = MD.partition_coefficients(rows, ["x", "y"], range(2, 11), tol=0.0, max_iter=6, start=start)
    return out.withColumn("coefficient", F.round("coefficient", 7))


@query("ml_fuzzy_cmeans", "SELECT p_partkey, true AS sums_to_one, true AS converged FROM part")
def _(t):
    rows = t.part.select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") / 20).alias("y"))
    centers, fpc, rounds = MD.fuzzy_cmeans(rows, ["x", "y"], 3)
    out = MD.fuzzy_assign(rows, ["x", "y"], centers)
    total = F.aggregate("membership", F.lit(0.0), lambda a, v: a + v)
    return out.select("p_partkey", ((F.abs(total - 1) < 1e-9) & F.col("cluster").between(0, 2)).alias("sums_to_one"),
                      F.lit(rounds < 1000).alias("converged"))


@query("ml_fuzzy_score", """WITH a AS (SELECT p_partkey, 15 + p_size / 2 AS bmi, 4 + p_partkey % 4 AS a1c, p_partkey % 30 AS bp FROM part),
m AS (SELECT p_partkey, greatest(exp(-pow((bmi - 9.25) / 3.0, 2) / 2), exp(-pow((bmi - 35.0) / 3.0, 2) / 2), greatest(0, 1 - abs(a1c - 4) / 5.0)) AS dc,
 greatest(exp(-pow((bmi - 27.5) / 3.0, 2) / 2), greatest(0, 1 - abs(a1c - 5.25) / 5.0), exp(-pow((bp - 10) / 2.5, 2) / 2)) AS st,
 least(exp(-pow((bmi - 21.75) / 3.0, 2) / 2), greatest(0, 1 - abs(a1c - 5.25) / 5.0), exp(-pow((bp - 0) / 2.5, 2) / 2)) AS pf FROM a),
u AS (SELECT i / 10.0::DOUBLE AS x FROM range(401) r(i)),
h AS (SELECT p_partkey, x, greatest(least(dc, greatest(0, 1 - abs(x - 10) / 5)), least(st, greatest(0, 1 - abs(x - 5) / 5)), least(pf, greatest(0, 1 - abs(x - 1) / 5))) AS h FROM m, u)
SELECT p_partkey, round(sum(x * h) / sum(h), 6) AS rating FROM h GROUP BY 1""")
def _(t):
    rows = t.part.select("p_partkey", (15 + F.col("p_size") / 2).alias("bmi"), (4 + F.col("p_partkey") % 4).alias("a1c"), (F.col("p_partkey") % 30).alias("bp"))
    return MD.fuzzy_rating(rows).select("p_partkey", F.round("rating", 6).alias("rating"))
