"""Time series and window jobs: events as station readings and ticks, lineitem as sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.catalog.registry import Tables, query
from tabloom.operators import timeseries as TS

DAILY = "SELECT l_partkey AS item, l_shipdate AS date, sum(l_quantity) AS sales FROM lineitem GROUP BY 1, 2"
DAY = "SELECT l_returnflag AS flag, l_shipdate AS date, sum(l_quantity) AS sales FROM lineitem GROUP BY 1, 2"


def daily(t: Tables) -> DataFrame:
    """Sales per item and date."""
    return t.lineitem.groupBy(F.col("l_partkey").alias("item"), F.col("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("sales"))


def daily_flag(t: Tables) -> DataFrame:
    """A few long series: totals per return flag and date."""
    return t.lineitem.groupBy(F.col("l_returnflag").alias("flag"), F.col("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("sales"))


@query("win_diff", "SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_diff FROM events")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return TS.diff_prev(rows, ["user_id"], ["ts", "event_id"], ["value"]).select("event_id", "value_diff")


@query("win_shift", """SELECT event_id, lag(value, 2) OVER w AS back, lead(value, 3) OVER w AS ahead FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    back = TS.shift(rows, ["user_id"], ["ts", "event_id"], ["value"], 2).withColumnRenamed("value_shift", "back")
    return TS.shift(back, ["user_id"], ["ts", "event_id"], ["value"], -3).select(
        "event_id", "back", F.col("value_shift").alias("ahead"))


_SUPERVISED = f"""SELECT item, date, lag(sales, 3) OVER w AS "sales(t-3)", lag(sales, 2) OVER w AS "sales(t-2)", lag(sales, 1) OVER w AS "sales(t-1)",
sales AS "sales(t)", lead(sales, 2) OVER w AS "sales(t+2)" FROM ({DAILY}) WINDOW w AS (PARTITION BY item ORDER BY date)"""


@query("win_supervised", f"""SELECT * FROM ({_SUPERVISED}) WHERE "sales(t-3)" IS NOT NULL AND "sales(t+2)" IS NOT NULL""")
def _(t):
    return TS.supervised(daily(t), ["item"], ["date"], ["sales"], window=3, lag=2)


@query("win_edge_filter", f"""SELECT item, count(*) - 5 AS windows FROM ({DAILY}) GROUP BY 1 HAVING count(*) > 5""")
def _(t):
    made = TS.supervised(daily(t), ["item"], ["date"], ["sales"], window=3, lag=2)
    return made.groupBy("item").agg(F.count("*").alias("windows"))


@query("win_tensor", f"""SELECT item, date, [["sales(t-3)"], ["sales(t-2)"], ["sales(t-1)"], ["sales(t)"]] AS tensor FROM ({_SUPERVISED}) WHERE "sales(t-3)" IS NOT NULL AND "sales(t+2)" IS NOT NULL""")
def _(t):
    made = TS.supervised(daily(t), ["item"], ["date"], ["sales"], window=3, lag=2)
    return TS.stack_sequences(made, ["sales"], 3).select("item", "date", "tensor")


_RESAMPLE = """WITH d AS (SELECT user_id, date_trunc('day', ts) AS period, max(value) AS top FROM events GROUP BY 1, 2),
c AS (SELECT user_id, unnest(generate_series(min(period), max(period), INTERVAL 1 DAY)) AS period FROM d GROUP BY 1)
SELECT c.user_id, c.period, d.top FROM c LEFT JOIN d USING (user_id, period)"""


def _per_day(t: Tables) -> DataFrame:
    return TS.resample(t.events, ["user_id"], "ts", "1 day", {"top": F.max("value")})


@query("ts_resample_max", _RESAMPLE)
def _(t):
    return _per_day(t)


@query("ts_bfill", f"""SELECT user_id, period, first_value(top IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS top FROM ({_RESAMPLE})""")
def _(t):
    return TS.bfill(_per_day(t), ["user_id"], ["period"], ["top"])


@query("ts_month_mean", "SELECT month(o_orderdate)::INT AS month, avg(o_custkey) AS mean FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1")
def _(t):
    return TS.month_mean(t.orders, "o_orderdate", 1997, "o_custkey")


@query("ts_ohlc", """WITH b AS (SELECT date_trunc('hour', ts) AS period, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close FROM events GROUP BY 1),
c AS (SELECT unnest(generate_series(min(period), max(period), INTERVAL 1 HOUR)) AS period FROM b)
SELECT period, open, high, low, close FROM c LEFT JOIN b USING (period)""")
def _(t):
    return TS.ohlc(t.events, "ts", "value", "1 hour", "event_id")


@query("ts_rolling_time", """SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '2 days 23:59:59.999999' PRECEDING AND CURRENT ROW) AS rolled FROM events""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return TS.rolling(rows, ["user_id"], "ts", "3 days", "value").select("event_id", "rolled")


@query("ts_sma", "SELECT event_id, avg(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS sma FROM events")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts")
    return TS.sma(rows, ["user_id"], ["ts", "event_id"], "event_id", 5).select("event_id", "sma")


@query("ts_detrend", """WITH n AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events),
l AS (SELECT user_id, regr_slope(value, i) AS a, regr_intercept(value, i) AS b FROM n GROUP BY 1)
SELECT event_id, round(value - coalesce(a * i + b, value), 6) AS detrended FROM n JOIN l USING (user_id)""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = TS.detrend(rows, ["user_id"], ["ts", "event_id"], "value")
    return out.select("event_id", F.round("detrended", 6).alias("detrended"))


_DECOMPOSE = f"""WITH s AS (SELECT *, row_number() OVER w AS rn, CASE WHEN count(*) OVER f = 7 THEN avg(sales) OVER f END AS trend FROM ({DAY})
 WINDOW w AS (PARTITION BY flag ORDER BY date), f AS (PARTITION BY flag ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
p AS (SELECT flag, (rn - 1) % 7 AS phase, avg(sales / trend) AS m FROM s GROUP BY 1, 2),
q AS (SELECT flag, phase, m / avg(m) OVER (PARTITION BY flag) AS seasonal FROM p)
SELECT s.flag, s.date, s.sales, s.trend, q.seasonal, s.sales / s.trend / q.seasonal AS resid FROM s JOIN q ON s.flag = q.flag AND (s.rn - 1) % 7 = q.phase"""


def _decomposed(t: Tables) -> DataFrame:
    return TS.seasonal_decompose(daily_flag(t), ["flag"], ["date"], "sales", 7)


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 7) for c in cols})


@query("ts_decompose", f"SELECT flag, date, sales, round(trend, 7) AS trend, round(seasonal, 7) AS seasonal, round(resid, 7) AS resid FROM ({_DECOMPOSE})")
def _(t):
    return _rounded(_decomposed(t).select("flag", "date", "sales", "trend", "seasonal", "resid"), "trend", "seasonal", "resid")


@query("ts_deseason", f"SELECT flag, date, round(sales / seasonal / trend, 7) AS adjusted FROM ({_DECOMPOSE}) WHERE trend IS NOT NULL")
def _(t):
    out = TS.deseasonalize(daily_flag(t), _decomposed(t), ["flag", "date"], "sales")
    return _rounded(out.select("flag", "date", "adjusted"), "adjusted")


@query("ts_reseason", f"SELECT flag, date, round(sales, 6) AS restored FROM ({_DECOMPOSE}) WHERE trend IS NOT NULL")
def _(t):
    out = TS.deseasonalize(daily_flag(t), _decomposed(t), ["flag", "date"], "sales")
    return TS.reseasonalize(out, "adjusted").select("flag", "date", F.round("restored", 6).alias("restored"))


@query("win_other_sales", f"""SELECT item, date, sum(sales) OVER (PARTITION BY date) - sum(sales) OVER (PARTITION BY date, item) AS other_sales FROM ({DAILY})""")
def _(t):
    return TS.other_sales(daily(t), "item", "date", "sales").select("item", "date", "other_sales")


@query("win_age", f"""SELECT item, date, date_diff('day', min(CASE WHEN sales > 0 THEN date END) OVER (PARTITION BY item), date)::INT AS age FROM ({DAILY})""")
def _(t):
    return TS.age_days(daily(t), "item", "date", "sales").select("item", "date", "age")


@query("win_share", f"SELECT item, date, sales / sum(sales) OVER (PARTITION BY date) AS pct_total FROM ({DAILY})")
def _(t):
    return TS.pct_total(daily(t), "date", "sales").select("item", "date", "pct_total")


@query("win_first_row", "SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts FROM events GROUP BY 1")
def _(t):
    return TS.first_per(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"])


@query("ts_calendar", """SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day, hour(o_orderdate)::INT AS hour,
minute(o_orderdate)::INT AS minute, (isodow(o_orderdate) - 1)::INT AS dow, dayofyear(o_orderdate)::INT AS doy, dayname(o_orderdate) AS weekday,
(date_diff('day', DATE '1995-01-01', o_orderdate::DATE) // 7)::BIGINT AS week FROM orders""")
def _(t):
    return TS.calendar_features(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "1995-01-01").drop("o_orderdate")
