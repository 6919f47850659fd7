"""Calendar columns, shifts, resampling, rolling frames, decomposition, supervised windows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabloom.plans.ordered import next_known, numbered, windowed
from tabloom.plans.sizes import hot_keys
from tabloom.plans.skew import join_rows

# fixed values: period lengths in microseconds
PERIOD_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def period_micros(period: str) -> int:
    """``"3 days"`` to microseconds."""
    number, unit = period.split(" ")
    return int(number) * PERIOD_MICROS[unit.rstrip("s")]


def micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def calendar_features(df: DataFrame, ts: str, start: str | None = None) -> DataFrame:
    """year .. minute, dow (Monday 0), doy, weekday name and, with ``start``, the week number."""
    cols = {
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts),
        "minute": F.minute(ts), "dow": F.weekday(ts), "doy": F.dayofyear(ts),
        "weekday": F.date_format(ts, "EEEE"),
    }
    if start is not None:
        cols["week"] = F.floor(F.datediff(F.col(ts), F.lit(start).cast("date")) / 7)
    return df.withColumns(cols)


def shift(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], n: int) -> DataFrame:
    """Values ``n`` rows back (or ahead for a negative n) as ``name_shift``."""

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        w = W.partitionBy(*part).orderBy(*order)
        return frame.withColumns({f"{c}_shift": F.lag(c, n).over(w) for c in cols})

    return windowed(df, keys, order, build, before=max(n, 0), after=max(-n, 0))


def diff_prev(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Value minus the value of the previous row, as ``name_diff``; one ordered pass, no join."""

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        w = W.partitionBy(*part).orderBy(*order)
        return frame.withColumns({f"{c}_diff": F.col(c) - F.lag(c).over(w) for c in cols})

    return windowed(df, keys, order, build, before=1)


def supervised(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
               window: int, lag: int, drop_nulls: bool = True) -> DataFrame:
    """Columns ``c(t-window) .. c(t-1), c(t), c(t+lag)`` inside each key.

    All shifts share one window specification, hence one shuffle and one sort. A target
    of another key is null and drops out.
    """
    if window < 1 or lag < 1:
        raise ValueError("window and lag must be positive")

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        w = W.partitionBy(*part).orderBy(*order)
        made = {f"{c}(t-{i})": F.lag(c, i).over(w) for i in range(window, 0, -1) for c in cols}
        made.update({f"{c}(t)": F.col(c) for c in cols})
        made.update({f"{c}(t+{lag})": F.lead(c, lag).over(w) for c in cols})
        return frame.withColumns(made)

    slim = df.select(*keys, *[o for o in order if o not in cols], *cols)
    out = windowed(slim, keys, order, build, before=window, after=lag)
    names = [f"{c}(t-{i})" for i in range(window, 0, -1) for c in cols]
    names += [f"{c}(t)" for c in cols] + [f"{c}(t+{lag})" for c in cols]
    out = out.select(*keys, *[o for o in order if o not in cols], *[F.col(f"`{n}`") for n in names])
    return out.na.drop("any", subset=[f"`{n}`" for n in names]) if drop_nulls else out


def stack_sequences(df: DataFrame, features: Sequence[str], window: int, name: str = "tensor") -> DataFrame:
    """Supervised columns to one (steps x features) array per row, oldest step first."""
    steps = []
    for i in range(window, -1, -1):
        step = f"(t-{i})" if i else "(t)"
        steps.append(F.array(*[F.col(f"`{c}{step}`").cast("double") for c in features]))
    return df.withColumn(name, F.array(*steps))


def resample(df: DataFrame, keys: Sequence[str], ts: str, period: str, aggs: Mapping[str, Column]) -> DataFrame:
    """One row per period from the first to the last reading of a key, empty periods with nulls."""
    bucket = F.window(ts, period)["start"].cast(df.schema[ts].dataType)
    bars = df.groupBy(*keys, bucket.alias("period")).agg(*[c.alias(n) for n, c in aggs.items()])
    span = bars.groupBy(*keys).agg(F.min("period").alias("_lo"), F.max("period").alias("_hi"))
    calendar = span.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"interval {period}"))).alias("period"))
    return calendar.join(bars, [*keys, "period"], "left")


def bfill(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return next_known(df, keys, order, cols)


def month_mean(df: DataFrame, ts: str, year: int, c: str) -> DataFrame:
    from tabloom.operators.frame import of_year

    return of_year(df, ts, year).groupBy(F.month(ts).alias("month")).agg(F.avg(c).alias("mean"))


def ohlc(df: DataFrame, ts: str, price: str, period: str, seq: str, keys: Sequence[str] = ()) -> DataFrame:
    """Open, high, low, close per period; equal times are ordered by the sequence number."""
    at = F.struct(ts, seq)
    return resample(df, keys, ts, period, {
        "open": F.min_by(price, at), "high": F.max(price), "low": F.min(price), "close": F.max_by(price, at),
    })


# parts of a rolling aggregate, and how the parts of neighbouring stretches combine
ROLLING = {"max": [F.max], "min": [F.min], "sum": [F.sum], "count": [F.count], "mean": [F.sum, F.count]}


def _combine(fn: str, i: int, head: Column, middle: Column, tail: Column) -> Column:
    if fn == "max":
        return F.greatest(head, middle, tail)
    if fn == "min":
        return F.least(head, middle, tail)
    zero = F.lit(0)
    added = F.coalesce(head, zero) + F.coalesce(middle, zero) + F.coalesce(tail, zero)
    return added if ROLLING[fn][i] is F.count else F.when(F.coalesce(head, middle, tail).isNotNull(), added)


def rolling(df: DataFrame, keys: Sequence[str], ts: str, period: str, c: str, fn: str = "max",
            name: str = "rolled", buckets: int = 24) -> DataFrame:
    """An aggregate (max, min, sum, count, mean) over the rows in ``(t - period, t]``, from one
    row on.

    The period is cut into equal buckets, so a frame is the end of one bucket (head), whole
    buckets (middle) and the start of the current one (tail). Head and tail are running
    aggregates inside a (key, bucket) partition, and the middle works on one row per bucket:
    the cost per row does not grow with the rows in a frame, and a key with a third of all
    rows is many partitions.
    """
    span = period_micros(period)
    if span % buckets:
        raise ValueError("the period must divide into the buckets")
    width, keys, parts = span // buckets, list(keys), ROLLING[fn]
    rows = df.withColumn("_us", micros(ts)).withColumn("_b", F.expr(f"floor(_us / {width})"))
    upto = W.partitionBy(*keys, "_b").orderBy("_us").rangeBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({f"_tail{i}": f(c).over(upto) for i, f in enumerate(parts)})

    per_bucket = df.groupBy(*keys, F.floor(micros(ts) / width).alias("_b")).agg(*[
        f(c).alias(f"_p{i}") for i, f in enumerate(parts)])
    between = W.partitionBy(*keys).orderBy("_b").rangeBetween(-(buckets - 1), -1)
    join = [F.sum if f is F.count else f for f in parts]
    middle = per_bucket.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_mb"),
        *[f(f"_p{i}").over(between).alias(f"_middle{i}") for i, f in enumerate(join)])
    same = F.col("_b") == F.col("_mb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = rows.join(middle, same, "left")

    # every row enters its own bucket as a value, and the bucket one period earlier as a question
    kept = [*df.columns, *[f"_tail{i}" for i in range(len(parts))], *[f"_middle{i}" for i in range(len(parts))]]
    value, nothing = F.col(c), F.lit(None)
    row = F.struct(*kept)
    entries = rows.select(*keys, F.explode(F.array(
        F.struct(F.col("_b").alias("b"), F.col("_us").alias("at"), value.alias("v"), F.when(F.lit(False), row).alias("row")),
        F.struct((F.col("_b") - buckets).alias("b"), (F.col("_us") - span).alias("at"),
                 nothing.cast(df.schema[c].dataType).alias("v"), F.when(F.lit(True), row).alias("row")),
    )).alias("_e")).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_e.*")
    after = W.partitionBy(*[f"_k{i}" for i in range(len(keys))], "b").orderBy(F.desc("at")).rangeBetween(W.unboundedPreceding, -1)
    heads = entries.withColumns({f"_head{i}": f("v").over(after) for i, f in enumerate(parts)}).filter("row is not null")
    done = [_combine(fn, i, F.col(f"_head{i}"), F.col(f"row._middle{i}"), F.col(f"row._tail{i}")) for i in range(len(parts))]
    result = F.try_divide(done[0], done[1]) if fn == "mean" else done[0]
    return heads.select(*[F.col(f"row.`{x}`").alias(x) for x in df.columns], result.alias(name))


def sma(df: DataFrame, keys: Sequence[str], order: Sequence[str], c: str, n: int, name: str = "sma") -> DataFrame:
    """Mean of the last n rows; 1 leaves the values as they are."""
    if n < 1:
        raise ValueError("the number of frames starts at 1")
    if n == 1:
        return df.withColumn(name, F.col(c))

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        w = W.partitionBy(*part).orderBy(*order).rowsBetween(-(n - 1), 0)
        return frame.withColumn(name, F.avg(c).over(w))

    return windowed(df, keys, order, build, before=n - 1)


def detrend(df: DataFrame, keys: Sequence[str], order: Sequence[str], c: str, name: str = "detrended") -> DataFrame:
    """Subtract each key's least-squares line over the row index."""
    rows = numbered(df, keys, order, "_i").withColumn("_i", F.col("_i") - 1)
    line = rows.groupBy(*keys).agg(F.regr_slope(c, "_i").alias("_a"), F.regr_intercept(c, "_i").alias("_b"))
    fit = F.coalesce(F.col("_a") * F.col("_i") + F.col("_b"), F.col(c))
    return join_rows(rows, line, keys, null_safe=True).withColumn(name, F.col(c) - fit).drop("_i", "_a", "_b")


def seasonal_decompose(df: DataFrame, keys: Sequence[str], order: Sequence[str], c: str, period: int = 7,
                       model: str = "multiplicative") -> DataFrame:
    """Add trend, seasonal and resid.

    The trend is the centred mean, null where the frame is cut; the phase is the row
    number modulo the period; phase means are normalised to 1 (or 0 when additive).
    """
    half, times = period // 2, model == "multiplicative"

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        base = W.partitionBy(*part).orderBy(*order)

        def mean(lo: int, hi: int) -> Column:
            w = base.rowsBetween(lo, hi)
            return F.when(F.count(F.lit(1)).over(w) == hi - lo + 1, F.avg(c).over(w))

        trend = mean(-half, half) if period % 2 else (mean(-half, half - 1) + mean(-half + 1, half)) / 2
        if period % 2 == 0:
            full = base.rowsBetween(-half, half)
            trend = F.when(F.count(F.lit(1)).over(full) == period + 1, trend)
        return frame.withColumn("trend", trend)

    heavy = hot_keys(df, keys)  # counted once for both steps
    rows = numbered(df, keys, order, "_rn", heavy=heavy)
    rows = windowed(rows, keys, order, build, before=half, after=half, heavy=heavy)
    rows = rows.withColumn("_phase", F.expr(f"(_rn - 1) % {period}"))
    off = F.try_divide(F.col(c), F.col("trend")) if times else F.col(c) - F.col("trend")
    phases = rows.withColumn("_off", off).groupBy(*keys, "_phase").agg(F.avg("_off").alias("_mean"))
    norm = F.avg("_mean").over(W.partitionBy(*keys))
    seasonal = F.try_divide(F.col("_mean"), norm) if times else F.col("_mean") - norm
    phases = phases.select(*keys, "_phase", seasonal.alias("seasonal"))
    out = join_rows(rows, phases, [*keys, "_phase"], null_safe=True)
    resid = (F.try_divide(F.try_divide(F.col(c), F.col("trend")), F.col("seasonal")) if times
             else F.col(c) - F.col("trend") - F.col("seasonal"))
    return out.withColumn("resid", resid).drop("_rn", "_phase")


def deseasonalize(df: DataFrame, adjust: DataFrame, on: Sequence[str], c: str, name: str = "adjusted") -> DataFrame:
    """value / seasonal / trend by the adjustment table; rows without a factor drop out."""
    table = adjust.select(*on, "seasonal", "trend").na.drop("any")
    value = F.try_divide(F.try_divide(F.col(c), F.col("seasonal")), F.col("trend"))
    return join_rows(df, table, on).withColumn(name, value).na.drop("any", subset=[name])


def reseasonalize(df: DataFrame, c: str, name: str = "restored") -> DataFrame:
    return df.withColumn(name, F.col(c) * F.col("seasonal") * F.col("trend"))


def other_sales(df: DataFrame, item: str, ts: str, count: str) -> DataFrame:
    """Total of all other items on the same date; rows without a date or an item keep their own groups.

    Totals are reduced before they are joined back, so a busy date is never one task.
    """
    own = df.groupBy(ts, item).agg(F.sum(count).alias("_own"))
    day = own.groupBy(ts).agg(F.sum("_own").alias("_day"))
    others = join_rows(own, day, [ts], null_safe=True).select(ts, item, (F.col("_day") - F.col("_own")).alias("other_sales"))
    return join_rows(df, others, [ts, item], null_safe=True)


def age_days(df: DataFrame, item: str, ts: str, count: str) -> DataFrame:
    """Days since the item's first positive sale; items never sold drop out."""
    first = df.filter(F.col(count) > 0).groupBy(item).agg(F.min(ts).alias("first_sale"))
    return join_rows(df, first, [item]).withColumn("age", F.datediff(F.col(ts), F.col("first_sale")))


def pct_total(df: DataFrame, ts: str, count: str) -> DataFrame:
    """Share of the row in the day's total."""
    day = df.groupBy(ts).agg(F.sum(count).alias("_day"))
    return (join_rows(df, day, [ts], null_safe=True)
            .withColumn("pct_total", F.try_divide(F.col(count), F.col("_day"))).drop("_day"))


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key; partial minima keep a hot key off one task."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return picked.select(*keys, "r.*")
