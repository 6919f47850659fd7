"""Aggregates and summary tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.scalar import col
from tabloom.operators.joins import join_lookup
from tabloom.plans.ordered import Order, running_totals, windowed
from tabloom.plans.quantiles import exact_medians
from tabloom.plans.sizes import bounded_rows
from tabloom.session import written
from pyspark.sql import Window as W



def mean_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def sum_by(df: DataFrame, keys: Sequence[str | Column], c: str, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(c).alias(name))


def sum_by_weekday(df: DataFrame, ts: str, c: str, *keys: str) -> DataFrame:
    """Totals per weekday name, Monday first."""
    days = df.groupBy(F.weekday(ts).alias("dow"), F.date_format(ts, "EEEE").alias("weekday"), *keys)
    return days.agg(F.sum(c).alias("total")).orderBy("dow", *keys)


def agg_by(df: DataFrame, keys: Sequence[str], spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{output: (function, column)}`` with one group-by."""
    return df.groupBy(*keys).agg(*[getattr(F, fn)(c).alias(out) for out, (fn, c) in spec.items()])


def popular_items(sales: DataFrame, items: DataFrame, item: str, count: str, item_id: str, name: str) -> DataFrame:
    """Totals per item, largest first; the fact is reduced before it meets the item names."""
    totals = sales.groupBy(item).agg(F.sum(count).alias("item_count"))
    named = join_lookup(totals, items.select(item_id, name), item, item_id)
    return named.select(F.col(item).alias("item_id"), F.col(name).alias("name"), "item_count").orderBy(
        F.desc("item_count"), "item_id")


def count_mean(df: DataFrame, key: str, y: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(y).alias("n"), F.avg(y).alias("mean"))


def launch_stop_dates(df: DataFrame, item: str, ts: str, count: str) -> DataFrame:
    """First and last date with a positive count."""
    return df.filter(F.col(count) > 0).groupBy(item).agg(F.min(ts).alias("launch"), F.max(ts).alias("stop"))


def nunique(df: DataFrame, c: str, count_null: bool = False) -> DataFrame:
    """Exact distinct count; optionally null counts as one more value."""
    value = F.countDistinct(c)
    if count_null:
        value = value + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))
    return df.agg(value.cast("long").alias("n_unique"))


def has_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: does the key repeat? Counts per key first, so a hot key is one counter."""
    per_key = df.groupBy(*keys).count()
    return per_key.agg(F.coalesce(F.max("count") > 1, F.lit(False)).alias("has_duplicates"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None, positive_only: bool = False) -> DataFrame:
    """(column, nulls), all columns in one pass."""
    cols = list(cols or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    out = _melt(counts, cols, "column", "nulls")
    return out.filter("nulls > 0") if positive_only else out


def null_counts_by(df: DataFrame, key: Column, name: str, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def _melt(one: DataFrame, cols: Sequence[str], key: str, value: str) -> DataFrame:
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias(key), F.col(f"`{c}`").alias(value)) for c in cols])))


def time_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))


def median(df: DataFrame, c: str) -> DataFrame:
    """Exact median as one row."""
    value = exact_medians(df, [c])[c]
    return df.sparkSession.range(1).select(F.lit(value).cast("double").alias("median"))


def mode_(df: DataFrame, c: str) -> DataFrame:
    """Most frequent value, the smallest on ties."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).count()
    return counts.orderBy(F.desc("count"), c).limit(1).select(F.col(c).alias("mode"))


def spread(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.stddev_samp(c).alias("sd_sample"), F.stddev_pop(c).alias("sd_population"))


def missing_ratio(df: DataFrame, key: str, ts: str, delta_minutes: float, years: float | None = 3) -> DataFrame:
    """Expected readings for all stations against the rows that exist.

    ``years`` fixes the period at 365 days each; None takes the days from first to last
    reading.
    """
    days = (F.lit(365.0 * years) if years is not None
            else (F.datediff(F.max(ts), F.min(ts)) + 1).cast("double"))
    stations = F.countDistinct(key)
    expected = stations * F.lit(60.0 / delta_minutes) * 24 * days
    return df.agg(stations.alias("stations"), F.count("*").alias("actual"), expected.alias("expected"),
                  (1 - F.count("*") / expected).alias("missing_ratio"))


def gaps_seconds(df: DataFrame, key: str, ts: str, *ties: str) -> DataFrame:
    """Seconds from the previous reading of the same station."""

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        before = F.lag(ts).over(W.partitionBy(*part).orderBy(ts, *ties))
        return frame.withColumn("gap", F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
                                - F.unix_micros(before.cast("timestamp")) / 1e6)

    return windowed(df.select(key, ts, *ties), [key], [ts, *ties], build, before=1)


def max_gap_minutes(df: DataFrame, key: str, ts: str, *ties: str) -> DataFrame:
    return gaps_seconds(df, key, ts, *ties).agg((F.max(F.floor("gap")) / 60).alias("max_gap_minutes"))


def corr_matrix(df: DataFrame, cols: Sequence[str], threshold: float | None = None) -> DataFrame:
    """Long Pearson matrix (a, b, corr) over null-free rows; every pair in one aggregate."""
    return _pair_matrix(df, cols, F.corr, "corr", threshold)


def cov_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _pair_matrix(df, cols, F.covar_samp, "cov", None)


def _pair_matrix(df: DataFrame, cols: Sequence[str], fn, name: str, threshold: float | None) -> DataFrame:
    clean = df.select(*cols).na.drop("any")
    pairs = list(combinations_with_replacement(cols, 2))
    one = clean.agg(*[fn(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"p{i}").alias(name)))
    out = one.select(F.inline(F.array(*cells)))
    return out.filter(F.col(name) > threshold) if threshold is not None else out


def inverse_covariance(df: DataFrame, cols: Sequence[str]) -> list[list[float]]:
    """k x k inverse on the driver; only the matrix is fetched."""
    at = {c: i for i, c in enumerate(cols)}
    m = np.zeros((len(cols), len(cols)))
    for r in cov_matrix(df, cols).collect():
        m[at[r["a"]], at[r["b"]]] = r["cov"]
    return np.linalg.inv(m).tolist()


def value_shares(df: DataFrame, c: str) -> DataFrame:
    """Share of each value in percent, two digits."""
    total = df.agg(F.count(c)).scalar()
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(100 * F.col("n") / total, 2))


def histogram(df: DataFrame, c: str, bins: int = 10) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin is closed."""
    lo, hi = df.agg(F.min(c)).scalar(), df.agg(F.max(c)).scalar()
    x = F.col(c).cast("double")
    step = (hi - lo) / F.lit(float(bins))
    at = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide(x - lo, step)), F.lit(bins - 1)))
    return (df.filter(x.isNotNull()).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n")))


#: Values that may become columns; a table with more of them is better read as the long rows of ``pair_counts``.
MAX_COLUMNS = 10_000


def pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n): frequencies as rows, for any number of values."""
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, a: str, b: str, limit: int = MAX_COLUMNS) -> DataFrame:
    """Frequencies of a x b, a column per value of b; absent pairs are 0. More than ``limit`` values of b raise: see ``pair_counts``."""
    counts = written(pair_counts(df, a, b).withColumnRenamed("n", "count"), "pair-counts")
    values = sorted(r[0] for r in bounded_rows(counts.select(b).distinct(), limit, "column values"))
    return counts.groupBy(a).pivot(b, values).agg(F.sum("count")).na.fill(0)


def best_cycle(df: DataFrame, keys: Sequence[str], error: str) -> DataFrame:
    """Per experiment the row with the smallest error."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), error).alias("r")).select(*keys, "r.*")


def rank_diff(r1: DataFrame, r2: DataFrame, key: str, value: str) -> DataFrame:
    """Euclidean distance of two importance vectors."""
    a, b = r1.select(key, F.col(value).alias("_a")), r2.select(key, F.col(value).alias("_b"))
    d = F.col("_a") - F.col("_b")
    return a.join(b, key).agg(F.sqrt(F.sum(d * d)).alias("distance"))


def progress(reports: DataFrame, order: Order, completed: str = "completed", every: int = 100_000) -> DataFrame:
    """Running total of worker reports, flagged where it passes a multiple of ``every``."""
    out = running_totals(reports, order, {"total": completed})
    passed = F.floor(F.col("total") / every) > F.floor((F.col("total") - F.col(completed)) / every)
    return out.withColumn("message", passed)


def rate_by(df: DataFrame, key: str, flag: str) -> DataFrame:
    return df.groupBy(key).agg((F.sum(flag) / F.count("*")).alias("rate"))
