"""Encoders, imputers, outliers, target encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from tabloom.plans.ordered import positions
from tabloom.plans.quantiles import exact_medians
from tabloom.plans.sizes import bounded_rows
from tabloom.plans.skew import join_rows



#: Values that may become columns of their own; more of them raise, as a schema is built on the driver.
MAX_COLUMNS = 10_000


def _values(df: DataFrame, c: str, limit: int = MAX_COLUMNS) -> list:
    rows = bounded_rows(df.select(c).filter(F.col(c).isNotNull()).distinct(), limit, f"values of {c}")
    return sorted(r[0] for r in rows)


def encode_dummy(df: DataFrame, c: str, values: Sequence | None = None, drop_first: bool = False) -> DataFrame:
    """A 0/1 column ``col-value`` per value; the source column is dropped."""
    values = _values(df, c) if values is None else list(values)
    used = values[1:] if drop_first else values
    made = {f"{c}-{v}": F.when(F.col(c) == F.lit(v), 1).otherwise(0) for v in used}
    return df.withColumns(made).drop(c) if made else df.drop(c)


def encode_single_dummy(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """0/1 columns for the listed values; the source column stays."""
    return df.withColumns({
        f"{c}-{v}": F.when(F.col(c).cast("string") == F.lit(str(v)), 1).otherwise(0) for v in values
    })


def class_codes(df: DataFrame, c: str) -> DataFrame:
    """(value, code): codes 0..k-1 in sorted order of the distinct values."""
    distinct = df.select(c).filter(F.col(c).isNotNull()).distinct()
    return positions(distinct, [c], "code").withColumn("code", F.col("code").cast("int"))


def encode_index(df: DataFrame, c: str) -> tuple[DataFrame, DataFrame]:
    """Replace values by their class code; returns the frame and the classes."""
    codes = class_codes(df, c)
    other = [x for x in df.columns if x != c]
    coded = join_rows(df, codes, [c], "left").select(*other, F.col("code").alias(c))
    return coded.select(*df.columns), codes


def _scalar(df: DataFrame, value: Column) -> Column:
    return df.agg(value).scalar()


def encode_zscore(df: DataFrame, cols: Sequence[str], mean: float | None = None, sd: float | None = None,
                  ddof: int = 1) -> DataFrame:
    """(x - mean) / sd in place, with sample (ddof 1) or population (ddof 0) deviation.

    The statistics of all columns are merged by the optimizer into one aggregate.
    """
    spread = F.stddev_samp if ddof else F.stddev_pop
    made = {}
    for c in cols:
        m = F.lit(mean) if mean is not None else _scalar(df, F.avg(c))
        s = F.lit(sd) if sd is not None else _scalar(df, spread(c))
        made[c] = F.try_divide(F.col(c) - m, s)
    return df.withColumns(made)


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return encode_zscore(df, cols, ddof=0)


def encode_range(df: DataFrame, c: str, lo: float = -1.0, hi: float = 1.0,
                 data_lo: float | None = None, data_hi: float | None = None) -> DataFrame:
    """Rescale to [lo, hi], from the column's own or a given data range."""
    a = F.lit(data_lo) if data_lo is not None else _scalar(df, F.min(c))
    b = F.lit(data_hi) if data_hi is not None else _scalar(df, F.max(c))
    return df.withColumn(c, F.try_divide(F.col(c) - a, b - a) * (hi - lo) + lo)


def minmax(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None) -> DataFrame:
    """0-1 scaling; ``fit`` names the frame that gives the ranges (default: the frame itself)."""
    source = df if fit is None else fit
    made = {}
    for c in cols:
        a, b = _scalar(source, F.min(c)), _scalar(source, F.max(c))
        made[c] = F.try_divide(F.col(c).cast("double") - a, b - a)
    return df.withColumns(made)


def engineered(df: DataFrame, a: str, b: str) -> DataFrame:
    """Ratio, difference, power, log, root, polynomial and rational features of two inputs."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    poly = 1 + 5 * x + 8 * F.pow(x, F.lit(2.0))
    cross = 2 + 5 * F.pow(x * y, F.lit(2.0)) + 4 * x * y
    return df.withColumns({
        "f_diff": x - y,
        "f_ratio": F.try_divide(x, y),
        "f_pow": F.pow(x, F.lit(2.0)),
        "f_log": F.when(x > 0, F.log(x)),
        "f_sqrt": F.when(x >= 0, F.sqrt(x)),
        "f_poly": poly,
        "f_poly2": cross,
        "f_rpoly": F.try_divide(F.lit(1.0), poly - 1),
        "f_rpoly2": F.try_divide(F.lit(1.0), cross),
    })


def target_encode(train: DataFrame, other: DataFrame | None, cat: str, y: str, w: float,
                  unseen_mean: bool = False, name: str = "encoded") -> DataFrame:
    """Smoothed target mean ``(n mean + w global) / (n + w)`` of each category.

    Statistics come from the training frame only; a category it does not hold is null, or
    the global mean on request.
    """
    overall = train.agg(F.avg(y)).scalar()
    stats = train.groupBy(cat).agg(F.count(y).alias("_n"), F.avg(y).alias("_m"))
    smooth = (F.col("_n") * F.col("_m") + w * overall) / (F.col("_n") + w)
    table = stats.select(cat, smooth.alias(name))
    frame = train if other is None else other
    out = join_rows(frame, table, [cat], "left")
    return out.withColumn(name, F.coalesce(name, overall)) if unseen_mean else out


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null to the exact median, as double columns; all columns share the passes."""
    middle = exact_medians(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double")) for c, v in middle.items()})


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), _scalar(df, F.avg(c))) for c in cols})


def impute_mode(df: DataFrame, c: str) -> DataFrame:
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).count()
    top = counts.agg(F.min_by(F.col(c), F.struct(-F.col("count"), F.col(c)))).scalar()
    return df.withColumn(c, F.coalesce(F.col(c), top))


def remove_outliers(df: DataFrame, c: str, k: float) -> DataFrame:
    """Drop rows k or more sample deviations from the mean; null rows stay."""
    m, s = _scalar(df, F.avg(c)), _scalar(df, F.stddev_samp(c))
    return df.filter(F.col(c).isNull() | (F.abs(F.col(c) - m) < k * s))


def to_xy(df: DataFrame, target: str, features: Sequence[str] | None = None) -> tuple[DataFrame, str]:
    """(features vector, label) and the task; an integer target means classification."""
    used = list(features or [c for c in df.columns if c != target])
    kind = "classification" if isinstance(df.schema[target].dataType, IntegralType) else "regression"
    made = VectorAssembler(inputCols=used, outputCol="features").transform(df)
    made = made.withColumn("label", F.col(target).cast("double"))
    if kind == "classification":
        values = _values(df, target)
        onehot = F.array(*[F.when(F.col(target) == F.lit(v), 1).otherwise(0) for v in values])
        made = made.withColumn("onehot", onehot)
    return made, kind
