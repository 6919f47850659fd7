"""Column profiles and the preprocessing plan built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType, NumericType, StringType

from tabloom.functions.scalar import normal_quantile_sql, normal_tail_sql
from tabloom.operators.features import encode_dummy, encode_zscore, impute_median, impute_mode, minmax
from tabloom.plans.ordered import positions
from tabloom.plans.quantiles import exact_medians

# fixed values: a text column becomes dummies below these limits
MAX_DUMMY = 1000
MAX_DUMMY_SHARE = 0.75
NORMAL_P = 0.05
MAX_LISTED = 100
# fixed values: positive and negative token of a two-valued column, in order of preference
TOKEN_PAIRS = [("+", "-"), ("1", "0"), ("T", "F"), ("Y", "N"), ("TRUE", "FALSE"), ("YES", "NO"),
               ("P", "N"), ("POSITIVE", "NEGATIVE")]


def _numeric(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if isinstance(df.schema[c].dataType, NumericType)]


def _kind(df: DataFrame, c: str) -> str:
    t = df.schema[c].dataType
    return "int" if isinstance(t, IntegralType) else "float" if isinstance(t, NumericType) else "str"


def jarque_bera(c: str) -> Column:
    return F.count(c) / 6 * (F.pow(F.skewness(c), 2.0) + F.pow(F.kurtosis(c), 2.0) / 4)


def normality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, stat, p) of a moment test of normality; one aggregate for all columns."""
    one = df.agg(*[jarque_bera(c).alias(c) for c in cols])
    long = one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("stat")) for c in cols])))
    return long.withColumn("p", F.exp(-F.col("stat") / 2))


def normality_by_rank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, n, stat, z) of the Shapiro-Francia test: the squared correlation of the values with the normal scores of their ranks.

    All columns are ranked in one ordered pass over (column, value) rows; nulls and NaN are left out, ties take neighbouring ranks. ``z`` is Royston's
    normalised statistic (fixed values): above 1.645 the column is not normal at 5 percent. Null for fewer than 5 values or a
    constant column.
    """
    cols = list(cols)
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
    placed = positions(df.select(F.inline(pairs)).filter("v is not null and not isnan(v)"), ["i", "v"], "_at")
    first = placed.groupBy("i").agg(F.min("_at").alias("_first"), F.count("*").alias("n"))  # a row per column
    ranked = placed.join(F.broadcast(first), "i").withColumn("p", (F.col("_at") - F.col("_first") + 0.625) / (F.col("n") + 0.25))
    scored = ranked.withColumn("tail", F.expr(normal_tail_sql("p"))).withColumn("score", F.expr(normal_quantile_sql("p", "tail")))
    stat = F.try_divide(F.pow(F.covar_pop("v", "score"), 2.0), F.var_pop("v") * F.var_pop("score"))
    one = scored.groupBy("i").agg(F.first("n").alias("n"), stat.alias("stat"))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, name string")
    u = F.log("n")
    mu, sd = -1.2725 + 1.0521 * (F.log(u) - u), 1.0308 - 0.26758 * (F.log(u) + 2 / u)
    z = F.when((F.col("n") >= 5) & (F.col("stat") < 1), (F.log(1 - F.col("stat")) - mu) / sd)
    return names.join(one, "i", "left").select("name", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "stat", z.alias("z"))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, mode) of text columns: counts per (name, value), then the best per name."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in cols])
    counts = (df.select(F.inline(pairs)).filter("value is not null")
              .groupBy("name", "value").count())
    best = F.min_by("value", F.struct(-F.col("count"), F.col("value")))
    return counts.groupBy("name").agg(best.alias("mode"))


def profile(df: DataFrame, cols: Sequence[str] | None = None, target: str | None = None) -> DataFrame:
    """One row per column: type, mean, sd, median, min, max, mode, unique (null counts), missing, action.

    Moments, ranges and nulls are one aggregate; distinct counts one more (they expand per
    column); medians and modes have their own distributed passes.
    """
    cols = list(cols or df.columns)
    nums = _numeric(df, cols)
    texts = [c for c in cols if c not in nums]
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"missing_{i}"))
        if c in nums:
            aggs += [F.avg(c).alias(f"mean_{i}"), F.stddev_samp(c).alias(f"sd_{i}"),
                     F.min(c).cast("double").alias(f"min_{i}"), F.max(c).cast("double").alias(f"max_{i}"),
                     F.exp(-jarque_bera(c) / 2).alias(f"p_{i}")]
    one = df.agg(*aggs)
    distinct = _distinct_counts(df, cols)
    middle = exact_medians(df, nums)

    def number(c: str, i: int, name: str) -> Column:
        return F.col(f"{name}_{i}") if c in nums else F.lit(None).cast("double")

    rows = F.array(*[
        F.struct(
            F.lit(c).alias("name"), F.lit(_kind(df, c)).alias("type"), F.col("rows"),
            number(c, i, "mean").alias("mean"), number(c, i, "sd").alias("sd"),
            F.lit(middle.get(c)).cast("double").alias("median"),
            number(c, i, "min").alias("min"), number(c, i, "max").alias("max"),
            number(c, i, "p").alias("p"), F.col(f"missing_{i}").alias("missing"),
        ) for i, c in enumerate(cols)
    ])
    table = one.select(F.inline(rows)).join(distinct, "name")
    table = (table.join(modes(df, texts), "name", "left") if texts
             else table.withColumn("mode", F.lit(None).cast("string")))
    # a null is one more value
    table = table.withColumn("unique", F.col("distinct") + F.when(F.col("missing") > 0, 1).otherwise(0))
    return table.withColumn("action", action(target)).drop("distinct")


def _distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols])
    seen = df.select(F.inline(pairs)).filter("value is not null").distinct()
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "name string")
    counts = seen.groupBy("name").agg(F.count("*").alias("distinct"))
    return names.join(counts, "name", "left").na.fill(0, ["distinct"])


def action(target: str | None = None) -> Column:
    """ignore, zscore, normalize, dummy or target, from a profile row."""
    few = (F.col("unique") < MAX_DUMMY) & (F.col("unique") / F.col("rows") < MAX_DUMMY_SHARE)
    plan = (F.when(F.col("type") == "str", F.when(few, F.lit("dummy")).otherwise("ignore"))
            .when(F.col("p") > NORMAL_P, "zscore").otherwise("normalize"))
    return F.when(F.col("name") == F.lit(target), "target").otherwise(plan) if target else plan


def find_positive(df: DataFrame, c: str) -> str | None:
    """The positive token of a two-valued column, as stored."""
    seen = df.select(c).filter(F.col(c).isNotNull()).groupBy(F.upper(c).alias("u")).agg(F.min(c).alias("v"))
    rows = seen.limit(3).collect()
    if len(rows) != 2:
        return None
    stored = {r["u"]: r["v"] for r in rows}
    for yes, no in TOKEN_PAIRS:
        if {yes, no} == set(stored):
            return stored[yes]
    return stored[min(stored)]


def task_type(df: DataFrame, target: str, is_regression: bool) -> str:
    if is_regression:
        return "regression"
    n = df.select(target).distinct().limit(3).count()
    return "binary-classification" if n == 2 else "classification"


def apply_plan(df: DataFrame, plan: DataFrame) -> DataFrame:
    """Impute, scale and encode every column as its profile row says."""
    rows = {r["name"]: r for r in plan.collect()}
    nums = [n for n, r in rows.items() if r["type"] != "str" and r["missing"] > 0]
    out = impute_median(df, nums) if nums else df
    for n, r in rows.items():
        if r["type"] == "str" and r["missing"] > 0:
            out = impute_mode(out, n)
    z = [n for n, r in rows.items() if r["action"] == "zscore"]
    m = [n for n, r in rows.items() if r["action"] == "normalize"]
    out = encode_zscore(out, z, ddof=0) if z else out
    out = minmax(out, m) if m else out
    for n, r in rows.items():
        if r["action"] == "dummy":
            out = encode_dummy(out, n, drop_first=True)
        elif r["action"] == "ignore":
            out = out.drop(n)
    return out


def profile_categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column the unique count, and above 100 values its share of rows in whole percent,
    else the values with their percents, most frequent first."""
    cols = list(cols or df.columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.inline(pairs)).groupBy("name", "value").agg(F.count("*").alias("n"))
    # every row has one entry per column, so the counts of a column add up to the rows
    unique = counts.groupBy("name").agg(F.count("*").alias("n_unique"), F.sum("n").alias("rows"))
    listed = counts.join(unique.filter(F.col("n_unique") <= MAX_LISTED), "name").filter("value is not null")
    # at most MAX_LISTED entries per column are gathered
    entry = F.struct((-F.col("n")).alias("n"), F.col("value"),
                     F.format_string("%s:%.2f%%", F.col("value"), 100 * F.col("n") / F.col("rows")).alias("text"))
    lists = listed.groupBy("name").agg(F.array_sort(F.collect_list(entry)).alias("e")).select(
        "name", F.concat(F.lit("["), F.array_join(F.transform("e", lambda x: x["text"]), ","), F.lit("]")).alias("values"))
    share = F.when(F.col("n_unique") > MAX_LISTED, F.floor(100 * F.col("n_unique") / F.col("rows")))
    return (unique.join(lists, "name", "left")
            .select("name", "n_unique", share.alias("pct_unique"), "values"))
