"""Row and column helpers: filters, mutation, set operations, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.scalar import col, recode
from tabloom.plans.draws import uniform, whole
from tabloom.plans.ordered import Order, _names, positions


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; unknown names are ignored."""
    return df.drop(*cols)


def between(df: DataFrame, c: str, lo, hi, inclusive: bool = True) -> DataFrame:
    x = F.col(c)
    return df.filter((x >= lo) & (x <= hi) if inclusive else (x > lo) & (x < hi))


def select_period(df: DataFrame, ts: str, start, end, key: str, value) -> DataFrame:
    """Rows of one key strictly inside a period."""
    return df.filter((F.col(ts) > F.lit(start)) & (F.col(ts) < F.lit(end)) & (F.col(key) == value))


def of_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows of one year, as a range so that the scan can skip files."""
    lo, hi = (F.lit(f"{y}-01-01").cast(df.schema[ts].dataType) for y in (year, year + 1))
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def drop_markers(df: DataFrame, cols: Sequence[str], marker=0) -> DataFrame:
    """Drop rows where a listed column holds the missing marker; nulls stay."""
    return df.filter(reduce(lambda a, b: a & b, [~F.col(c).eqNullSafe(F.lit(marker)) for c in cols]))


def update_where(df: DataFrame, cond: Column, c: str, value) -> DataFrame:
    return df.withColumn(c, F.when(cond, value if isinstance(value, Column) else F.lit(value)).otherwise(F.col(c)))


def rename_cols(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def with_expr(df: DataFrame, name: str, expr: str | Column) -> DataFrame:
    return df.withColumn(name, F.expr(expr) if isinstance(expr, str) else expr)


def replace_values(df: DataFrame, c: str, mapping: Mapping) -> DataFrame:
    return df.withColumn(c, recode(c, mapping))


def with_row_id(df: DataFrame, order: Order, name: str = "id") -> DataFrame:
    """Ids 1..n in the given (total) order."""
    placed = positions(df, order)
    return placed.select((F.col("_pos") + 1).alias(name), *df.columns)


def trim_range(df: DataFrame, order: str, left, right) -> DataFrame:
    """Rows between two cut points, both kept; the untrimmed frame is the restore."""
    return df.filter(F.col(order).between(left, right))


def contains_text(df: DataFrame, c: str, part: str) -> DataFrame:
    """Cheap substring test to run before a costly parse."""
    return df.filter(F.col(c).contains(part))


def head(df: DataFrame, n: int, order: Order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The last n rows of an ascending order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def slice_rows(df: DataFrame, order: Order, start: int, stop: int) -> DataFrame:
    """Rows start..stop-1 after a sort."""
    return df.orderBy(*order).offset(start).limit(stop - start)


def topk(df: DataFrame, score: str, k: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(score), *ties).limit(k)


def shuffle(df: DataFrame, seed: int = 42) -> DataFrame:
    """A repeatable random order that depends on the rows alone, not on their partitions."""
    return df.orderBy(F.xxhash64(F.lit(seed), *df.columns))


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).distinct()


def except_ids(ids: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    return ids.join(taken.select(key), key, "left_anti")


def split_random(df: DataFrame, frac: float, keys: Sequence[str], seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test part; a row's side depends only on its key and the seed, by a draw that SQL can repeat for whole-number keys."""
    is_test = uniform(seed, *[whole(df, k) for k in keys]) < frac
    return df.filter(~is_test), df.filter(is_test)


def split_block(df: DataFrame, order: Order, frac: float) -> tuple[DataFrame, DataFrame]:
    """The first ``floor(n * frac)`` rows, and the rest."""
    placed = positions(df, order)
    cut = placed.agg(F.floor((F.count("*") * F.lit(frac)).cast("decimal(38,6)"))).scalar()
    return (placed.filter(F.col("_pos") < cut).drop("_pos"),
            placed.filter(F.col("_pos") >= cut).drop("_pos"))


def competition_split(df: DataFrame, order: Order, frac: float, label: str, constant) -> dict[str, DataFrame]:
    """train; test without the label; solution; sample submission with a constant label."""
    train, rest = split_block(df, order, frac)
    return {
        "train": train,
        "test": rest.drop(label),
        "solution": rest,
        "sample": rest.withColumn(label, F.lit(constant)),
    }
