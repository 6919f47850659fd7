"""Counts that find hot groups, and collecting what must be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabloom.session import written

HOT_ROWS = 20_000_000
HOT_ROWS_CONF = "tabloom.hot.rows"


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """A stored table of the keys with more than ``limit`` rows: counted, at most ``rows / limit`` of them.

    Key columns are named ``_h0``, ``_h1`` ... so that the table can be joined to the rows.
    """
    limit = hot_rows(df) if limit is None else limit
    named = [F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]
    return written(df.groupBy(*named).count().filter(F.col("count") > limit).drop("count"), "hot-keys")


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, and rows of hot ones (nulls match nulls)."""
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_h{i}"))
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a frame that the caller calls small; beyond the limit fail loudly instead of growing the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}")
    return rows
