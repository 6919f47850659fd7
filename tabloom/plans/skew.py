"""Equi joins: one declared join at every size; adaptive execution picks and splits it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def join_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Join on equally named keys (inner or left).

    No hint is given: adaptive execution broadcasts a side by its measured size and splits the partitions of a
    hot key. With ``null_safe`` a null key meets a null key, as totals of a null group need it.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins")
    keys = list(keys)
    if not null_safe:
        return left.join(right, keys, how)
    named = right.withColumnsRenamed({k: f"_j{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_j{i}"))
    return left.join(named, same, how).drop(*[f"_j{i}" for i in range(len(keys))])
