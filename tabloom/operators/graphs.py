"""Iterative steps over links: where chains end."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.plans.skew import join_rows
from tabloom.session import written


def chain_ends(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(``source``, ``target``): where the chain from each source ends; null if it runs into a cycle.

    A source with several targets takes the least one; rows with a null source or target are left out. Pointer jumping: in every round
    each open chain jumps to its target's target, so that it has twice the length behind it, and rounds are as many as the logarithm of the
    longest chain. The distances along a chain have no gaps, so a round after which as many chains are open as before has found the
    cycles. Every round is stored in the shared folder.
    """
    once = edges.filter(F.col(source).isNotNull() & F.col(target).isNotNull()).groupBy(F.col(source).alias("_from")).agg(F.min(target).alias("_to"))
    once = written(once, "chains")
    sources = once.select(F.col("_from").alias("_to"), F.lit(False).alias("_done"))
    table = written(join_rows(once, sources, ["_to"], "left").select("_from", "_to", F.coalesce("_done", F.lit(True)).alias("_done")), "chains")
    before = None
    while True:
        still = table.filter(~F.col("_done"))
        now = still.count()
        if now in (0, before):
            break
        ahead = table.select(F.col("_from").alias("_to"), F.col("_to").alias("_next"), F.col("_done").alias("_ends"))
        moved = join_rows(still.drop("_done"), ahead, ["_to"]).select("_from", F.col("_next").alias("_to"), F.col("_ends").alias("_done"))
        table, before = written(table.filter("_done").unionByName(moved), "chains"), now
    return table.select(F.col("_from").alias(source), F.when(F.col("_done"), F.col("_to")).alias(target))
