"""Order-based work without one task per table or per hot key.

``positions`` numbers a whole table through a range shuffle: a range boundary may fall
inside a hot key, so partitions stay even. The other helpers use plain windows for
ordinary keys and cut hot keys, found by counting, into blocks of consecutive rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabloom.plans.sizes import hot_keys, split_hot
from tabloom.session import written

BLOCK_ROWS = 1_000_000
_LOW_BITS = (1 << 33) - 1

Order = Sequence["str | Column"]


def _names(order: Order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def positions(df: DataFrame, order: Order, name: str = "_pos") -> DataFrame:
    """0-based position of every row in ``order``, which should be total.

    One range shuffle and sort; the task-local row index is stored before the second
    pass, so both passes see the same boundaries. The offsets are one row per shuffle partition.
    """
    spark = df.sparkSession
    keys = _names(order)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    stored = written(ranged.withColumn("_mid", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_mid", 33)
    sizes = (
        stored.groupBy(part.alias("_part"))
        .agg((F.max(F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))) + 1).alias("n"))
        .collect()
    )
    offsets, start = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], start))
        start += row["n"]
    # one pair of numbers per shuffle partition: as small as the driver's own task table
    table = spark.createDataFrame(offsets or [(0, 0)], "_part long, _start long")
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .withColumn(name, F.col("_start") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_part", "_start", "_mid")
    )


def running_totals(df: DataFrame, order: Order, sums: dict[str, str]) -> DataFrame:
    """Inclusive running totals over the whole table: ``{new column: summed column}``.

    Rows are numbered, cut into blocks of equal row count, summed inside a block, and
    shifted by the totals of the blocks before it. Nulls add nothing; before the first value the total is null.
    """
    numbered_rows = positions(df, order)
    blocks = numbered_rows.withColumn("_block", F.expr(f"_pos div {BLOCK_ROWS}"))
    inside = W.partitionBy("_block").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    totals = blocks.groupBy("_block").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    # one row per block of a million rows, so a single ordered pass over it stays small
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    shifts = totals.select("_block", *[F.sum(f"_t_{n}").over(before).alias(f"_s_{n}") for n in sums])
    out = blocks.join(shifts, "_block")
    zero = F.lit(0)
    for n, c in sums.items():
        within, shift = F.sum(c).over(inside), F.col(f"_s_{n}")
        total = F.coalesce(within, zero) + F.coalesce(shift, zero)
        out = out.withColumn(n, F.when(within.isNotNull() | shift.isNotNull(), total))
    return out.drop("_pos", "_block", *[f"_s_{n}" for n in sums])


def _key_positions(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    placed = positions(df, [*keys, *order])
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    first = placed.groupBy(*named).agg(F.min("_pos").alias("_first"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = placed.join(first, same)
    return joined.select(*df.columns, (F.col("_pos") - F.col("_first")).alias("_pos"))


def numbered(df: DataFrame, keys: Sequence[str], order: Order, name: str = "rn",
             hot: int | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """1-based row number per key. ``heavy`` is the table of ``hot_keys`` where the caller has counted already."""
    heavy = hot_keys(df, keys, hot) if heavy is None else heavy
    ranked = F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long")
    if heavy.isEmpty():
        return df.withColumn(name, ranked)
    cold, hot_part = split_hot(df, keys, heavy)
    placed = _key_positions(hot_part, keys, order)
    return cold.withColumn(name, ranked).unionByName(placed.withColumn(name, F.col("_pos") + 1).drop("_pos"))


Build = Callable[[DataFrame, list[str]], DataFrame]


def windowed(df: DataFrame, keys: Sequence[str], order: Order, build: Build, before: int = 0,
             after: int = 0, hot: int | None = None, block: int = BLOCK_ROWS, heavy: DataFrame | None = None) -> DataFrame:
    """Apply ``build(frame, partition columns)``, whose windows look at most ``before``
    rows back and ``after`` rows ahead.

    Hot keys run in blocks of consecutive rows; each block also receives the rows its
    frames reach in the neighbouring blocks. ``heavy`` as in ``numbered``.
    """
    keys = list(keys)
    heavy = hot_keys(df, keys, hot) if heavy is None else heavy
    if heavy.isEmpty():
        return build(df, keys)
    if max(before, after) > block:
        raise ValueError("a frame may not be longer than a block")
    cold, hot_part = split_hot(df, keys, heavy)
    placed = _key_positions(hot_part, keys, order)
    home, inside = F.expr(f"_pos div {block}"), F.expr(f"_pos % {block}")
    targets = F.array(
        home,
        F.when(inside >= block - before, home + 1),
        F.when(inside < after, home - 1),
    )
    copies = placed.withColumn("_home", home).withColumn("_block", F.explode(F.array_compact(targets)))
    built = build(copies, [*keys, "_block"]).filter(F.col("_block") == F.col("_home"))
    return build(cold, keys).unionByName(built.drop("_home", "_block", "_pos"))


def next_known(df: DataFrame, keys: Sequence[str], order: Order, cols: Sequence[str],
               hot: int | None = None, block: int = BLOCK_ROWS) -> DataFrame:
    """Fill nulls from the next row of the key that has a value."""
    keys = list(keys)

    def fill(frame: DataFrame, part: list[str], by: Order) -> DataFrame:
        ahead = W.partitionBy(*part).orderBy(*by).rowsBetween(0, W.unboundedFollowing)
        return frame.withColumns({c: F.first(c, ignorenulls=True).over(ahead) for c in cols})

    heavy = hot_keys(df, keys, hot)
    if heavy.isEmpty():
        return fill(df, keys, order)
    cold, hot_part = split_hot(df, keys, heavy)
    placed = _key_positions(hot_part, keys, order).withColumn("_block", F.expr(f"_pos div {block}"))
    edges = placed.groupBy(*keys, "_block").agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_n_{c}") for c in cols]
    )
    later = W.partitionBy(*keys).orderBy("_block").rowsBetween(1, W.unboundedFollowing)
    edges = edges.select(
        *[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)], F.col("_block").alias("_eb"),
        *[F.first(f"_n_{c}", ignorenulls=True).over(later).alias(f"_l_{c}") for c in cols]
    )
    same = F.col("_block") == F.col("_eb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_e{i}"))
    joined = fill(placed, [*keys, "_block"], ["_pos"]).join(edges, same, "left")
    for c in cols:
        joined = joined.withColumn(c, F.coalesce(c, f"_l_{c}"))
    return fill(cold, keys, order).unionByName(joined.select(*df.columns))
