"""Jump consistent hashing: stable keys to shards without a ring table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.llm.common import fresh
from tabloom.session import written

# Fixed values of the published jump hash: multiplier of its 64-bit generator, and 2^31 of its step.
MULTIPLIER = 2862933555777941757
STEP = 1 << 31
_MASK32 = (1 << 32) - 1


def _times_plus_one(key: Column) -> Column:
    """``key * MULTIPLIER + 1`` modulo 2^64. Plain bigint products would overflow, which ANSI mode
    refuses, so the number is put together from 16-bit and 32-bit parts."""
    c_low, c_high = F.lit(MULTIPLIER & _MASK32), F.lit(MULTIPLIER >> 32)
    low, high = key.bitwiseAND(F.lit(_MASK32)), F.shiftrightunsigned(key, 32)

    def product32(a: Column, b: Column) -> Column:
        """Low 32 bits of the product of two 32-bit numbers."""
        upper = (F.shiftrightunsigned(a, 16) * b).bitwiseAND(F.lit(0xFFFF))
        return (F.shiftleft(upper, 16) + a.bitwiseAND(F.lit(0xFFFF)) * b).bitwiseAND(F.lit(_MASK32))

    first, second = low.bitwiseAND(F.lit(0xFFFF)) * c_low, F.shiftrightunsigned(low, 16) * c_low
    bottom = first + F.shiftleft(second.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    carry = F.shiftrightunsigned(bottom, 32) + F.shiftrightunsigned(second, 16)
    top = (carry + product32(high, c_low) + product32(low, c_high)).bitwiseAND(F.lit(_MASK32))
    return F.shiftleft(top, 32).bitwiseOR(bottom.bitwiseAND(F.lit(_MASK32)))


def _chain(key: Column, shards: int) -> Column:
    """The last jump below ``shards`` and the first one at or beyond it. A key jumps about
    ``ln(shards)`` times; every jump moves ahead by one at least, so ``shards`` rounds are enough."""
    start = F.struct(key.cast("long").alias("key"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))

    def jump(s: Column, _: Column) -> Column:
        grown = _times_plus_one(s["key"])
        share = F.lit(float(STEP)) / (F.shiftrightunsigned(grown, 33) + 1).cast("double")
        ahead = F.floor((s["next"] + 1).cast("double") * share).cast("long")
        moved = F.struct(grown.alias("key"), s["next"].alias("at"), ahead.alias("next"))
        return F.when(s["next"] < shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump)


def jump_shards(df: DataFrame, key: str, shards: int, shard: str = "shard", grown: str = "grown_shard") -> DataFrame:
    """Add the shard of ``key`` (a whole number) among ``shards``, and its shard when one more is
    appended: the same one, or the new last one. Nothing else moves. A null key counts as 0.
    Input columns of the result names are replaced. Ties and repeated rows get equal shards;
    an empty table stays empty."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = _chain(F.coalesce(F.col(key), F.lit(0)), shards)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (shard, grown)]
    jumps = fresh("jumps")
    moved = df.withColumn(jumps, state)
    last = F.when(F.col(f"{jumps}.next") == shards, F.lit(shards)).otherwise(F.col(f"{jumps}.at"))
    return moved.select(*kept, F.col(f"{jumps}.at").cast("int").alias(shard), last.cast("int").alias(grown))


def slotted(df: DataFrame, group: str, slot: str = "slot") -> DataFrame:
    """Number the rows of every group from 0 without gaps, however many rows one group has.

    The rows are written once; a row is numbered inside its group and write task by a window over
    those two, and shifted by the rows of earlier tasks. That last window has one row per
    group and task, so no task sorts a whole group.
    """
    low, kept = F.lit((1 << 33) - 1), [c for c in df.columns if c != slot]
    mid, part, rank, of, at, shift = (fresh(n) for n in ("mid", "part", "rank", "group", "at", "shift"))
    stored = written(df.select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias(mid)), "slots")
    placed = stored.withColumn(part, F.shiftright(mid, 33)).withColumn(mid, F.col(mid).bitwiseAND(low))
    inside = Window.partitionBy(F.col(f"`{group}`"), part).orderBy(mid)
    counts = placed.groupBy(F.col(f"`{group}`").alias(of), F.col(part).alias(at)).agg(F.count("*").alias(shift))
    before = Window.partitionBy(of).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    shifts = written(counts.withColumn(shift, F.coalesce(F.sum(shift).over(before), F.lit(0))), "shifts")
    ranked = placed.withColumn(rank, F.row_number().over(inside))
    joined = ranked.join(shifts, F.col(f"`{group}`").eqNullSafe(F.col(of)) & (F.col(part) == F.col(at)), "left")
    return joined.select(*[F.col(f"`{c}`") for c in kept], (F.col(rank) - 1 + F.col(shift)).cast("long").alias(slot))


def shard_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shards, sizes and slots of documents: id, size (UTF-8 bytes and 16 more; a null text has
    none), CRC of the bytes (0 without text), shard, shard after one more is appended, slot."""
    sized = docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    return slotted(jump_shards(sized, key, shards), "shard")
