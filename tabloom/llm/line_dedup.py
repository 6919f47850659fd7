"""Line deduplication within one edit by a deletion-neighbourhood join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import folded, mixed, release
from tabloom.plans.ordered import positions
from tabloom.session import written

#: Every line with a sign that is not blank is compared with equal ones; below this bound, an argument of the calls, only equal lines count as
#: repeated, as one edit is a large share of a shorter line ("Step 1 of 3", "Step 2 of 3") and often its meaning.
NEAR_CHARS = 20
#: A sign that is not blank: neither a space nor one of the controls from tab to carriage return.
SOLID = r"[^\x20\x09-\x0D]"
#: Variants that a task emits, about, and rows of one batch of them.
TASK_VARIANTS, BATCH_VARIANTS = 1_000_000, 200_000
#: Measured line numbers (4 bytes each, and 8 more a document) that a join may broadcast; beyond it both sides are shuffled.
BROADCAST_NUMBERS = 4_000_000
#: Measured rows of lines that a look-up may broadcast.
BROADCAST_ROWS = 500_000


def _halves(size: Column, near_chars: int) -> list[Column]:
    """Hashed halves of a line, for itself as the shorter line of a pair and for a shorter partner; null for short lines."""
    out = []
    for short in (size, size - 1):
        half = F.floor(short / 2).cast("int")
        head, tail = F.substring(F.col("line"), F.lit(1), half), F.right(F.col("line"), half)
        out += [F.when(size >= near_chars, F.xxhash64(F.lit(kind), short, part)) for kind, part in (("head", head), ("tail", tail))]
    return out


def variant_keys(line: str) -> tuple[np.ndarray, int]:
    """Keys of a line's variants with one sign deleted, and the key of the line itself; equal strings have equal keys.

    A key is the sum of a 64-bit hash of every (sign, place). With running sums from both ends, where the signs behind the
    deleted one count one place earlier, every variant takes one addition, so a line of n signs takes n steps.
    """
    sign = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    place = np.arange(len(sign), dtype=np.uint64)
    with np.errstate(over="ignore"):
        here, earlier = folded(sign, mixed(place + np.uint64(1))), folded(sign, mixed(place))
        before = np.cumsum(here) - here
        behind = np.cumsum(earlier[::-1])[::-1] - earlier
        return before + behind, int(here.sum(dtype=np.uint64))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, kind, v): 0 a variant with its place, 1 a variant, 2 the line itself."""
    for batch in batches:
        for at, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            cut, whole = variant_keys(line)
            place = np.arange(len(cut), dtype=np.uint64)
            keys = np.concatenate([folded(cut, mixed(place + np.uint64(7))), cut, np.array([whole], np.uint64)]).view(np.int64)
            kind = np.concatenate([np.zeros(len(cut), np.int8), np.ones(len(cut), np.int8), np.full(1, 2, np.int8)])
            for lo in range(0, len(keys), BATCH_VARIANTS):
                part = slice(lo, lo + BATCH_VARIANTS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[part]), at)), pa.array(kind[part]), pa.array(keys[part])], names=["at", "kind", "v"])
    release()


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Lines with their place (the key with nulls last, a hash of key and text, the line's number), the line
    without outer blanks, and two 64-bit hashes that together stand for it."""
    own = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    own = own.select("key", F.xxhash64("key", "body").alias("row"), F.posexplode(F.split("body", "\n")).alias("no", "raw"))
    trimmed = own.withColumn("line", F.trim("raw")).filter(F.col("line").rlike(SOLID)).drop("raw")
    place = F.struct(F.col("key").isNull().alias("x"), F.col("key").alias("key"), F.col("row").alias("row"), F.col("no").alias("no"))
    return trimmed.select(place.alias("place"), "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _looked_up(lines: DataFrame, few: DataFrame) -> DataFrame:
    """Join by line; ``few`` (a stored table of short rows) is broadcast only if its measured rows are few."""
    return lines.join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, ["h1", "h2"])


def _near(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2, near_place): distinct lines that have an earlier line one edit away, with the earliest of these.

    Lines one edit apart keep the first or the last half of the shorter one, so only lines that share such a half with
    another go on. They are numbered in order, dealt to tasks by the signs they hold, and emit every variant with one sign deleted. Lines of equal length that agree in a
    variant and its place differ in that place alone; a line that equals another's variant is one deletion away. So each
    group needs its earliest numbers only, and no pairs are made.
    """
    keyed = distinct.select("h1", "h2", F.explode(F.array(*[f"p{i}" for i in range(4)])).alias("half")).filter("half is not null")
    shared = keyed.groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo <> hi").select("half")
    company = keyed.join(shared, "half").select("h1", "h2").distinct()
    company = written(distinct.select("h1", "h2", "place").join(company, ["h1", "h2"], "left_semi"), "lines-with-company")
    texts = _looked_up(lines.select("h1", "h2", "line"), company).groupBy("h1", "h2").agg(F.first("line").alias("line"), F.first("place").alias("place"))
    chosen = written(positions(texts, ["place", "h1", "h2"], "at"), "lines-in-order")
    signs = chosen.agg(F.coalesce(F.sum(F.length("line").cast("long")), F.lit(0)).alias("n")).first()["n"]
    dealt = chosen.select("at", "line").repartition(1 + 2 * signs // TASK_VARIANTS, "at")
    variants = written(dealt.mapInArrow(_variants, "at long, kind byte, v long"), "line-variants").repartition("v")
    met = variants.groupBy("v").agg(
        F.min("at").alias("lo"), F.max("at").alias("hi"), F.min(F.when(F.col("kind") == 2, F.col("at"))).alias("first_whole"),
        F.min(F.when(F.col("kind") != 2, F.col("at"))).alias("first_cut")).filter("lo <> hi").drop("lo", "hi")
    # a whole line looks at those that lose a sign, and they at it; in groups of equal length all look at each other
    partner = F.when(F.col("kind") == 1, F.col("first_whole")).otherwise(F.col("first_cut"))
    best = variants.join(met, "v").select("at", partner.alias("partner")).filter("partner < at").groupBy("at").agg(F.min("partner").alias("partner"))
    other = chosen.select(F.col("at").alias("partner"), F.col("line").alias("other"), F.col("place").alias("near_place"))
    checked = chosen.join(best, "at").join(other, "partner")
    return checked.filter(F.levenshtein("line", "other", 1) == 1).select("h1", "h2", "near_place")


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", near_chars: int = NEAR_CHARS) -> DataFrame:
    """(key, row, exact, near): for every document with repeated lines, their numbers from 0. ``row`` is a
    hash of key and text.

    A line is repeated if an earlier line (by key, then line number; null keys last) is equal, or one edit away. Lines are compared
    without outer blanks; lines of blanks alone part paragraphs and stay. One edit counts for lines of ``near_chars`` characters on, from 1 if
    asked for. Lines of any length are compared whole. Of rows that repeat as a whole, all share one decision; an empty table gives
    an empty one.
    """
    if near_chars < 1:
        raise ValueError("an empty line has no neighbours")
    lines = _lines(docs, text, key)
    halves = [h.alias(f"p{i}") for i, h in enumerate(_halves(F.length("line"), near_chars))]
    firsts = lines.select("h1", "h2", "place", *halves).groupBy("h1", "h2").agg(
        F.min("place").alias("place"), F.count("*").alias("n"), *[F.first(f"p{i}").alias(f"p{i}") for i in range(4)])
    distinct = written(firsts, "distinct-lines")
    near = _near(lines, distinct)
    # only lines that are repeated or have a near one need to be looked up again
    known = distinct.select("h1", "h2", "place", "n").join(near, ["h1", "h2"], "left").filter("n > 1 or near_place is not null")
    known = written(known.select("h1", "h2", F.col("place").alias("first"), "near_place"), "repeated-lines")
    at = lines.select("h1", "h2", "place").join(known, ["h1", "h2"])
    exact = F.col("place") > F.col("first")
    judged = at.select("place", exact.alias("exact"), (~exact & F.coalesce(F.col("near_place") < F.col("place"), F.lit(False))).alias("near")).filter("exact or near")
    return judged.groupBy(F.col("place.key").alias("key"), F.col("place.row").alias("row")).agg(
        F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("place.no")))).alias("exact"),
        F.sort_array(F.collect_set(F.when(F.col("near"), F.col("place.no")))).alias("near"))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", near_chars: int = NEAR_CHARS) -> DataFrame:
    """Take repeated lines out of the texts. All columns stay, whatever their names; ``n_lines``, ``n_exact`` and ``n_near`` (lines of the
    text, equal and one-edit repeats taken out) are added and replace columns of these names. Texts without repeats
    are untouched; a null text stays null with no lines. A text whose lines all go becomes empty. Rows that repeat share one decision; an empty
    table gives an empty one."""
    if {text, key} & {"n_lines", "n_exact", "n_near"}:
        raise ValueError("text and key columns may not be named like the results")
    found = written(repeated_lines(docs, text, key, near_chars), "taken-lines")
    weight = found.agg(F.coalesce(F.sum(F.size("exact") + F.size("near") + 8), F.lit(0)).alias("n")).first()["n"]
    kept = [c for c in docs.columns if c not in ("n_lines", "n_exact", "n_near")]
    # the input row is one struct from here on, so that no column of it meets one of these helpers
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("input"))
    body, name = F.col("input")[text], F.col("input")[key]
    same = (F.xxhash64(name, F.coalesce(body, F.lit(""))) == F.col("row")) & name.eqNullSafe(F.col("key"))
    at = held.join(F.broadcast(found) if weight <= BROADCAST_NUMBERS else found, same, "left")
    none = F.array().cast("array<int>")
    at = at.select("input", "exact", "near", F.split(body, "\n").alias("parts"), F.concat(F.coalesce("exact", none), F.coalesce("near", none)).alias("gone"))
    rest = F.transform(F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone")), lambda i: F.get("parts", i))
    left = F.when(F.size("gone") > 0, F.array_join(rest, "\n")).otherwise(body)
    return at.select(
        *[left.alias(text) if c == text else F.col("input")[c].alias(c) for c in kept],
        F.when(body.isNull(), 0).otherwise(F.size("parts")).cast("long").alias("n_lines"),
        F.coalesce(F.size("exact"), F.lit(0)).cast("long").alias("n_exact"),
        F.coalesce(F.size("near"), F.lit(0)).cast("long").alias("n_near"))
