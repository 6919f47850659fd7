"""Sample frames, spectra, notes; detections; synthetic vectors; loan schedules."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabloom.functions.scalar import note_name, note_number
from tabloom.functions.vectors import doubles
from tabloom.plans.draws import uniform, whole
from tabloom.plans.ordered import _key_positions, windowed
from tabloom.plans.skew import join_rows
from tabloom.session import written


def frames(samples: DataFrame, signal: str, index: str, value: str, step: int, size: int,
           n_frames: Column | None = None) -> DataFrame:
    """Samples of every frame: (signal, frame, pos, value), frame f covers ``[f step - size, f step)``.

    A sample is copied to the few frames that cover it; positions before the signal start
    are absent and count as zero.
    """
    if n_frames is None:
        total = samples.groupBy(signal).agg(F.max(index).alias("_last"))
        samples = join_rows(samples, total, [signal])
        n_frames = F.floor((F.col("_last") + 1) / step)
    i = F.col(index)
    first = F.floor(i / step) + 1
    last = F.least(F.floor((i + size) / step), n_frames - 1)
    rows = samples.withColumn("frame", F.explode(F.when(first <= last, F.sequence(first, last))))
    return rows.select(signal, "frame", (i - (F.col("frame") * step - size)).cast("int").alias("pos"),
                       F.col(value).cast("double").alias("value"))


def spectrum(frame_rows: DataFrame, signal: str, rate: float, size: int) -> DataFrame:
    """Hann window and magnitude of the real transform per frame, scaled by the largest value of
    all frames: (signal, frame, bin, freq, magnitude).

    Samples meet per frame, at most ``size`` of them; a batch of frames is one array operation.
    """
    taper = (1 - F.cos(F.col("pos") * (2 * math.pi / size))) / 2
    kept = frame_rows.groupBy(signal, "frame").agg(
        F.collect_list("pos").alias("_pos"), F.collect_list(F.col("value") * taper).alias("_value"))

    @F.pandas_udf("array<double>")
    def magnitudes(pos: pd.Series, value: pd.Series) -> pd.Series:
        data = np.zeros((len(pos), size))
        rows = np.repeat(np.arange(len(pos)), [len(p) for p in pos])
        if len(rows):
            data[rows, np.concatenate(pos.to_list())] = np.concatenate(value.to_list())
        return pd.Series(list(np.abs(np.fft.rfft(data, axis=1))))

    # stored, because the largest value of all frames is needed before any of them is scaled
    raw = written(kept.select(signal, "frame", magnitudes("_pos", "_value").alias("mags")), "spectrum")
    flat = raw.select(signal, "frame", F.posexplode("mags").alias("bin", "_m"))
    top = raw.agg(F.max(F.array_max("mags"))).scalar()
    return flat.select(signal, "frame", "bin", (F.col("bin") * (rate / size)).alias("freq"),
                       F.coalesce(F.try_divide("_m", top), F.lit(0.0)).alias("magnitude"))


def top_notes(spectra: DataFrame, signal: str, k: int = 3, silence: float = 0.001) -> DataFrame:
    """The strongest bin of each note per frame, at most k notes, none in a silent frame."""
    heard = spectra.filter(F.col("freq") > 0).withColumn("note", note_name(note_number("freq")))
    per_note = heard.groupBy(signal, "frame", "note").agg(
        F.max_by(F.struct("freq", "bin", "magnitude"), F.struct("magnitude", -F.col("bin"))).alias("b"))
    loud = F.max("b.magnitude").over(W.partitionBy(signal, "frame"))
    place = F.row_number().over(W.partitionBy(signal, "frame").orderBy(F.desc("b.magnitude"), "b.bin"))
    return (per_note.withColumn("_loud", loud).withColumn("place", place)
            .filter((F.col("_loud") >= silence) & (F.col("place") <= k))
            .select(signal, "frame", "place", "note", "b.freq", "b.magnitude"))


def count_named(detections: DataFrame, keys: Sequence[str], name: str, wanted: str = "person") -> DataFrame:
    """Detections of one class per image or date; images without any give 0."""
    return detections.groupBy(*keys).agg(F.count_if(F.col(name) == wanted).alias("people"))


def count_zones(detections: DataFrame, keys: Sequence[str], name: str, x: str, cut: float,
                wanted: str = "person") -> DataFrame:
    """The same, split left and right of an x position."""
    hit = F.col(name) == wanted
    return detections.groupBy(*keys).agg(
        F.count_if(hit & (F.col(x) < cut)).alias("people_left"),
        F.count_if(hit & (F.col(x) >= cut)).alias("people_right"))


def above_score(detections: DataFrame, score: str, threshold: float = 0.25) -> DataFrame:
    return detections.filter(F.col(score) >= threshold)


def interpolate(df: DataFrame, keys: Sequence[str], order: str, vector: str, steps: int,
                include_start: bool = False, freeze: int = 1) -> DataFrame:
    """Equal steps between consecutive vectors: (keys, order, step, repeat, vector).

    Steps 1..n, or 0..n-1 with the start included. ``freeze`` repeats the very first and the
    very last step of a key.
    """

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        w = W.partitionBy(*part).orderBy(order)
        return frame.withColumns({
            "_a": doubles(vector), "_b": doubles(F.lead(vector).over(w)),
            "_first": F.lag(order).over(w).isNull(), "_last": F.lead(order, 2).over(w).isNull(),
        })

    pairs = windowed(df.select(*keys, order, vector), keys, [order], build, before=1, after=2).filter("_b is not null")
    lo, hi = (0, steps - 1) if include_start else (1, steps)
    out = pairs.withColumn("step", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
    edge = (F.col("_first") & (F.col("step") == lo)) | (F.col("_last") & (F.col("step") == hi))
    out = out.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.when(edge, F.lit(freeze)).otherwise(F.lit(1)))))
    part = F.col("step") / F.lit(float(steps))
    return out.select(*keys, order, "step", "repeat",
                      F.zip_with("_a", "_b", lambda x, y: x + (y - x) * part).alias("vector"))


def synthesize(df: DataFrame, label: str, key: str, vector: str, n: int, seed: int = 42) -> DataFrame:
    """n new vectors per class: from one random member towards another, a random weight in
    [0.2, 0.8) per element, five digits.

    Members are numbered per class, and drawn numbers meet them in two equi joins on
    (class, number): no pairs are formed.
    """
    members = _key_positions(df.select(label, key, vector), [label], [key])
    sizes = members.groupBy(label).agg(F.count("*").alias("_size"))
    draws = sizes.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(n))))
    draws = draws.withColumn("_class", whole(members, label))
    draws = draws.withColumns({f"_{s}": F.floor(uniform(seed + i, F.col("_class"), F.col("draw")) * F.col("_size")) for i, s in enumerate("ab")})
    a = members.select(label, F.col("_pos").alias("_a"), doubles(vector).alias("_va"))
    b = members.select(label, F.col("_pos").alias("_b"), doubles(vector).alias("_vb"))
    pairs = draws.join(a, [label, "_a"]).join(b, [label, "_b"])
    indexed = F.zip_with("_va", "_vb", lambda x, y: F.struct(x.alias("x"), y.alias("y")))

    def mix(p: Column, i: Column) -> Column:
        weight = 0.2 + 0.6 * uniform(seed + 2, F.col("_class"), F.col("draw"), i)
        return F.round(p["x"] + (p["y"] - p["x"]) * weight, 5)

    return pairs.select(label, "draw", F.transform(indexed, mix).alias("vector"))


def explore(df: DataFrame, key: str, vector: str, n: int = 25, seed: int = 42) -> DataFrame:
    """n candidates per vector: each element moves by a random amount in [-0.5, 0.5)."""
    out = df.withColumn("_key", whole(df, key)).withColumn("candidate", F.explode(F.sequence(F.lit(1), F.lit(n))))
    moved = F.transform(doubles(vector), lambda x, i: x + uniform(seed, F.col("_key"), F.col("candidate"), i) - 0.5)
    return out.select(key, "candidate", moved.alias("vector"))


def amortize(loans: DataFrame, keys: Sequence[str], principal: str, apr: float | str, term: int | str) -> DataFrame:
    """Schedule of level payments from the closed form of the balance.

    ``remaining`` is the balance before the payment. Loans without interest pay equal parts.
    """
    rate = (F.col(apr) if isinstance(apr, str) else F.lit(float(apr))) / 12
    months = F.col(term) if isinstance(term, str) else F.lit(term)
    base = loans.select(*keys, F.col(principal).cast("double").alias("_p"), rate.alias("_r"), months.alias("_n"))
    level = F.try_divide(F.col("_r") * F.col("_p"), 1 - F.pow(1 + F.col("_r"), -F.col("_n")))
    base = base.withColumn("payment", F.when(F.col("_r") == 0, F.col("_p") / F.col("_n")).otherwise(level))
    rows = base.withColumn("month", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    growth = F.pow(1 + F.col("_r"), F.col("month") - 1)
    left = F.when(F.col("_r") == 0, F.col("_p") - F.col("payment") * (F.col("month") - 1)).otherwise(
        F.col("_p") * growth - F.col("payment") * F.try_divide(growth - 1, F.col("_r")))
    rows = rows.withColumn("remaining", left).withColumn("interest", F.col("remaining") * F.col("_r"))
    return rows.select(*keys, "month", "remaining", "payment", "interest",
                       (F.col("payment") - F.col("interest")).alias("principal"))
