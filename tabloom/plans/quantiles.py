"""Exact quantiles by narrowing brackets: no task ever holds all values of a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabloom.plans.ordered import running_totals

#: Rows left in a bracket when its values are ranked.
FINAL_VALUES = 100_000


def exact_medians(df: DataFrame, cols: Sequence[str], final: int | None = None) -> dict[str, float | None]:
    """The exact median of every column, as a double whatever the column's type.

    Every pass is one aggregate over all columns: approximate percentiles around the middle give a narrow
    bracket, and counts below and inside it show where the middle ranks lie. Once a bracket
    holds few rows its counted values are ranked on Spark; only the two middle values of a column reach the driver.
    """
    cols = list(cols)
    if not cols:
        return {}
    final = final or FINAL_VALUES
    around = [0.499, 0.501]
    base = df.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
                  *[F.percentile_approx(c, around, 20000).alias(f"p_{i}") for i, c in enumerate(cols)]).first()
    result: dict[str, float | None] = {c: None for c in cols}
    state = {c: {"n": base[f"n_{i}"], "in": base[f"n_{i}"], "below": 0, "cut": base[f"p_{i}"]}
             for i, c in enumerate(cols) if base[f"n_{i}"] > 0}
    wide = list(state)
    while wide:
        tests = []
        for i, c in enumerate(wide):
            lo, hi = (F.lit(v) for v in state[c]["cut"])
            col = F.col(c)
            tests += [
                F.count(F.when(col < lo, 1)).alias(f"below_{i}"),
                F.count(F.when(col == lo, 1)).alias(f"at_lo_{i}"),
                F.count(F.when(col < hi, 1)).alias(f"below_hi_{i}"),
                F.count(F.when(col <= hi, 1)).alias(f"upto_{i}"),
                F.min(F.when(col > lo, col)).alias(f"next_{i}"),
                F.max(F.when(col < hi, col)).alias(f"prev_{i}"),
            ]
        counts = df.agg(*tests).first()
        for i, c in enumerate(wide):
            _narrow(state[c], state[c]["cut"], {k: counts[f"{k}_{i}"] for k in
                    ("below", "at_lo", "below_hi", "upto", "next", "prev")})
        for c in [c for c in state if "pair" in state[c]]:
            result[c] = sum(state.pop(c)["pair"]) / 2
        wide = [c for c in state if state[c]["in"] > final and state[c]["lo"] != state[c]["hi"]]
        if not wide:
            break
        probes = []
        for i, c in enumerate(wide):
            s = state[c]
            middle = ((s["n"] + 1) // 2 - s["below"]) / s["in"]
            shares = [max(0.0, middle - 0.001), min(1.0, middle + 0.001)]
            inside = F.when(F.col(c).between(F.lit(s["lo"]), F.lit(s["hi"])), F.col(c))
            probes.append(F.percentile_approx(inside, shares, 20000).alias(f"p_{i}"))
        cuts = df.agg(*probes).first()
        for i, c in enumerate(wide):
            state[c]["cut"] = cuts[f"p_{i}"]
    if state:
        result |= _middle_values(df, state)
    return result


def _middle_values(df: DataFrame, state: dict[str, dict]) -> dict[str, float]:
    """The middle ranks of all brackets by weighted ranks: a running count over their (column, value, count) rows, in one ordered pass."""
    names = list(state)
    pairs = F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v"),
                 F.col(c).between(F.lit(state[c]["lo"]), F.lit(state[c]["hi"])).alias("keep"))
        for i, c in enumerate(names)
    ])
    counted = df.select(F.explode(pairs).alias("x")).filter("x.keep").groupBy("x.i", "x.v").agg(F.count("*").alias("k"))
    upto = running_totals(counted, ["i", "v"], {"upto": "k"})
    picks, before = [], 0
    for i, c in enumerate(names):
        s = state[c]
        for which, rank in enumerate(((s["n"] + 1) // 2, s["n"] // 2 + 1)):
            at = rank - s["below"] + before
            picks.append(F.max(F.when((F.col("i") == i) & (F.col("upto") >= at) & (F.col("upto") - F.col("k") < at), F.col("v"))).alias(f"r{i}_{which}"))
        before += s["in"]
    row = upto.agg(*picks).first()
    return {c: (row[f"r{i}_0"] + row[f"r{i}_1"]) / 2 for i, c in enumerate(names)}


def _narrow(s: dict, cut: Sequence, seen: dict) -> None:
    """Move a bracket to the probed cut, then drop end values the middle ranks passed."""
    low, high = (s["n"] + 1) // 2, s["n"] // 2 + 1
    lo, hi = cut
    below, upto = seen["below"], seen["upto"]
    if below >= low or upto < high:
        raise RuntimeError("approximate ranks missed the middle")
    through_lo = below + seen["at_lo"]
    if high <= through_lo:
        hi, upto = lo, through_lo
    elif low <= through_lo:
        # one middle rank is the lower end, the other the next value: average the two
        s["pair"] = (lo, seen["next"])
    elif low > seen["below_hi"]:
        lo, below = hi, seen["below_hi"]
    elif high > seen["below_hi"]:
        s["pair"] = (seen["prev"], hi)
    else:
        lo, below, hi, upto = seen["next"], through_lo, seen["prev"], seen["below_hi"]
    s.update(lo=lo, hi=hi, below=below, **{"in": upto - below})
