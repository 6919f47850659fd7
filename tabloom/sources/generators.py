"""Random rows of known functions and distributions, generated in the tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabloom.functions.scalar import normal_quantile_sql, normal_tail_sql
from tabloom.plans.draws import PRIME_B, uniform, whole

# fixed values: the test functions with their inputs and ranges (expression, ranges of x1..xk)
FUNCTIONS = {
    "diff": ("x1 - x2", [(0.0, 1.0), (0.01, 1.0)]),
    "log": ("ln(x1)", [(1.0, 100.0)]),
    "poly": ("1 + 5*x1 + 8*pow(x1, 2)", [(0.0, 2.0)]),
    "poly2": ("2 + 5*pow(x1*x2, 2) + 4*x1*x2", [(0.0, 1.0), (0.0, 1.0)]),
    "pow": ("pow(x1, 2)", [(1.0, 10.0)]),
    "ratio": ("try_divide(x1, x2)", [(0.0, 1.0), (0.01, 1.0)]),
    "r_diff": ("try_divide(x1 - x2, x3 - x4)", [(1.0, 10.0)] * 4),
    "r_poly": ("try_divide(1, 5*x1 + 8*pow(x1, 2))", [(1.0, 10.0)]),
    "r_poly2": ("try_divide(1, 2 + 5*pow(x1*x2, 2) + 4*x1*x2)", [(0.0, 1.0), (0.0, 1.0)]),
    "sqrt": ("sqrt(x1)", [(1.0, 100.0)]),
}


def generate(base: DataFrame, ranges: Sequence[tuple[float, float]], expr: str, seed: int = 42,
             tries: int = 4, keys: Sequence[str] | None = None) -> DataFrame:
    """One uniform input tuple with ``y = expr`` per row of ``base`` (a table, or
    ``spark.range(n)``); inputs without a finite value are redrawn ``tries`` times, then null.

    The draws come from the row's ``keys`` (all columns by default), so a row gets the same numbers in whatever partition it is, and again
    when a lost task is run anew. Every row holds its own redraws and keeps the first good one, so nothing has to be
    counted or cut afterwards. ``expr`` should use ``try_divide`` for divisions.
    """
    made, picks = base, []
    width, own = len(ranges), [whole(base, k) for k in (keys or base.columns)]
    for t in range(tries):
        xs = {f"x{i + 1}": F.lit(lo) + uniform(seed + t * width + i, *own) * (hi - lo)
              for i, (lo, hi) in enumerate(ranges)}
        made = made.withColumns(xs).withColumn("y", F.expr(f"cast({expr} as double)"))
        made = made.withColumn(f"_t{t}", F.struct(*xs, "y")).drop(*xs, "y")
        y = F.col(f"_t{t}.y")
        picks.append(F.when(y.isNotNull() & ~F.isnan(y), F.col(f"_t{t}")))
    # a row whose draws were all without a value stays, with nulls
    return made.withColumn("_r", F.coalesce(*picks)).select(*base.columns, "_r.*")


def generate_mixture(base: DataFrame, centers: Sequence[Sequence[float]],
                     sigmas: Sequence[Sequence[float]], seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """For every row of ``base`` one Gaussian point per centre: x1..xk and the centre number.

    A point is the normal quantile of a uniform draw from the row's ``keys`` (all columns by default), see ``generate``.
    """
    out, own = None, [whole(base, k) for k in (keys or base.columns)]
    for k, (center, sigma) in enumerate(zip(centers, sigmas)):
        part = base
        for i, (m, s) in enumerate(zip(center, sigma)):
            part = part.withColumn("_p", uniform(seed + 100 * k + i, *own) + 0.5 / PRIME_B).withColumn("_tail", F.expr(normal_tail_sql("_p")))
            part = part.withColumn(f"x{i + 1}", F.lit(float(m)) + F.expr(normal_quantile_sql("_p", "_tail")) * float(s)).drop("_p", "_tail")
        part = part.withColumn("center", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return out
