"""Feature importance ranks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.functions.scalar import clip
from tabloom.plans.draws import permuted_position
from tabloom.plans.ordered import positions
from tabloom.session import written


def _long(one: DataFrame, features: Sequence[str], value: str) -> DataFrame:
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias(value)) for c in features])))


def corr_rank(df: DataFrame, features: Sequence[str], y: str) -> DataFrame:
    """abs(correlation) with the target, normalised to sum 1, largest first."""
    one = df.agg(*[F.abs(F.corr(c, y)).alias(c) for c in features])
    total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in features[1:]),
                F.coalesce(F.col(f"`{features[0]}`"), F.lit(0.0)))
    shares = one.select(*[(F.col(f"`{c}`") / total).alias(c) for c in features])
    return _long(shares, features, "importance").orderBy(F.desc("importance"), "name")


def weight_rank(spark: SparkSession, names: Sequence[str], weights: Sequence[Sequence[float]]) -> DataFrame:
    """Norm of each input's weights, normalised to sum 1; a row of weights per input."""
    norms = [sum(float(w) ** 2 for w in row) ** 0.5 for row in weights]
    total = sum(norms) or 1.0
    rows = [(n, v / total) for n, v in zip(names, norms)]
    return spark.createDataFrame(rows, "name string, importance double").orderBy(F.desc("importance"), "name")


def perturbed(df: DataFrame, features: Sequence[str], seed: int = 42, order: Sequence[str] | None = None) -> DataFrame:
    """A copy of every row per feature, in which that feature comes from another row.

    Rows are numbered in ``order`` (all columns by default; rows that are equal in it are interchangeable). The value of row q goes to row
    pi(q), where pi is a permutation of all positions, another one for each feature, computed from the position alone. So each
    column is permuted by one equi join on the position, whose keys are all distinct; every row and value is shuffled once, and the copies
    are made after that.
    """
    names = list(df.columns)
    placed = positions(df, list(order or names), "_at")
    n = placed.count()
    joined = placed
    for i, f in enumerate(features):
        moved = placed.select(permuted_position(F.col("_at"), n, seed + i).alias(f"_to_{i}"), F.col(f).alias(f"_m_{i}"))
        joined = joined.join(moved, F.col("_at") == F.col(f"_to_{i}")).drop(f"_to_{i}")
    copies = joined.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    values = {f: F.when(F.col("feature") == f, F.col(f"_m_{i}")).otherwise(F.col(f)) for i, f in enumerate(features)}
    return copies.select(*[c for c in names if c not in features], "feature", *[v.alias(f) for f, v in values.items()])


def perturbation_rank(df: DataFrame, features: Sequence[str], predict: Callable[[DataFrame], DataFrame],
                      error: Column, seed: int = 42, to_sum: bool = False, order: Sequence[str] | None = None) -> DataFrame:
    """(name, error, importance): the error after permuting one input, relative to the largest
    (or to the sum). All features are scored in one pass. ``error`` is any column: a squared difference, or ``row_log_loss`` for classes."""
    scored = predict(perturbed(df, features, seed, order))
    errors = scored.groupBy(F.col("feature").alias("name")).agg(F.avg(error).alias("error"))
    base = errors.agg(F.sum("error") if to_sum else F.max("error")).scalar()
    return errors.withColumn("importance", F.col("error") / base).orderBy(F.desc("importance"), "name")


def forest_importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "name string, importance double").orderBy(F.desc("importance"), "name")


def hybrid_rank(weights: DataFrame, perturb: DataFrame, corr: DataFrame, d: float = 0.0) -> DataFrame:
    """weight + perturbation * d + correlation * (1 - d), each as shares that sum to 1, normalised to sum 1."""
    total = perturb.agg(F.sum("importance")).scalar()
    joined = (weights.select("name", F.col("importance").alias("w"))
              .join(perturb.select("name", (F.col("importance") / total).alias("p")), "name")
              .join(corr.select("name", F.col("importance").alias("c")), "name"))
    raw = joined.select("name", (F.col("w") + F.col("p") * d + F.col("c") * (1 - d)).alias("raw"))
    return raw.select("name", (F.col("raw") / raw.agg(F.sum("raw")).scalar()).alias("importance")).orderBy(
        F.desc("importance"), "name")


def row_log_loss(y: str, p: str, eps: float = 1e-15) -> Column:
    """Log loss of one row: ``y`` is 1 or another value, ``p`` the predicted share of ones."""
    q = clip(F.col(p), eps, 1 - eps)
    return F.when(F.col(y) == 1, -F.log(q)).otherwise(-F.log(1 - q))


def _standard(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns as z scores (population deviation); a constant column is 0."""
    one = df.agg(*[s(c).alias(f"{k}{i}") for i, c in enumerate(names) for k, s in (("m", F.avg), ("s", F.stddev_pop))]).first()
    z = {c: (F.col(c) - F.lit(one[f"m{i}"])) / F.lit(one[f"s{i}"]) if one[f"s{i}"] else F.lit(0.0) for i, c in enumerate(names)}
    return df.withColumns(z)


def rank_stability(df: DataFrame, features: Sequence[str], y: str, lengths: Sequence[int], baseline: DataFrame | None = None, full: int = 500,
                   kind: str = "weight", d: float = 0.5, seed: int = 42, order: Sequence[str] | None = None) -> DataFrame:
    """(length, distance): how far a rank is from the baseline after each training length.

    ``kind`` is weight, perturb or hybrid (see ``hybrid_rank``). A linear model on standardised columns is trained by gradient steps of 1 / features. These need
    the correlations only, which one pass gives for all lengths, and the perturbation errors are quadratic forms of the weights, whose moments one
    pass over the permuted rows gives. Training and ranks are expressions over that one row of moments. The baseline (name,
    importance) defaults to the weight rank after ``full`` steps.
    """
    names, k, last = list(features), len(features), max([*lengths, full])
    used = {*names, y}
    kept = [*names, y, *[c for c in order or [] if c not in used]]
    rows = _standard(df.select(*[F.col(c).cast("double").alias(c) if c in used else c for c in kept]), [*names, y])
    mean = lambda a, b: F.coalesce(F.avg(F.col(a) * F.col(b)), F.lit(0.0))
    stats = rows.agg(F.array(*[F.array(*[mean(a, b) for b in names]) for a in names]).alias("gram"), F.array(*[mean(a, y) for a in names]).alias("goal"))
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda p, q: p * q), F.lit(0.0), lambda s, x: s + x)
    zeros = F.array_repeat(F.lit(0.0), k)
    step = lambda w: F.zip_with(w, F.zip_with(F.transform(F.col("gram"), lambda g: dot(g, w)), F.col("goal"), lambda g, t: (t - g) / k), lambda x, m: x + m)
    grown = F.aggregate(F.sequence(F.lit(1), F.lit(last)), F.struct(zeros.alias("w"), F.array(zeros).alias("all")),
                        lambda s, _: F.struct(step(s["w"]).alias("w"), F.concat(s["all"], F.array(step(s["w"]))).alias("all")))
    wanted = F.array(*[F.lit(int(n)) for n in dict.fromkeys([*lengths, full])])
    trained = written(stats.select("gram", "goal", grown["all"].alias("all")).select("gram", "goal", F.explode(wanted).alias("length"), "all")
                      .select("length", F.get("all", F.col("length")).alias("w"), "gram", "goal"), "trained-weights")

    def shares(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
        return F.transform(values, lambda v: F.when(total > 0, v / total).otherwise(0.0))

    weight = shares(F.transform("w", F.abs))
    value = weight
    if kind != "weight":
        moved = perturbed(rows, names, seed, order)
        # after the permutation of one input: its products with the other inputs and with the target
        picked = F.coalesce(*[F.when(F.col("feature") == f, F.col(f)) for f in names])
        per = moved.groupBy("feature").agg(F.array(*[F.avg(picked * F.col(b)) for b in names]).alias("cross"), F.avg(picked * F.col(y)).alias("with_y"))
        at = {r["feature"]: r for r in per.collect()}  # one row per input
        errors = []
        for i, f in enumerate(names):
            w = F.col("w")
            terms = [1 - 2 * w[i] * at[f]["with_y"]] + [-2 * w[a] * F.col("goal")[a] for a in range(k) if a != i]
            terms += [w[a] * w[b] * (F.col("gram")[a][b] if (a == i) == (b == i) else F.lit(at[f]["cross"][a + b - i])) for a in range(k) for b in range(k)]
            errors.append(sum(terms[1:], terms[0]))
        perturb = shares(F.array(*errors))
        corr = shares(F.transform("goal", F.abs))
        value = perturb if kind == "perturb" else shares(F.zip_with(weight, F.zip_with(perturb, corr, lambda p, c: p * d + c * (1 - d)), lambda a, b: a + b))
    labels = F.array(*[F.lit(n) for n in names])
    long = trained.select("length", F.inline(F.arrays_zip(labels.alias("name"), value.alias("importance"))))
    if baseline is None:
        baseline = trained.filter(F.col("length") == full).select(F.inline(F.arrays_zip(labels.alias("name"), weight.alias("importance"))))
    other = baseline.select("name", F.col("importance").alias("_b"))
    gap = F.col("importance") - F.col("_b")
    wanted_lengths = [int(n) for n in lengths]
    return long.filter(F.col("length").isin(wanted_lengths)).join(other, "name").groupBy("length").agg(F.sqrt(F.sum(gap * gap)).alias("distance"))
