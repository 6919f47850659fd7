"""MLlib pipelines, forecasts, fuzzy clustering and fuzzy scoring."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, Imputer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.plans.skew import join_rows
from tabloom.session import written


def pipeline(estimator, features: Sequence[str], categories: Sequence[str] = ()) -> Pipeline:
    """Index text inputs, assemble, fit."""
    stages = []
    if categories:
        stages.append(StringIndexer(inputCols=list(categories), outputCols=[f"{c}_code" for c in categories],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
    names = list(features) + [f"{c}_code" for c in categories]
    stages.append(VectorAssembler(inputCols=names, outputCol="features", handleInvalid="skip"))
    return Pipeline(stages=[*stages, estimator])


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, categories: Sequence[str] = (),
                 **params) -> PipelineModel:
    return pipeline(LogisticRegression(labelCol=label, **params), features, categories).fit(df)


#: Rows times trees that a partition of a forest's rows holds: a tree's draw of every row is kept with the row.
FOREST_DRAWS = 4_000_000


def fit_forest(df: DataFrame, features: Sequence[str], label: str, categories: Sequence[str] = (),
               trees: int = 50, seed: int = 0, **params) -> PipelineModel:
    """A forest of classes. The rows are stored once and dealt to as many partitions as their draws need, whatever the partitions they come in."""
    est = RandomForestClassifier(labelCol=label, numTrees=trees, seed=seed, maxBins=128, **params)
    weight = [params["weightCol"]] if "weightCol" in params else []
    rows = written(df.select(*dict.fromkeys([*features, *categories, label, *weight])), "forest-rows")
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows.count() * trees // FOREST_DRAWS))
    return pipeline(est, features, categories).fit(rows.repartition(parts))


#: Bins of an input (the forest picks its cuts from their bounds), and blocks that the rows of a cell of bins are dealt to.
FOREST_BINS, FOREST_BLOCKS = 128, 64


def fit_forest_reg(df: DataFrame, features: Sequence[str], label: str, trees: int = 100, seed: int = 0,
                   **params) -> PipelineModel:
    """A regression forest that learns from cells: rows with the same bins, dealt at random to ``FOREST_BLOCKS`` blocks.

    A block is one point, with its mean and its number of rows as weight; a split's gain needs no more of the rows than that, and a tree's
    bootstrap draws blocks. So the rows are read twice, and the levels of the trees pass over the points: at most one per row, and at most the
    blocks times the bins' combinations.
    """
    names, weight = list(features), params.pop("weightCol", None)
    shares = [i / FOREST_BINS for i in range(FOREST_BINS)]
    found = df.select(*[F.col(c).cast("double").alias(c) for c in names]).approxQuantile(names, shares, 0.25 / FOREST_BINS)
    inner = [sorted({v for v in values if np.isfinite(v)}) or [0.0] for values in found]
    coded = [f"{c}_bin" for c in names]
    bins = Bucketizer(splitsArray=[[-np.inf, *v, np.inf] for v in inner], inputCols=names, outputCols=coded, handleInvalid="skip")
    y, w = F.col(label).cast("double"), F.lit(1.0) if weight is None else F.col(weight).cast("double")
    # plain numbers again: the stage names its bins as categories
    dealt = bins.transform(df).select(*[(F.col(c) + 0.0).alias(c) for c in coded], y.alias("_y"), w.alias("_w"), F.floor(F.rand(seed) * FOREST_BLOCKS).alias("_block"))
    mean = F.when(F.bool_or(F.col("_y").isNull() | F.isnan("_y")), F.raise_error(F.lit("labels must not be null or NaN")).cast("double")).otherwise(
        F.sum(F.col("_w") * F.col("_y")) / F.sum("_w"))
    points = written(dealt.groupBy(*coded, "_block").agg(mean.alias(label), F.sum("_w").alias("_rows")).filter("_rows > 0").drop("_block"), "forest-points")
    est = RandomForestRegressor(labelCol=label, weightCol="_rows", numTrees=trees, seed=seed, **params)
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-points.count() * trees // FOREST_DRAWS))
    return PipelineModel([bins, *pipeline(est, coded).fit(points.repartition(parts)).stages])


def fit_gbt(df: DataFrame, features: Sequence[str], label: str, classes: int | None = None, rounds: int = 100,
            step: float = 0.1, seed: int = 0, **params) -> PipelineModel:
    """Boosted trees: regression without ``classes``, else classification (one against rest
    above two classes)."""
    if classes is None:
        est = GBTRegressor(labelCol=label, maxIter=rounds, stepSize=step, seed=seed, **params)
    else:
        est = GBTClassifier(labelCol=label, maxIter=rounds, stepSize=step, seed=seed, **params)
        if classes > 2:
            est = OneVsRest(classifier=est, labelCol=label)
    return pipeline(est, features).fit(df)


#: Rows of a partition at most, and rows that a perceptron multiplies at a time.
MLP_ROWS, MLP_BLOCK = 1_000_000, 4096


def fit_mlp(df: DataFrame, features: Sequence[str], label: str, classes: int, hidden: Sequence[int] = (50, 25),
            rounds: int = 100, seed: int = 0) -> PipelineModel:
    """A perceptron. Every round reads all rows, so they are stored once and dealt evenly to as many partitions as there are tasks at a time."""
    layers = [len(features), *hidden, classes]
    rows = written(df.select(*dict.fromkeys([*features, label])), "perceptron-rows")
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // MLP_ROWS))
    est = MultilayerPerceptronClassifier(labelCol=label, layers=layers, maxIter=rounds, seed=seed, blockSize=MLP_BLOCK)
    return pipeline(est, features).fit(rows.repartition(parts))


#: Inputs up to which least squares is searched from the folds' moments, and the settings that such a search may vary.
MOMENT_INPUTS = 64
_MOMENT_GRID = frozenset(["regParam", "elasticNetParam", "fitIntercept", "standardization", "maxIter", "tol"])


def _moment_points(df: DataFrame, names: Sequence[str], folds: int, seed: int) -> list[tuple] | None:
    """(values, weight, fold): few points with the number of rows, means and covariances of every fold's rows, from one pass.

    They lie at the mean and at both ends of the axes of the covariance. None if a value is null or not finite, or a fold has no rows.
    """
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)], F.floor(F.rand(seed) * folds).cast("int").alias("fold"))
    k = len(names)
    half = [(i, j) for i in range(k) for j in range(i, k)]
    stats = rows.groupBy("fold").agg(F.count("*").alias("n"), *[F.count(f"x{i}").alias(f"n{i}") for i in range(k)], *[F.avg(f"x{i}").alias(f"m{i}") for i in range(k)],
                                     *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in half]).collect()  # one row per fold
    points = []
    for r in stats:
        mean, cov = np.array([r[f"m{i}"] for i in range(k)], float), np.zeros((k, k))
        for i, j in half:
            cov[i, j] = cov[j, i] = np.nan if r[f"c{i}_{j}"] is None else r[f"c{i}_{j}"]
        if any(r[f"n{i}"] < r["n"] for i in range(k)) or not np.isfinite([*mean, *cov.ravel()]).all():
            return None
        scale = np.sqrt(np.where(np.diag(cov) > 0, np.diag(cov), 1.0))
        size, axes = np.linalg.eigh(cov / np.outer(scale, scale))
        ends = scale[:, None] * axes * np.sqrt(np.maximum(size, 0.0) * k)
        points += [((mean + sign * ends[:, i]).tolist(), r["n"] / (2 * k), r["fold"]) for i in range(k) for sign in (1, -1)]
    return points if len(stats) == folds else None


def grid_search(df: DataFrame, features: Sequence[str], label: str, grid: Mapping[str, Sequence],
                folds: int = 3, parallelism: int = 4, seed: int = 0, estimator=None):
    """Cross-validated search over a grid.

    Least squares, with any penalty, and its error depend on the rows of a fold only through their number, means and covariances. For it one pass
    over the rows gives those of every fold, and the search runs on a few weighted points that have the same. Other estimators, and rows with
    values that are null or not finite, are searched on the rows.
    """
    est = estimator or LinearRegression(labelCol=label)
    build = ParamGridBuilder()
    for name, values in grid.items():
        build = build.addGrid(est.getParam(name), list(values))
    settings = dict(estimatorParamMaps=build.build(), numFolds=folds, seed=seed, parallelism=parallelism)
    names, points = [*features, label], None
    if (isinstance(est, LinearRegression) and est.getLabelCol() == label and est.getFeaturesCol() == "features" and est.getLoss() == "squaredError"
            and est.getSolver() in ("auto", "normal") and not est.isDefined("weightCol") and len(names) <= MOMENT_INPUTS and set(grid) <= _MOMENT_GRID):
        points = _moment_points(df, names, folds, seed)
    if points is not None:
        inputs = [f"x{i}" for i in range(len(features))]
        made = df.sparkSession.createDataFrame([(*v, w, f) for v, w, f in points],
                                               ", ".join([*[f"{x} double" for x in inputs], f"`{label}` double", "_rows double", "_fold int"])).coalesce(1)
        data = VectorAssembler(inputCols=inputs, outputCol="features").transform(made)
        search = CrossValidator(estimator=est.copy({est.weightCol: "_rows"}), foldCol="_fold", evaluator=RegressionEvaluator(labelCol=label, weightCol="_rows"), **settings)
        return search.fit(data)
    data = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return CrossValidator(estimator=est, evaluator=RegressionEvaluator(labelCol=label), **settings).fit(data)


def fit_demand(windows: DataFrame, col: str, window: int, lag: int, extra: Sequence[str] = (),
               boosted: bool = False) -> tuple[PipelineModel, str]:
    """A regression from the supervised columns of one series to its value ``lag`` steps ahead."""
    safe = windows.toDF(*[_plain(c) for c in windows.columns])
    inputs = [_plain(f"{col}(t-{i})") for i in range(window, 0, -1)] + [_plain(f"{col}(t)"), *extra]
    label = _plain(f"{col}(t+{lag})")
    est = (GBTRegressor(labelCol=label, maxIter=20, seed=0) if boosted
           else LinearRegression(labelCol=label))
    return pipeline(est, inputs).fit(safe), label


def score_demand(model: PipelineModel, windows: DataFrame) -> DataFrame:
    return model.transform(windows.toDF(*[_plain(c) for c in windows.columns]))


def _plain(name: str) -> str:
    return name.replace("(t-", "_back").replace("(t+", "_ahead").replace("(t)", "_now").replace(")", "")


# fixed values: seasonal harmonics (period in days, order)
SEASONS = ((7.0, 3), (365.25, 10))


def _season_terms(day: Column) -> list[Column]:
    out = []
    for period, order in SEASONS:
        for k in range(1, order + 1):
            angle = day * float(2 * np.pi * k / period)
            out += [F.sin(angle), F.cos(angle)]
    return out


def _trend_terms(day: Column, length: Column, changes: int, reach: float) -> list[Column]:
    """Hinges at even candidate dates over the first part of the series: 0 before the date, then rising."""
    at = day / length
    return [F.greatest(F.lit(0.0), at - float(reach * (j + 1) / (changes + 1))) for j in range(changes)]


def _lasso(m: np.ndarray, xy: np.ndarray, w: np.ndarray, penalty: np.ndarray, sweeps: int = 2000, tol: float = 1e-10) -> np.ndarray:
    """Coordinate descent on 1/2 w'Mw - w'xy + sum of penalty |w|: each weight in turn takes its best value, shrunk towards 0."""
    for _ in range(sweeps):
        largest = 0.0
        for i in range(len(w)):
            if m[i, i] <= 0:
                continue
            pull = xy[i] - m[i] @ w + m[i, i] * w[i]
            new = np.sign(pull) * max(abs(pull) - penalty[i], 0.0) / m[i, i]
            largest, w[i] = max(largest, abs(new - w[i]) * np.sqrt(m[i, i])), new
        if largest < tol * (1 + np.sqrt(abs(xy @ w))):
            break
    return w


def seasonal_forecast(df: DataFrame, key: str | None, ts: str, y: str, periods: int, z: float = 1.2816, ridge: float = 1e-4, changes: int = 25,
                      reach: float = 0.8, change_penalty: float = 0.02, weights: bool = False) -> DataFrame:
    """Linear trend with change points, weekly and yearly harmonics; history plus ``periods`` days ahead with an 80 % interval from the residual
    spread.

    The trend may bend at ``changes`` even dates of the first ``reach`` of a series. The bends have an L1 penalty (``change_penalty`` times the rows
    and the spread of the series), so that most of them are exactly 0; the other terms are all but free. All keys are fitted together: tasks add up the normal equations of their
    rows, one aggregate per (key, cell) adds up the tasks, and only a (terms x terms) matrix per key is solved inside a task, by least
    squares and then coordinate descent. The series itself is never gathered. ``changes = 0`` gives the straight trend. With ``weights`` the
    result is (series, change, slope_change) instead, one row per candidate date.
    """
    base = df.withColumn("_key", F.col(key).cast("string") if key else F.lit("all"))
    base = base.select("_key", F.col(ts).cast("date").alias("date"), F.col(y).cast("double").alias("_y")).filter("_y is not null and date is not null")
    base = written(base.groupBy("_key", "date").agg(F.sum("_y").alias("_y")), "daily-series")
    span = base.groupBy("_key").agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    day = F.datediff("date", "_lo").cast("double")
    length = F.greatest(F.datediff("_hi", "_lo"), F.lit(1))
    hinges = _trend_terms(day, length, changes, reach)
    terms = F.array(F.lit(1.0), day / length, *hinges, *_season_terms(day))
    size = 2 + changes + sum(2 * order for _, order in SEASONS)
    rows = join_rows(base, span, ["_key"]).select("_key", "_lo", "_hi", "_y", terms.alias("_x"))

    def equations(batches):
        """Products of the terms and the value, upper half, added up per key of a batch."""
        half = np.triu_indices(size + 1)
        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            code, names = keys.indices.to_numpy(zero_copy_only=False), keys.dictionary.to_pylist()
            x = np.concatenate([batch.column(2).flatten().to_numpy().reshape(-1, size), batch.column(1).to_numpy()[:, None]], axis=1)
            for i, name in enumerate(names):
                own = x[code == i]
                cells = (own.T @ own)[half]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells), pa.string()), pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], names=["_key", "cell", "v"])

    cells = rows.select("_key", "_y", "_x").mapInArrow(equations, "_key string, cell int, v double").groupBy("_key", "cell").agg(F.sum("v").alias("v"))
    entry = F.array_sort(F.collect_list(F.struct("cell", "v")))
    sums = join_rows(cells.groupBy("_key").agg(F.transform(entry, lambda e: e["v"]).alias("v")), span, ["_key"])

    def solve(batches):
        half = np.triu_indices(size + 1)
        bent = np.arange(2, 2 + changes)
        for b in batches:
            fitted, sds = [], []
            for v in b["v"]:
                whole = np.zeros((size + 1, size + 1))
                whole[half] = v
                whole += np.triu(whole, 1).T
                m, xy, yy, n = whole[:size, :size], whole[:size, size], whole[size, size], whole[0, 0]
                eye = ridge * n * np.eye(size)
                penalty = np.zeros(size)
                w = np.zeros(size)
                free = np.setdiff1d(np.arange(size), bent)
                w[free] = np.linalg.solve((m + eye)[np.ix_(free, free)], xy[free])
                if changes:
                    spread = np.sqrt(max(yy / n - (xy[0] / n) ** 2, 0.0))
                    penalty[bent] = change_penalty * n * spread / max(changes, 1)
                    w = _lasso(m + ridge * 1e-3 * n * np.eye(size), xy, w, penalty)
                rss = max(yy - 2 * w @ xy + w @ m @ w, 0.0)
                fitted.append(w.tolist())
                sds.append(float(np.sqrt(rss / max(n - 1, 1))))
            yield pd.DataFrame({"_key": b["_key"], "_lo": b["_lo"], "_hi": b["_hi"], "_w": fitted, "_sd": sds})

    fits = sums.select("_key", "_lo", "_hi", "v").mapInPandas(solve, "_key string, _lo date, _hi date, _w array<double>, _sd double")
    if weights:
        bends = F.transform(F.sequence(F.lit(1), F.lit(max(changes, 1))), lambda j: F.struct(
            F.date_add("_lo", F.round(j * reach / (changes + 1) * length).cast("int")).alias("change"), F.get("_w", j + 1).alias("slope_change")))
        return fits.select(F.col("_key").alias("series"), F.inline(F.slice(bends, 1, changes) if changes else F.slice(bends, 1, 0)))
    days = fits.withColumn("date", F.explode(F.sequence("_lo", F.date_add("_hi", periods), F.expr("interval 1 day"))))
    fitted = F.aggregate(F.zip_with(terms, "_w", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    out = days.withColumn("yhat", fitted)
    return out.select(
        F.col("_key").alias("series"), "date", "yhat", (F.col("yhat") - z * F.col("_sd")).alias("yhat_lower"),
        (F.col("yhat") + z * F.col("_sd")).alias("yhat_upper"), (F.col("date") > F.col("_hi")).alias("future"))


def _memberships(cols: Sequence[str], centers: Sequence[Sequence[float]], m: float) -> list[str]:
    """SQL of a row's membership in each centre: inverse distances, normalised to sum 1."""
    power = 1.0 / (m - 1.0)
    weights = []
    for center in centers:
        gaps = [f"(`{name}` - {float(v)!r}D)" for name, v in zip(cols, center)]
        near = f"greatest({' + '.join(f'{g} * {g}' for g in gaps)}, 1e-16D)"
        weights.append(f"1D / {near}" if power == 1.0 else f"pow({near}, {-power!r}D)")
    total = " + ".join(weights)
    return [f"({w}) / ({total})" for w in weights]


def fuzzy_cmeans(df: DataFrame, cols: Sequence[str], c: int, m: float = 2.0, tol: float = 0.005,
                 max_iter: int = 1000, seed: int = 42) -> tuple[list[list[float]], float, int]:
    """Fuzzy c-means: (centres, partition coefficient, rounds).

    Each round is one aggregate of c x (k + 1) sums; only the centres reach the driver.
    Rounds stop when the memberships move by less than ``tol``.
    """
    # stored once, so that no round reads more than its columns
    data = written(df.select(*[F.col(x).cast("double").alias(x) for x in cols]).na.drop("any"), "cmeans")
    start = data.orderBy(F.xxhash64(F.lit(seed), *cols)).limit(c).collect()
    if len(start) < c:
        raise ValueError("fewer rows than centres")
    old = [[0.0] * len(cols)] * c
    now = [[float(r[x]) for x in cols] for r in start]
    fpc, rounds = 0.0, 0
    for rounds in range(1, max_iter + 1):
        before, u = _memberships(cols, old, m), _memberships(cols, now, m)
        # memberships are columns of their own, computed once per row
        rows = data.selectExpr(*[f"`{x}`" for x in cols], *[f"{v} AS u{k}" for k, v in enumerate(u)],
                               *[f"{v} AS b{k}" for k, v in enumerate(before)])
        aggs = []
        for k in range(c):
            w = f"u{k} * u{k}" if m == 2.0 else f"pow(u{k}, {float(m)!r}D)"
            aggs.append(f"sum({w}) AS w{k}")
            aggs += [f"sum({w} * `{x}`) AS s{k}_{i}" for i, x in enumerate(cols)]
        moved = " + ".join(f"(u{k} - b{k}) * (u{k} - b{k})" for k in range(c))
        share = " + ".join(f"u{k} * u{k}" for k in range(c))
        aggs += [f"sqrt(sum({moved})) AS moved", f"avg({share}) AS fpc"]
        row = rows.selectExpr(*aggs).first()
        old, now = now, [[row[f"s{k}_{i}"] / row[f"w{k}"] for i in range(len(cols))] for k in range(c)]
        fpc = row["fpc"]
        if rounds > 1 and row["moved"] < tol:
            break
    return now, fpc, rounds


def partition_coefficients(df: DataFrame, cols: Sequence[str], counts: Sequence[int] = range(2, 11), m: float = 2.0, tol: float = 0.005,
                           max_iter: int = 1000, start: Sequence[Sequence[float]] | None = None, seed: int = 42) -> DataFrame:
    """(c, coefficient, rounds): the partition coefficient of fuzzy c-means for each number of centres.

    All models that are still open move in the same scan of the rows: tasks add up the weights and weighted sums of every centre of every model, and
    one aggregate adds up the tasks. A model stops when its memberships move by less than ``tol``. Models start from the first
    ``c`` points of ``start``, by default rows in the order of a hash. Rows with a null are left out. What reaches the driver are centres:
    the sum of ``counts`` rows a round.
    """
    names, largest = list(cols), max(counts)
    data = written(df.select(*[F.col(x).cast("double").alias(x) for x in names]).na.drop("any"), "cmeans")
    if start is None:
        start = [tuple(r) for r in data.orderBy(F.xxhash64(F.lit(seed), *names)).limit(largest).collect()]
    if len(start) < largest:
        raise ValueError("fewer points than centres")
    centers = {c: np.array(start[:c], float) for c in counts}
    before: dict[int, np.ndarray | None] = {c: None for c in counts}
    found: dict[int, tuple[float, int]] = {}

    def memberships(x: np.ndarray, at: np.ndarray) -> np.ndarray:
        near = np.maximum(((x[:, None, :] - at) ** 2).sum(2), 1e-16) ** (-1.0 / (m - 1.0))
        return near / near.sum(1, keepdims=True)

    for number in range(1, max_iter + 1):
        models = {c: (centers[c], before[c]) for c in counts if c not in found}
        if not models:
            break

        def sums(batches):
            total = {c: np.zeros((c, len(names) + 3)) for c in models}
            for batch in batches:
                x = np.stack([v.to_numpy(zero_copy_only=False) for v in batch.columns], axis=1)
                for lo in range(0, len(x), 4096):
                    part = x[lo : lo + 4096]
                    for c, (now, old) in models.items():
                        u = memberships(part, now)
                        w = u**m
                        t = total[c]
                        t[:, 0] += w.sum(0)
                        t[:, 1 : 1 + len(names)] += w.T @ part
                        t[0, -2] += (u * u).sum()
                        t[0, -1] += ((u - memberships(part, old)) ** 2).sum() if old is not None else np.inf
            rows = [(c, k, t[k].tolist()) for c, t in total.items() for k in range(c)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.list_(pa.float64())))], names=["c", "k", "s"])

        parts = data.mapInArrow(sums, "c int, k int, s array<double>")
        width = len(names) + 3
        got = parts.groupBy("c", "k").agg(F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(width)]).alias("s")).collect()
        rows_all = data.count() if number == 1 else rows_all
        for c in models:
            mine = {r["k"]: r["s"] for r in got if r["c"] == c}
            fpc, moved = mine[0][-2] / max(rows_all, 1), mine[0][-1] ** 0.5
            before[c] = centers[c]
            centers[c] = np.array([[mine[k][1 + i] / mine[k][0] for i in range(len(names))] for k in range(c)])
            if moved < tol or number == max_iter:
                found[c] = fpc, number
    rows = [(int(c), float(found[c][0]), int(found[c][1])) for c in counts]
    return df.sparkSession.createDataFrame(rows, "c int, coefficient double, rounds int")


def fuzzy_assign(df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]], m: float = 2.0) -> DataFrame:
    """Add the membership array and the centre with the largest one."""
    u = F.array(*[F.expr(v) for v in _memberships(cols, centers, m)])
    return df.withColumn("membership", u).withColumn(
        "cluster", (F.array_position("membership", F.array_max("membership")) - 1).cast("int"))


# fixed values: underwriting variables; bells (centre, width) and cones (centre, radius) on 0..40 step 0.1
BMI = {"under": 9.25, "fit": 21.75, "over": 27.5, "obese": 35.0}
BMI_SD = 3.0
BP = {"norm": 0.0, "pre": 10.0, "hyp": 20.0, "shyp": 30.0}
BP_SD = 2.5
A1C = {"l": 4.0, "n": 5.25, "h": 7.0}
RATING = {"DC": 10.0, "ST": 5.0, "PF": 1.0}
CONE_RADIUS = 5.0
UNIVERSE_STEPS = 400


def bell(x: Column, center: float, sd: float) -> Column:
    return F.exp(-F.pow((x - center) / sd, 2.0) / 2)


def cone(x: Column, center: float, radius: float = CONE_RADIUS) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.abs(x - center) / radius)


def _centroids(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Centroid of the union of the cut cones, for many rows at a time: the steps of the universe are added one after another."""
    grid = [(i / 10, [max(0.0, 1 - abs(i / 10 - v) / CONE_RADIUS) for v in RATING.values()]) for i in range(UNIVERSE_STEPS + 1)]
    for batch in batches:
        # a rule without a value does not cut its cone
        cuts = [np.nan_to_num(c.cast(pa.float64()).to_numpy(zero_copy_only=False), nan=np.inf, posinf=np.inf, neginf=-np.inf) for c in batch]
        above, below = np.zeros(len(cuts[0])), np.zeros(len(cuts[0]))
        for x, cones in grid:
            if any(cones):
                h = np.max([np.minimum(c, cut) for c, cut in zip(cones, cuts)], axis=0)
                above += x * h
                below += h
        some = below != 0
        yield pa.array(np.divide(above, below, out=np.zeros(len(above)), where=some), mask=~some)


def fuzzy_rating(df: DataFrame, bmi: str = "bmi", a1c: str = "a1c", bp: str = "bp") -> DataFrame:
    """Underwriting score: or = max, and = min, rules cut their rating set, centroid of the union."""
    weight = {k: bell(F.col(bmi), v, BMI_SD) for k, v in BMI.items()}
    sugar = {k: cone(F.col(a1c), v) for k, v in A1C.items()}
    press = {k: bell(F.col(bp), v, BP_SD) for k, v in BP.items()}
    fired = df.withColumns({
        "_DC": F.greatest(weight["under"], weight["obese"], sugar["l"]),
        "_ST": F.greatest(weight["over"], sugar["n"], press["pre"]),
        "_PF": F.least(weight["fit"], sugar["n"], press["norm"]),
    })
    center = F.arrow_udf(_centroids, "double")("_DC", "_ST", "_PF")
    return fired.withColumn("rating", center).drop("_DC", "_ST", "_PF")
