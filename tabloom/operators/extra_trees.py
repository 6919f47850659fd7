"""Extremely randomised trees, grown level by level for all trees at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.plans.draws import uniform
from tabloom.session import written


@dataclass
class ExtraTrees:
    """``nodes`` (tree, node, feature, cut, n, n_left, gain): inner nodes; node i has the children 2 i and 2 i + 1, the root is 1."""

    nodes: DataFrame
    names: list[str]
    trees: int

    def importances(self) -> DataFrame:
        """(name, importance): a feature's share of the impurity that its splits take away, averaged over the trees that have splits.
        Sums to 1; without any split all are 0."""
        per = self.nodes.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        total = self.nodes.groupBy("tree").agg(F.sum("gain").alias("total"))
        grown = total.agg(F.greatest(F.count("*"), F.lit(1)).alias("k")).first()["k"]  # trees with splits
        share = per.join(total, "tree").groupBy("feature").agg((F.sum(F.col("gain") / F.col("total")) / grown).alias("importance"))
        names = self.nodes.sparkSession.createDataFrame(list(enumerate(self.names)), "feature int, name string")
        return names.join(share, "feature", "left").select("name", F.coalesce("importance", F.lit(0.0)).alias("importance")).orderBy(
            F.desc("importance"), "name")


class _Router:
    """Which node a row has reached in every tree. As many cells as trees times the nodes of the levels, both parameters."""

    def __init__(self, trees: int, depth: int):
        self.feature = np.full((trees, 1 << depth), -1, np.int32)
        self.cut = np.zeros((trees, 1 << depth))

    def nodes(self, x: np.ndarray, level: int) -> np.ndarray:
        """(rows, trees): node of the level, 0 where a row has ended above it."""
        trees = np.arange(len(self.feature))
        node = np.ones((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(level):
            f = self.feature[trees, node]
            right = x[rows, np.maximum(f, 0)] > self.cut[trees, node]
            node = np.where(f >= 0, 2 * node + right, 0)
        return node


def _matrix(batch: pa.RecordBatch, first: int, n: int) -> np.ndarray:
    return np.stack([batch.column(first + i).to_numpy(zero_copy_only=False) for i in range(n)], axis=1)


def fit_extra_trees(df: DataFrame, features: Sequence[str], y: str, classes: Sequence | None = None, trees: int = 50, depth: int = 6,
                    min_rows: int = 2, seed: int = 0) -> ExtraTrees:
    """Grow ``trees`` trees of at most ``depth`` levels of splits.

    In each node every feature draws one cut between its least and largest value there; the feature whose cut takes away most
    impurity (variance of ``y``, or Gini impurity with ``classes``) splits it. A level of all trees is two scans: one
    for the ranges of the open nodes, one for the sums left of all their cuts. Tasks add up their own rows, one aggregate per scan adds up
    the tasks, and the cuts are scored there. The draws depend on seed, tree, node and feature only, so the trees do not depend on
    partitions. Only splits reach the driver: trees x 2^depth at most. Rows with a null or NaN in a used column are left out.
    """
    names, k = list(features), 1 if classes is None else len(classes)
    used = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)], F.col(y).alias("y"))
    used = used.filter(" and ".join([f"not isnan(x{i}) and x{i} is not null" for i in range(len(names))] + ["y is not null"]))
    if classes is None:
        targets = [F.col("y").cast("double")]
        used = used.filter(~F.isnan(F.col("y").cast("double")))
    else:
        targets = [(F.col("y") == c).cast("double") for c in classes]
    middle = used.agg(*[F.coalesce(F.avg(v), F.lit(0.0)).alias(f"m{i}") for i, v in enumerate(targets)]).first()
    data = written(used.select(*[f"x{i}" for i in range(len(names))], *[(v - F.lit(middle[f"m{i}"])).alias(f"y{i}") for i, v in enumerate(targets)]), "tree-rows")
    spread = data.agg(F.coalesce(sum((F.sum(F.col(f"y{i}") * F.col(f"y{i}")) for i in range(1, k)), F.sum(F.col("y0") * F.col("y0"))), F.lit(0.0)).alias("s")).first()["s"]
    router, grown, n = _Router(trees, depth), None, len(names)

    for level in range(depth):
        low, width = 1 << level, 1 << level

        def places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            x, t = _matrix(batch, 0, n), _matrix(batch, n, k)
            node = router.nodes(x, level)
            rows, tree = np.nonzero(node)
            return x, t, rows, tree * width + node[rows, tree] - low

        def out(found: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
            arrays = [pa.array((found // width).astype(np.int32)), pa.array((found % width + low).astype(np.int32))]
            for v in columns.values():
                arrays.append(pa.array(v[found]) if v.ndim == 1 else pa.array(list(v[found]), pa.list_(pa.float64())))
            return pa.RecordBatch.from_arrays(arrays, names=["tree", "node", *columns])

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = trees * width
            count, sums = np.zeros(cells, np.int64), np.zeros((cells, k))
            lo, hi = np.full((cells, n), np.inf), np.full((cells, n), -np.inf)
            for batch in batches:
                x, t, rows, at = places(batch)
                count += np.bincount(at, minlength=cells)
                for i in range(k):
                    sums[:, i] += np.bincount(at, t[rows, i], cells)
                for i in range(n):
                    np.minimum.at(lo[:, i], at, x[rows, i])
                    np.maximum.at(hi[:, i], at, x[rows, i])
            yield out(np.flatnonzero(count), {"n": count, "sums": sums, "lo": lo, "hi": hi})

        each = lambda c, fn, m: F.array(*[fn(F.get(c, F.lit(i))) for i in range(m)]).alias(c)
        part = data.mapInArrow(ranges, "tree int, node int, n long, sums array<double>, lo array<double>, hi array<double>")
        whole = part.groupBy("tree", "node").agg(F.sum("n").alias("n"), each("sums", F.sum, k), each("lo", F.min, n), each("hi", F.max, n))
        whole = written(whole.filter(F.col("n") >= min_rows), "open-nodes")
        cuts = np.full((trees, width, n), np.nan)
        for r in whole.select("tree", "node", "lo", "hi").collect():  # trees x 2^level at most
            for i, (a, b) in enumerate(zip(r["lo"], r["hi"])):
                if a < b:
                    cuts[r["tree"], r["node"] - low, i] = a + uniform(seed, r["tree"], r["node"], i) * (b - a)
        if not np.isfinite(cuts).any():
            break
        flat = cuts.reshape(-1, n)

        def lefts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = trees * width
            count, sums = np.zeros((cells, n), np.int64), np.zeros((cells, n, k))
            for batch in batches:
                x, t, rows, at = places(batch)
                for i in range(n):
                    left = x[rows, i] <= flat[at, i]
                    here = at[left]
                    count[:, i] += np.bincount(here, minlength=cells)
                    for j in range(k):
                        sums[:, i, j] += np.bincount(here, t[rows[left], j], cells)
            found = np.flatnonzero(count.any(1))
            yield out(found, {"n_left": count.astype(float), "left": sums.reshape(cells, n * k)})

        part = data.mapInArrow(lefts, "tree int, node int, n_left array<double>, left array<double>")
        left = part.groupBy("tree", "node").agg(each("n_left", F.sum, n), each("left", F.sum, n * k))
        at = lambda c, i: F.get(c, F.lit(i))
        scored = []
        for i in range(n):
            nl = at("n_left", i)
            nr = F.col("n") - nl
            gain = sum((at("left", i * k + j) * at("left", i * k + j) / nl + (at("sums", j) - at("left", i * k + j)) * (at("sums", j) - at("left", i * k + j)) / nr
                        - at("sums", j) * at("sums", j) / F.col("n") for j in range(k)), F.lit(0.0))
            scored.append(F.when((nl > 0) & (nr > 0), F.struct(gain.alias("gain"), F.lit(-i).alias("minus"), nl.cast("long").alias("n_left"))))
        best = F.array_max(F.array_compact(F.array(*scored)))
        split = whole.join(left, ["tree", "node"]).withColumn("best", best).filter(F.col("best.gain") > 1e-12 * spread)
        made = written(split.select("tree", "node", (-F.col("best.minus")).alias("feature"), "n", F.col("best.n_left").alias("n_left"), F.col("best.gain").alias("gain")), "splits")
        rows = made.select("tree", "node", "feature").collect()  # trees x 2^level at most
        for r in rows:
            router.feature[r["tree"], r["node"]] = r["feature"]
            router.cut[r["tree"], r["node"]] = cuts[r["tree"], r["node"] - low, r["feature"]]
        grown = made if grown is None else grown.unionByName(made)
        if not rows:
            break

    if grown is None:
        grown = df.sparkSession.createDataFrame([], "tree int, node int, feature int, n long, n_left long, gain double")
    inner = [(t, int(i), float(router.cut[t, i])) for t in range(trees) for i in np.flatnonzero(router.feature[t] >= 0)]
    cut = df.sparkSession.createDataFrame(inner, "tree int, node int, cut double")
    return ExtraTrees(written(grown.join(cut, ["tree", "node"]), "tree-nodes"), names, trees)
