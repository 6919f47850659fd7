"""Gradient boosting on histograms, with an evaluation history and early stopping."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.session import written

#: Rounds after which the margins are stored, so that a scan walks at most so many rounds of trees.
STORE_ROUNDS = 20


@dataclass
class Tree:
    """A complete tree of ``depth`` levels as arrays over node numbers (root 1, children 2 i and 2 i + 1). A node without a split
    passes its rows on to the left."""

    feature: np.ndarray
    cut_bin: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            node = 2 * node + (bins[rows, self.feature[node]] > self.cut_bin[node])
        return node


@dataclass
class Boosted:
    """``trees[r][k]``: tree of round r and class k; ``history`` holds (round, train, eval) mean losses, round 0 before any tree."""

    names: list[str]
    cuts: list[np.ndarray]
    start: np.ndarray
    depth: int
    classes: list | None
    trees: list[list[Tree]] = field(default_factory=list)
    history: list[tuple[int, float | None, float | None]] = field(default_factory=list)
    best_round: int = 0

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin numbers: 0 for a missing value, then by the cuts; a value equal to a cut is below it."""
        out = np.zeros(x.shape, np.int16)
        for i, cuts in enumerate(self.cuts):
            known = ~np.isnan(x[:, i])
            out[known, i] = 1 + np.searchsorted(cuts, x[known, i], "left")
        return out

    def margins(self, bins: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        out = np.zeros((len(bins), len(self.start)))
        for of_round in self.trees[first:last]:
            for k, tree in enumerate(of_round):
                out[:, k] += tree.value[tree.leaves(bins, self.depth)]
        return out

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, "round int, train double, eval double")

    def predict(self, df: DataFrame, name: str = "prediction", rounds: int | None = None) -> DataFrame:
        """Add the prediction of the best round (or of ``rounds``): a value, or the likeliest class. Missing values have a bin of their own."""
        last = self.best_round if rounds is None else rounds
        kind = "double" if self.classes is None else "int"

        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.flatten()], axis=1)
                m = self.start + self.margins(self.bins(x), 0, last)
                yield pa.array(m[:, 0]) if self.classes is None else pa.array(m.argmax(1).astype(np.int32))

        given = F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.names)])
        out = F.arrow_udf(score, kind)(given)
        if self.classes is not None:
            out = F.get(F.array(*[F.lit(c) for c in self.classes]), out)
        return df.withColumn(name, out)


def _softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _best_splits(hist: np.ndarray, reg: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From sums (nodes, features, bins, [gradient, hessian]): feature, cut bin and gain of each node's best split; gain 0 without one."""
    left = hist.cumsum(2)
    whole = left[:, :1, -1:, :]
    right = whole - left
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + reg + 1e-300)
    gain = score(left) + score(right) - score(whole)
    gain[(left[..., 1] < least) | (right[..., 1] < least)] = 0
    flat = gain.reshape(len(hist), -1)
    best = flat.argmax(1)
    return best // hist.shape[2], best % hist.shape[2], flat[np.arange(len(hist)), best]


def fit_boosted(df: DataFrame, features: Sequence[str], label: str, classes: Sequence | None = None, held_out: Column | None = None,
                rounds: int = 100, depth: int = 4, step: float = 0.1, bins: int = 64, reg: float = 0.0, least: float = 1.0,
                patience: int | None = None) -> Boosted:
    """Boosted trees: squared error without ``classes``, else softmax with one tree per class and round.

    Values are binned once, by approximate percentiles, and rows with the same bins (and part) become one row with its count and label
    sums, so that a round reads distinct rows only. Every level of a round is one scan: tasks add up gradients and hessians per (class,
    node, feature, bin), one aggregate adds up the tasks, and the driver, which gets classes x nodes x features x bins sums at most, picks the
    splits. The first scan of a round also gives the losses of the model so far: the history costs nothing. Margins are stored every
    ``STORE_ROUNDS`` rounds in the shared folder.

    Rows where ``held_out`` is true are not learned from; with ``patience`` growing stops when their loss has not fallen for as many
    rounds, and predictions use the best round. Rows without a label are left out. Results do not depend on partitions but for the order of
    floating-point sums.
    """
    names, k = list(features), 1 if classes is None else len(classes)
    y = [F.col(label).cast("double")] if classes is None else [(F.col(label) == c).cast("double") for c in classes]
    known = df.filter(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)], *[v.alias(f"y{j}") for j, v in enumerate(y)],
                                                       (F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)).alias("out"))
    shares = [i / bins for i in range(1, bins)]
    one = known.filter("not out").agg(*[F.percentile_approx(F.when(~F.isnan(f"x{i}"), F.col(f"x{i}")), shares, 10_000).alias(f"q{i}") for i in range(len(names))],
                                      *[F.coalesce(F.avg(f"y{j}"), F.lit(0.0)).alias(f"m{j}") for j in range(k)]).first()
    cuts = [np.unique(np.array(one[f"q{i}"] or [], float)) for i in range(len(names))]
    mean = np.array([one[f"m{j}"] for j in range(k)])
    start = mean if classes is None else np.log(np.clip(mean, 1e-9, 1))
    model = Boosted(names, cuts, start, depth, None if classes is None else list(classes))
    n, width = len(names), max(len(c) for c in cuts) + 2

    def binned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.flatten()], axis=1)
            yield pa.FixedSizeListArray.from_arrays(pa.array(model.bins(x).ravel()), n).cast(pa.list_(pa.int16()))

    rows = known.withColumn("b", F.arrow_udf(binned, "array<smallint>")(F.struct(*[f"x{i}" for i in range(n)])))
    squares = F.sum(F.col("y0") * F.col("y0"))
    rows = rows.groupBy("b", "out").agg(F.count("*").alias("n"), F.array(*[F.sum(f"y{j}") for j in range(k)]).alias("y"), squares.alias("yy"))
    zero = F.array(*[F.lit(float(s)) for s in start])
    stored, at = written(rows.select("b", "out", "n", "y", "yy", zero.alias("m")), "boosting-rows"), 0

    def matrices(batch: pa.RecordBatch) -> tuple:
        wide = lambda c: batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        b = wide(0)
        return b, batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy().astype(float), wide(3), batch.column(4).to_numpy(), wide(5) + model.margins(b, at)

    def losses(out, w, y, yy, m) -> list[tuple[int, float, float]]:
        if classes is None:
            loss = yy - 2 * m[:, 0] * y[:, 0] + w * m[:, 0] ** 2
        else:
            loss = -(y * np.log(np.clip(_softmax(m), 1e-300, 1))).sum(1)
        return [(-1 - part, float(loss[out == bool(part)].sum()), float(w[out == bool(part)].sum())) for part in (0, 1)]

    def scan(growing: list[Tree] | None, level: int) -> dict[int, tuple[float, float]]:
        """Sums per cell: gradient and hessian of (class, node, feature, bin), and in the first scan of a round loss and rows of both parts."""
        nodes = 1 << level

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, k * nodes * n * width))
            extra: dict[int, np.ndarray] = {}
            for batch in batches:
                b, out, w, y, yy, m = matrices(batch)
                if level == 0:
                    for cell, loss, count in losses(out, w, y, yy, m):
                        extra[cell] = extra.get(cell, 0) + np.array([loss, count])
                if growing is None:
                    continue
                p = m if classes is None else _softmax(m)
                for c in range(k):
                    node = growing[c].leaves(b, level) - nodes
                    g = y[:, c] - w * p[:, c]
                    h = w if classes is None else w * p[:, c] * (1 - p[:, c])
                    for f in range(n):
                        cell = ((c * nodes + node) * n + f) * width + b[:, f]
                        for s, v in enumerate((g, h)):
                            total[s] += np.bincount(cell[~out], v[~out], total.shape[1])
            cell = np.flatnonzero(total.any(0))
            keys, one, two = [cell, np.array(list(extra), np.int64)], [total[0, cell], np.array([v[0] for v in extra.values()])], [total[1, cell], np.array([v[1] for v in extra.values()])]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, one, two)], names=["cell", "g", "h"])

        found = stored.mapInArrow(sums, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        return {r["cell"]: (r["g"], r["h"]) for r in found}

    def note(found: dict, number: int) -> bool:
        """Add a line to the history; false once the held-out loss has not fallen for ``patience`` rounds."""
        mean_of = lambda cell: found[cell][0] / found[cell][1] if found.get(cell, (0, 0))[1] else None
        model.history.append((number, mean_of(-1), mean_of(-2)))
        measured = [h[2] if held_out is not None else h[1] for h in model.history]
        if measured[-1] is not None and (patience is not None or held_out is not None):
            model.best_round = min(range(len(measured)), key=lambda r: (measured[r] if measured[r] is not None else np.inf, r))
        else:
            model.best_round = number
        return patience is None or number - model.best_round < patience

    for number in range(rounds):
        growing = [Tree(np.zeros(2 << depth, np.int64), np.full(2 << depth, 1 << 30, np.int64), np.zeros(2 << depth)) for _ in range(k)]
        for level in range(depth):
            found, nodes = scan(growing, level), 1 << level
            if level == 0 and not note(found, number):
                return model
            hist = np.zeros((k * nodes * n * width, 2))
            for cell, sums in found.items():
                if cell >= 0:
                    hist[cell] = sums
            hist = hist.reshape(k, nodes, n, width, 2)
            for c in range(k):
                feature, cut, gain = _best_splits(hist[c], reg, least)
                left = hist[c].cumsum(2)
                for i in range(nodes):
                    node, whole = nodes + i, left[c * 0 + i, 0, -1]
                    if gain[i] > 1e-12:
                        growing[c].feature[node], growing[c].cut_bin[node] = feature[i], cut[i]
                        parts = left[i, feature[i], cut[i]], whole - left[i, feature[i], cut[i]]
                    else:
                        parts = whole, np.zeros(2)
                    if level == depth - 1:
                        for side, (g, h) in enumerate(parts):
                            growing[c].value[2 * node + side] = step * g / (h + reg) if h + reg > 0 else 0.0
        model.trees.append(growing)
        if len(model.trees) - at >= STORE_ROUNDS:
            add = F.arrow_udf(_adder(model, at), "array<double>")(F.struct("b", "m"))
            stored = written(stored.select("b", "out", "n", "y", "yy", add.alias("m")), "boosting-rows")
            at = len(model.trees)
    note(scan(None, 0), len(model.trees))
    return model


def _adder(model: Boosted, first: int):
    """Adds the trees from ``first`` on to stored margins."""

    def add(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            b, m = (c.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) for c in batch.flatten())
            total = m + model.margins(b, first)
            yield pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), total.shape[1]).cast(pa.list_(pa.float64()))

    return add
