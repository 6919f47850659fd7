"""Classification and regression metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.scalar import argmax, clip
from tabloom.plans.ordered import positions, running_totals
from tabloom.plans.skew import join_rows
from tabloom.session import written



def classify(df: DataFrame, score: str, threshold: float = 0.5, name: str = "predicted") -> DataFrame:
    return df.withColumn(name, (F.col(score) > threshold).cast("int"))


def classify_argmax(df: DataFrame, scores: str, name: str = "predicted") -> DataFrame:
    return df.withColumn(name, argmax(scores))


def _counts(y: str, yhat: str) -> dict[str, Column]:
    a, b = F.col(y) == 1, F.col(yhat) == 1
    return {
        "positives": F.count_if(a), "negatives": F.count_if(~a),
        "tp": F.count_if(a & b), "tn": F.count_if(~a & ~b),
        "fp": F.count_if(~a & b), "fn": F.count_if(a & ~b),
    }


def confusion_counts(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Counts and rates; FN is a missed positive, FP a false alarm."""
    one = df.agg(*[v.alias(n) for n, v in _counts(y, yhat).items()])
    return one.withColumns({
        "tpr": F.try_divide("tp", "positives"), "tnr": F.try_divide("tn", "negatives"),
        "fpr": F.try_divide("fp", "negatives"), "fnr": F.try_divide("fn", "positives"),
    })


def accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("int")).alias("accuracy"))


def precision_recall_f1(df: DataFrame, y: str, yhat: str) -> DataFrame:
    one = df.agg(*[v.alias(n) for n, v in _counts(y, yhat).items()])
    p, r = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return one.select(p.alias("precision"), r.alias("recall"), F.try_divide(2 * p * r, p + r).alias("f1"))


def f1_per_class(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Precision, recall and F1 of every class in one group-by: each row counts once for its
    true and once for its predicted class."""
    hit = (F.col(y) == F.col(yhat)).cast("int")
    sides = F.array(
        F.struct(F.col(y).alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p"), hit.alias("h")),
        F.struct(F.col(yhat).alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("h")),
    )
    sums = df.select(F.inline(sides)).groupBy("label").agg(
        F.sum("t").alias("t"), F.sum("p").alias("p"), F.sum("h").alias("h"))
    return sums.select(
        "label", F.try_divide("h", "p").alias("precision"), F.try_divide("h", "t").alias("recall"),
        F.try_divide(2 * F.col("h"), F.col("t") + F.col("p")).alias("f1"))


def confusion_matrix(df: DataFrame, y: str, yhat: str, normalize: bool = False) -> DataFrame:
    """(actual, predicted, n) with zero cells; normalised by the row total on request."""
    counts = written(df.groupBy(F.col(y).alias("actual"), F.col(yhat).alias("predicted")).agg(F.count("*").alias("n")), "cells")
    seen = counts.select(F.explode(F.array("actual", "predicted")).alias("label")).distinct()
    # a matrix has a cell for every two classes; the classes stay on Spark
    labels = seen.agg(F.collect_list("label").alias("_labels"))
    cells = labels.select(F.explode("_labels").alias("actual"), "_labels").select("actual", F.explode("_labels").alias("predicted"))
    out = cells.join(counts, ["actual", "predicted"], "left").na.fill(0, ["n"])
    if not normalize:
        return out
    rows = out.groupBy("actual").agg(F.sum("n").alias("_t"))
    return out.join(rows, "actual").withColumn("share", F.coalesce(F.try_divide("n", "_t"), F.lit(0.0))).drop("_t")


def roc(df: DataFrame, y: str, score: str) -> DataFrame:
    """ROC points per distinct threshold, highest first: threshold, tp, fp, tpr, fpr and the
    area of the trapezoid that ends in the point."""
    per = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("_p"), F.sum((F.col(y) != 1).cast("long")).alias("_n"))
    # thresholds are read several times below; stored, they cost the input one pass only
    per = written(per, "thresholds")
    cum = running_totals(per, [F.desc("threshold")], {"tp": "_p", "fp": "_n"})
    p, n = per.agg(F.sum("_p")).scalar(), per.agg(F.sum("_n")).scalar()
    width = F.try_divide(F.col("_n"), n)
    height = F.try_divide(2 * F.col("tp") - F.col("_p"), 2 * p)
    return cum.select("threshold", "tp", "fp", F.try_divide("tp", p).alias("tpr"), F.try_divide("fp", n).alias("fpr"),
                      (width * height).alias("area"))


def auc(df: DataFrame, y: str, score: str) -> DataFrame:
    return roc(df, y, score).agg(F.sum("area").alias("auc"))


def auc_by(df: DataFrame, group: str, y: str, score: str) -> DataFrame:
    """The area of every group, all groups in one ordered pass.

    Running totals go through all groups; what earlier groups added is taken off again.
    """
    per = df.groupBy(group, F.col(score).alias("threshold")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("_p"), F.sum((F.col(y) != 1).cast("long")).alias("_n"))
    per = written(per, "thresholds")
    totals = per.groupBy(group).agg(F.sum("_p").alias("_pp"), F.sum("_n").alias("_nn"))
    table = running_totals(totals, [group], {"_upto": "_pp"}).select(group, "_pp", "_nn", (F.col("_upto") - F.col("_pp")).alias("_before"))
    cum = join_rows(running_totals(per, [group, F.desc("threshold")], {"tp": "_p"}), table, [group], null_safe=True)
    height = F.try_divide(2 * (F.col("tp") - F.col("_before")) - F.col("_p"), 2 * F.col("_pp"))
    return cum.groupBy(group).agg(F.sum(F.try_divide("_n", "_nn") * height).alias("auc"))


def auc_per_class(df: DataFrame, y: str, scores: str, classes: Sequence[int]) -> DataFrame:
    """One-against-rest area per class of a score array, and the micro average over all classes."""
    flat = df.select(F.col(y).alias("_c"), F.posexplode(scores).alias("_k", "_s"))
    hit = (F.col("_k") == F.col("_c")).cast("int")
    entry = F.struct(hit.alias("_y"), "_s")
    groups = F.array_compact(F.array(F.when(F.col("_k").isin(list(classes)), F.col("_k").cast("string")), F.lit("micro")))
    rows = flat.select(F.explode(groups).alias("label"), entry.alias("e")).select("label", "e.*")
    return auc_by(rows, "label", "_y", "_s")


def log_loss(df: DataFrame, y: str, p: str, eps: float = 1e-15) -> DataFrame:
    q = clip(F.col(p), eps, 1 - eps)
    loss = F.when(F.col(y) == 1, -F.log(q)).otherwise(-F.log(1 - q))
    return df.agg(F.avg(loss).alias("log_loss"))


def r2(df: DataFrame, y: str, yhat: str) -> DataFrame:
    d = F.col(y) - F.col(yhat)
    return df.agg((1 - F.sum(d * d) / (F.var_pop(y) * F.count(y))).alias("r2"))


def mse_rmse(df: DataFrame, y: str, yhat: str) -> DataFrame:
    d = F.col(y) - F.col(yhat)
    return df.agg(F.avg(d * d).alias("mse"), F.sqrt(F.avg(d * d)).alias("rmse"))


def sae(df: DataFrame, x: str, y: str, w: Sequence[float]) -> DataFrame:
    """Sum of absolute errors of the line w0 x + w1."""
    return df.agg(F.sum(F.abs(float(w[0]) * F.col(x) + float(w[1]) - F.col(y))).alias("sae"))


def loss(df: DataFrame, expr: str | Column, name: str = "loss") -> DataFrame:
    """A caller's loss: any aggregate expression over the columns."""
    return df.agg((F.expr(expr) if isinstance(expr, str) else expr).alias(name))


def regression_chart(df: DataFrame, y: str, yhat: str, *ties: str) -> DataFrame:
    """(position, y, prediction) in the order of y."""
    placed = positions(df.select(y, yhat, *ties), [y, *ties])
    return placed.select((F.col("_pos") + 1).alias("position"), y, yhat)


def decile_table(df: DataFrame, y: str, score: str, *ties: str, buckets: int = 10) -> DataFrame:
    """Equal rank buckets by falling score: positives, size and rate."""
    placed = positions(df.select(y, score, *ties), [F.desc(score), *ties])
    last = placed.agg(F.max("_pos")).scalar()
    # whole numbers keep the bucket edges exact
    bucket = F.when(F.col("_pos") * buckets % last == 0, F.expr(f"_pos * {buckets}") / last).otherwise(
        F.floor(F.col("_pos") * buckets / last) + 1)
    bucket = F.when(last == 0, F.lit(1)).otherwise(F.greatest(F.lit(1), bucket.cast("int")))
    return placed.groupBy(bucket.alias("bucket")).agg(
        F.sum(y).alias("tp"), F.count("*").alias("n"), (F.sum(y) / F.count("*")).alias("score"))
