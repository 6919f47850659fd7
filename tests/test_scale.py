"""How the work of models, streams and files is spread and how little of it is kept, on small tables made here."""

import glob
import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tabloom import session
from tabloom.catalog import QUERIES
from tabloom.operators import models as MD, ranking as RK
from tabloom.streaming import rolling


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


class Seen:
    """Stands in for the pipeline that is fitted last and notes what it is fitted on."""

    def __init__(self, build):
        self.build, self.rows, self.parts = build, 0, 0

    def __call__(self, *args):
        made = self.build(*args)

        def fit(df):
            self.rows, self.parts = df.count(), df.rdd.getNumPartitions()
            return made.fit(df)

        return type("Fitted", (), {"fit": staticmethod(fit)})()


def test_regression_forest_learns_from_points(spark, monkeypatch):
    rows = spark.range(40_000, numPartitions=4).select((F.col("id") % 5).alias("a"), (F.col("id") % 3).alias("b"), F.rand(2).alias("noise"))
    rows = rows.select("a", "b", (F.col("a") * 10 + F.col("b") + F.col("noise")).alias("y"))
    seen = Seen(MD.pipeline)
    monkeypatch.setattr(MD, "pipeline", seen)
    model = MD.fit_forest_reg(rows, ["a", "b"], "y", trees=10, maxDepth=8)
    assert 15 <= seen.rows <= 15 * MD.FOREST_BLOCKS  # not the 40,000 rows
    miss = F.col("y") - F.col("prediction")
    assert model.transform(rows).agg(1 - F.avg(miss * miss) / F.var_pop("y")).first()[0] > 0.8
    odd = spark.createDataFrame([(1.0, 1.0, 2.0), (None, 1.0, 3.0), (1.0, float("nan"), 3.0)], "a double, b double, y double")
    assert MD.fit_forest_reg(odd, ["a", "b"], "y", trees=2).transform(odd).count() == 1


def test_perceptron_rows_are_dealt_evenly(spark, monkeypatch):
    rows = spark.range(4000, numPartitions=1).select((F.col("id") / 4000).alias("a"), (F.col("id") % 2).cast("double").alias("b"), (F.col("id") % 2).cast("double").alias("label"))
    seen = Seen(MD.pipeline)
    monkeypatch.setattr(MD, "pipeline", seen)
    model = MD.fit_mlp(rows, ["a", "b"], "label", 2, hidden=(4,), rounds=20, seed=1)
    assert seen.rows == 4000 and seen.parts >= spark.sparkContext.defaultParallelism
    assert model.transform(rows).filter("prediction = label").count() == 4000


def test_groups_come_in_batches(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:00:{i:02d}", 1 if i < 10 else None, None if i == 3 else float(i * i)) for i in range(20)]
    spark.createDataFrame(rows, "event_id long, ts string, user_id long, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    out = QUERIES["udf_group"](spark, str(tmp_path))
    assert "FlatMapGroups" not in plan(out)  # a call per batch, not per group
    got = {(r["user_id"], r["frame"]): (r["n"], r["spread"]) for r in out.collect() if r["user_id"] is not None}
    assert got == {(1, 1): (4, None)}


def test_ratings_of_many_rows_at_once(spark):
    df = spark.createDataFrame([(29.0, 5.0, 20.0), (22.0, 5.25, 0.0), (None, 7.0, None), (1e6, 1e6, 1e6), (None, None, None), (math.nan, math.nan, math.nan)], "bmi double, a1c double, bp double")
    out = MD.fuzzy_rating(df)
    assert "ArrowEvalPython" in plan(out) and "aggregate(" not in plan(out)
    inf, level = math.inf, lambda c, v: max(0.0, 1 - abs(v - c) / 5)

    def centroid(cuts):
        a = b = 0.0
        for i in range(401):
            h = max(min(level(c, i / 10), cut) for c, cut in zip((10, 5, 1), cuts))
            a, b = a + i / 10 * h, b + h
        return a / b if b else None

    got = [r["rating"] for r in out.collect()]
    # a rule takes the inputs that it has; one that is not a number does not cut
    assert got[2] == centroid((level(4, 7), level(5.25, 7), level(5.25, 7)))
    assert got[3:5] == [None, None] and got[5] == centroid((inf, inf, inf)) and all(g is not None for g in got[:2])


def test_permuted_values_are_joined_before_the_copies(spark):
    df = spark.range(500).select("id", F.col("id").cast("double").alias("a"), (F.col("id") % 7).alias("b"))
    moved = RK.perturbed(df, ["a", "b"], seed=3, order=["id"])
    told = plan(moved)
    assert told.index("Generate") < told.index("Join")  # the top comes first: copies are made of joined rows
    assert "aggregate(" not in told and moved.count() == 1000


def test_keys_of_a_bucket_share_their_state(spark, tmp_path):
    rows = spark.range(600).select(F.col("id"), F.when(F.col("id") % 200 > 0, F.col("id") % 200 + (1 << 60)).alias("user"), F.timestamp_seconds((F.floor(F.col("id") / 200) + 100) * 86400).alias("ts"), (F.col("id") % 13).cast("double").alias("value"))
    end = spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit(-1).cast("long").alias("user"), F.timestamp_seconds(F.lit(140 * 86400)).alias("ts"), F.lit(0.0).alias("value"))
    for part in (rows, end, end):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    df = rolling.stream_rolling(stream, ["user"], "ts", "3 days", "value", "id", buckets=4)
    q = df.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) < 60  # 200 keys, 600 readings
    got = {(r["id"], r["user"], r["rolled"]) for r in spark.read.schema(df.schema).parquet(f"{tmp_path}/out").filter("id >= 0").collect()}
    assert got == {(i, i % 200 + (1 << 60) if i % 200 else None, float(max(j % 13 for j in range(i % 200, i + 1, 200)))) for i in range(600)}


def test_least_squares_is_searched_from_moments(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 2)) * [1, 40] + [5, 0]
    y = x @ [2.0, -0.1] + rng.normal(size=900)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, y double").coalesce(1)
    grid = {"regParam": [0.0, 0.5], "elasticNetParam": [0.0, 0.5]}
    got = MD.grid_search(df, ["a", "b"], "y", grid, folds=3, seed=1)
    est = LinearRegression(labelCol="y")
    maps = ParamGridBuilder().addGrid(est.regParam, grid["regParam"]).addGrid(est.elasticNetParam, grid["elasticNetParam"]).build()
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    want = CrossValidator(estimator=est, estimatorParamMaps=maps, numFolds=3, seed=1, evaluator=RegressionEvaluator(labelCol="y")).fit(data)
    assert got.avgMetrics == pytest.approx(want.avgMetrics, rel=1e-6)
    assert got.bestModel.coefficients.toArray() == pytest.approx(want.bestModel.coefficients.toArray(), rel=1e-6)
    assert got.bestModel.summary.predictions.count() == 3 * 2 * 3  # points, not rows
    with pytest.raises(Exception, match="(?i)null"):
        MD.grid_search(df.unionByName(spark.createDataFrame([(None, 1.0, 1.0)], df.schema)), ["a", "b"], "y", grid, folds=3)


def test_chunks_are_written_by_many_tasks(spark, tmp_path):
    spark.range(9_000).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), (F.col("id") % 50).cast("int").alias("p_size"), F.lit(1.0).alias("p_retailprice")).write.parquet(f"{tmp_path}/part.parquet")
    got = QUERIES["scan_csv_chunked"](spark, str(tmp_path)).first()
    assert (got["n"], got["chunks_hold"], got["several"]) == (9_000, True, True)
    path = [p for p in session._NAMED if "csv-chunks" in p][-1]
    tasks = {f.split("part-")[1][:5] for f in glob.glob(f"{path.removeprefix('file:')}/*.csv")}
    assert len(tasks) == 3


def test_forest_rows_are_dealt_by_their_draws(spark, monkeypatch):
    rows = spark.range(4000, numPartitions=1).select((F.col("id") / 4000).alias("a"), (F.col("id") > 2000).cast("double").alias("label"))
    seen = Seen(MD.pipeline)
    monkeypatch.setattr(MD, "pipeline", seen)
    monkeypatch.setattr(MD, "FOREST_DRAWS", 1000)
    model = MD.fit_forest(rows, ["a"], "label", trees=5)
    assert (seen.rows, seen.parts) == (4000, 20)
    assert model.transform(rows).filter("prediction = label").count() > 3900
