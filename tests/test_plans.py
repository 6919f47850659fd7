"""Order-based helpers: the split paths must equal the plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from tabloom.operators import timeseries as TS
from tabloom.plans import ordered as O
from tabloom.plans.quantiles import exact_medians
from tabloom.plans.sizes import hot_keys


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows and more."""
    rnd = random.Random(1)
    rows = [("hot" if i % 3 == 0 else None if i % 97 == 0 else f"k{rnd.randrange(40)}", rnd.randrange(500), i,
             None if rnd.random() < 0.4 else float(rnd.randrange(1000))) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, t int, i int, v double").repartition(5).cache()


def test_positions_number_every_row(spark, skewed):
    got = O.positions(skewed, ["t", "i"]).orderBy("_pos").collect()
    assert [r["_pos"] for r in got] == list(range(3000))
    assert [(r["t"], r["i"]) for r in got] == sorted((r["t"], r["i"]) for r in got)


def test_positions_of_an_empty_table(spark, skewed):
    assert O.positions(skewed.filter("i < 0"), ["t"]).count() == 0


def test_running_totals(spark, skewed, monkeypatch):
    monkeypatch.setattr(O, "BLOCK_ROWS", 100)
    got = O.running_totals(skewed.select("t", "i"), ["t", "i"], {"total": "i"}).collect()
    want, total = {}, 0
    for t, i in sorted((r["t"], r["i"]) for r in got):
        total += i
        want[i] = total
    assert {r["i"]: r["total"] for r in got} == want


def test_hot_keys_are_found(spark, skewed):
    spark.conf.set("tabloom.hot.rows", "500")
    try:
        assert [r["_h0"] for r in hot_keys(skewed, ["k"]).collect()] == ["hot"]
    finally:
        spark.conf.unset("tabloom.hot.rows")


def _set(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_windowed_equals_plain(spark, skewed):
    def build(frame, part):
        w = W.partitionBy(*part).orderBy("t", "i")
        return frame.withColumns({"back": F.lag("i", 3).over(w), "ahead": F.lead("i", 2).over(w),
                                  "mean": F.avg("i").over(w.rowsBetween(-3, 2))})

    plain = build(skewed, ["k"])
    split = O.windowed(skewed, ["k"], ["t", "i"], build, before=3, after=2, hot=500, block=50)
    cols = ("k", "i", "back", "ahead", "mean")
    assert _set(plain, *cols) == _set(split, *cols)


def test_numbered_equals_plain(spark, skewed):
    plain = O.numbered(skewed, ["k"], ["t", "i"])
    split = O.numbered(skewed, ["k"], ["t", "i"], hot=500)
    assert _set(plain, "k", "i", "rn") == _set(split, "k", "i", "rn")


def test_next_known_equals_plain(spark, skewed):
    plain = O.next_known(skewed, ["k"], ["t", "i"], ["v"])
    split = O.next_known(skewed, ["k"], ["t", "i"], ["v"], hot=500, block=7)
    assert _set(plain, "k", "i", "v") == _set(split, "k", "i", "v")


def test_window_operators_on_hot_keys(spark, skewed):
    spark.conf.set("tabloom.hot.rows", "500")
    try:
        split = TS.supervised(skewed.select("k", "t", "i"), ["k"], ["t", "i"], ["i"], 3, 2)
        decomposed = TS.seasonal_decompose(skewed.select("k", "t", "i"), ["k"], ["t", "i"], "i")
        lines = TS.detrend(skewed.select("k", "t", "i"), ["k"], ["t", "i"], "i")
        got = [_set(x, *x.columns) for x in (split, decomposed, lines)]
    finally:
        spark.conf.unset("tabloom.hot.rows")
    split = TS.supervised(skewed.select("k", "t", "i"), ["k"], ["t", "i"], ["i"], 3, 2)
    decomposed = TS.seasonal_decompose(skewed.select("k", "t", "i"), ["k"], ["t", "i"], "i")
    lines = TS.detrend(skewed.select("k", "t", "i"), ["k"], ["t", "i"], "i")
    want = [_set(x, *x.columns) for x in (split, decomposed, lines)]
    assert got[0] == want[0]
    for a, b in zip(got[1:], want[1:]):
        assert len(a) == len(b)
        for x, y in zip(sorted(a, key=lambda r: (r[0] is None, r[0] or "", *r[1:3])), sorted(b, key=lambda r: (r[0] is None, r[0] or "", *r[1:3]))):
            assert x[:3] == y[:3]
            assert [v is None for v in x] == [v is None for v in y]
            assert [v for v in x[3:] if v is not None] == pytest.approx([v for v in y[3:] if v is not None], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("final", [3, 50, 100_000])
@pytest.mark.parametrize("kind", ["uniform", "hot", "two", "ends", "even", "single"])
def test_exact_median(spark, kind, final):
    rnd = random.Random(hash(kind) % 100)
    values = {
        "uniform": [rnd.random() for _ in range(1001)],
        "even": [rnd.random() for _ in range(1000)],
        "hot": [7.0] * 700 + [rnd.random() * 20 for _ in range(300)],
        "two": [1.0] * 500 + [2.0] * 500,
        "ends": [1.0] * 480 + [9.0] * 480 + [2 + rnd.random() for _ in range(41)],
        "single": [5.0],
    }[kind]
    df = spark.createDataFrame([(v, -v) for v in values] + [(None, None)], "a double, b double")
    got = exact_medians(df, ["a", "b"], final=final)
    assert got["a"] == pytest.approx(float(np.median(values)), rel=1e-12)
    assert got["b"] == pytest.approx(-float(np.median(values)), rel=1e-12)


def test_median_of_nothing(spark):
    assert exact_medians(spark.createDataFrame([(None,)], "a double"), ["a"]) == {"a": None}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_joins_keep_null_keys_on_request(spark, skewed, how):
    from tabloom.plans.skew import join_rows

    right = spark.createDataFrame([(f"k{j}", -j) for j in range(0, 40, 2)] + [(None, 7)], "k string, w int")
    plain = join_rows(skewed, right, ["k"], how)
    assert _set(plain, "k", "i", "w") == _set(skewed.join(right, ["k"], how), "k", "i", "w")
    safe = join_rows(skewed, right, ["k"], how, null_safe=True)
    assert {r["w"] for r in safe.filter("k is null").collect()} == {7}
    assert safe.filter("k is null").count() == skewed.filter("k is null").count()


def test_running_totals_with_nulls(spark, monkeypatch):
    """Nulls add nothing, also at the start of a block; before the first value there is no total."""
    monkeypatch.setattr(O, "BLOCK_ROWS", 2)
    rows = spark.createDataFrame([(0, None), (1, 5), (2, 7), (3, None), (4, None), (5, 1)], "i int, v int")
    got = {r["i"]: r["total"] for r in O.running_totals(rows, ["i"], {"total": "v"}).collect()}
    assert got == {0: None, 1: 5, 2: 12, 3: 12, 4: 12, 5: 13}


def test_totals_of_null_groups_come_back(spark):
    rows = spark.createDataFrame([(None, "a", 1), (None, "b", 3), ("d", "a", 2), ("d", None, 2)], "day string, item string, n int")
    shares = TS.pct_total(rows, "day", "n").collect()
    assert len(shares) == 4 and {r["pct_total"] for r in shares if r["day"] is None} == {0.25, 0.75}
    others = TS.other_sales(rows, "item", "day", "n").collect()
    assert len(others) == 4 and sorted(r["other_sales"] for r in others) == [1, 2, 2, 3]


def test_medians_have_one_type(spark):
    from tabloom.operators.features import impute_median

    rows = spark.createDataFrame([(1,), (4,), (None,)], "x int").withColumn("x", F.col("x").cast("decimal(12,2)"))
    out = impute_median(rows, ["x"])
    assert out.schema["x"].dataType.simpleString() == "double" and sorted(r["x"] for r in out.collect()) == [1, 2.5, 4]


def test_a_compressed_hot_key_is_split(spark):
    """Millions of rows of one key in a few hundred kilobytes are counted, not estimated."""
    from tabloom.session import written

    rows = written(spark.range(25_000_000).select(F.lit("one").alias("k"), F.lit(1).alias("v")), "one-key")
    assert [r["_h0"] for r in hot_keys(rows, ["k"], 20_000_000).collect()] == ["one"]
