"""Time series jobs against pandas, and stream against batch."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import models as MD, signals as SG, timeseries as TS, wiki as WK
from tabloom.sources import dumps
from tabloom.streaming import twins as ST

T0 = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def ticks():
    rng = np.random.default_rng(5)
    minutes = np.sort(rng.choice(60 * 24 * 12, size=300, replace=False))
    minutes = minutes[(minutes < 4000) | (minutes > 9000)]
    return pd.DataFrame({"ts": [T0 + dt.timedelta(minutes=int(m)) for m in minutes], "v": rng.integers(0, 1000, len(minutes)).astype(float),
                         "i": range(len(minutes))})


@pytest.fixture(scope="module")
def frame(spark, ticks):
    rows = [(r.ts.to_pydatetime(), r.v, int(r.i)) for r in ticks.itertuples()]
    return spark.createDataFrame(rows, "ts timestamp_ntz, v double, i long").cache()


def test_daily_maximum_with_empty_days(frame, ticks):
    got = {r["period"]: r["top"] for r in TS.resample(frame, [], "ts", "1 day", {"top": F.max("v")}).collect()}
    want = ticks.set_index("ts")["v"].resample("D").max()
    assert len(got) == len(want) and None in got.values()
    assert all((got[k.to_pydatetime()] is None) == np.isnan(v) and (np.isnan(v) or got[k.to_pydatetime()] == v) for k, v in want.items())


def test_back_fill(frame, ticks):
    daily = TS.resample(frame, [], "ts", "1 day", {"top": F.max("v")}).withColumn("k", F.lit(1))
    got = [r["top"] for r in TS.bfill(daily, ["k"], ["period"], ["top"]).orderBy("period").collect()]
    assert got == ticks.set_index("ts")["v"].resample("D").max().bfill().tolist()


def test_hourly_bars(frame, ticks):
    got = TS.ohlc(frame, "ts", "v", "1 hour", "i").orderBy("period").toPandas()
    want = ticks.set_index("ts")["v"].resample("h").ohlc()
    assert len(got) == len(want)
    assert np.allclose(got[["open", "high", "low", "close"]].astype(float), want, equal_nan=True)


@pytest.mark.parametrize("buckets", [1, 2, 24, 3 * 24 * 60])
@pytest.mark.parametrize("fn", ["max", "min", "sum", "count", "mean"])
def test_rolling_three_days(frame, ticks, fn, buckets):
    got = TS.rolling(frame.withColumn("k", F.lit(None).cast("int")), ["k"], "ts", "3 days", "v", fn, buckets=buckets).orderBy("i").toPandas()
    want = getattr(ticks.rolling("3D", on="ts")["v"], fn)()
    assert np.allclose(got["rolled"].astype(float), want)


def test_rolling_keeps_ties_and_nulls(spark):
    rows = [("a", T0, 1.0), ("a", T0, 5.0), ("a", T0 + dt.timedelta(days=1), None), ("b", T0, None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    got = sorted((r["k"], r["ts"], str(r["rolled"])) for r in TS.rolling(df, ["k"], "ts", "3 days", "v").collect())
    assert [g[2] for g in got] == ["5.0", "5.0", "5.0", "None"]


def test_rolling_frame_is_half_open(spark):
    df = spark.createDataFrame([(T0, 9.0), (T0 + dt.timedelta(days=3), 1.0)], "ts timestamp_ntz, v double").withColumn("k", F.lit(1))
    assert [r["rolled"] for r in TS.rolling(df, ["k"], "ts", "3 days", "v").orderBy("ts").collect()] == [9.0, 1.0]


def test_moving_average_argument(frame):
    with pytest.raises(ValueError):
        TS.sma(frame, ["i"], ["ts"], "v", 0)
    assert TS.sma(frame, ["i"], ["ts"], "v", 1).filter("sma <> v").count() == 0


@pytest.mark.parametrize("period", [7, 4])
@pytest.mark.parametrize("model", ["multiplicative", "additive"])
def test_decomposition_against_numpy(spark, period, model):
    rng = np.random.default_rng(2)
    y = 50 + np.arange(60) * 0.5 + 5 * np.sin(np.arange(60) * 2 * np.pi / period) + rng.random(60)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)], "k string, i int, y double")
    got = TS.seasonal_decompose(df, ["k"], ["i"], "y", period, model).orderBy("i").toPandas()
    half = period // 2
    w = np.ones(period) / period if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(60, np.nan)
    trend[half:60 - half] = np.convolve(y, w, "valid")
    off = y / trend if model == "multiplicative" else y - trend
    means = np.array([np.nanmean(off[p::period]) for p in range(period)])
    means = means / means.mean() if model == "multiplicative" else means - means.mean()
    seasonal = np.tile(means, 60)[:60]
    assert np.allclose(got["trend"].astype(float), trend, equal_nan=True)
    assert np.allclose(got["seasonal"], seasonal)
    resid = y / trend / seasonal if model == "multiplicative" else y - trend - seasonal
    assert np.allclose(got["resid"].astype(float), resid, equal_nan=True)


def test_targets_never_cross_items(spark):
    rows = [(k, i, float(i + 100 * (k == "b"))) for k in "ab" for i in range(6)]
    df = spark.createDataFrame(rows, "k string, d int, s double")
    got = TS.supervised(df, ["k"], ["d"], ["s"], window=2, lag=2).collect()
    assert len(got) == 4 and all(r["s(t+2)"] == r["s(t)"] + 2 and r["s(t-2)"] == r["s(t)"] - 2 for r in got)
    tensor = TS.stack_sequences(TS.supervised(df, ["k"], ["d"], ["s"], 2, 2), ["s"], 2).first()["tensor"]
    assert len(tensor) == 3 and len(tensor[0]) == 1


def test_detrended_line_is_flat(spark):
    df = spark.createDataFrame([("a", i, 3.0 * i + 1) for i in range(20)], "k string, i int, v double")
    assert TS.detrend(df, ["k"], ["i"], "v").filter("abs(detrended) > 1e-9").count() == 0


def test_sales_features(spark):
    rows = [("a", 1, 0.0), ("a", 2, 5.0), ("b", 2, 3.0), ("b", 3, 1.0), ("c", 3, 0.0)]
    df = spark.createDataFrame([(k, T0 + dt.timedelta(days=d), c) for k, d, c in rows], "item string, date timestamp_ntz, count double")
    others = {(r["item"], r["date"].day): r["other_sales"] for r in TS.other_sales(df, "item", "date", "count").collect()}
    assert others[("a", 3)] == 3.0 and others[("b", 3)] == 5.0
    age = {(r["item"], r["date"].day): r["age"] for r in TS.age_days(df, "item", "date", "count").collect()}
    assert age == {("a", 2): -1, ("a", 3): 0, ("b", 3): 0, ("b", 4): 1}
    share = {(r["item"], r["date"].day): r["pct_total"] for r in TS.pct_total(df, "date", "count").collect()}
    assert share[("a", 3)] == 0.625 and share[("a", 2)] is None


def test_spectrum_against_numpy(spark):
    rate, size, step = 64.0, 16, 8
    y = np.sin(np.arange(80) * 2 * np.pi * 8 / rate) + 0.2 * np.cos(np.arange(80) * 0.3)
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(y)], "s string, i long, v double")
    frames = SG.frames(df, "s", "i", "v", step, size)
    got = SG.spectrum(frames, "s", rate, size).toPandas()
    hann = 0.5 * (1 - np.cos(np.linspace(0, 2 * np.pi, size, False)))
    padded = np.r_[np.zeros(size), y]
    want = {f: np.abs(np.fft.rfft(padded[f * step:f * step + size] * hann)) for f in range(1, 10)}
    top = max(v.max() for v in want.values())
    for f, mags in want.items():
        part = got[got["frame"] == f].sort_values("bin")
        assert np.allclose(part["magnitude"], mags / top) and np.allclose(part["freq"], np.fft.rfftfreq(size, 1 / rate))
    notes = SG.top_notes(SG.spectrum(frames, "s", rate, size), "s", 3).toPandas()
    assert notes.groupby("frame").size().max() <= 3 and notes.groupby(["frame", "note"]).size().max() == 1


def test_forecast_follows_trend_and_week(spark):
    rows = []
    for k, base in (("a", 20.0), ("b", 200.0)):
        for i in range(400):
            day = T0 + dt.timedelta(days=i)
            rows.append((k, day, base + 0.1 * i + (5 if day.weekday() == 6 else 0)))
    df = spark.createDataFrame(rows, "k string, d timestamp_ntz, y double")
    out = MD.seasonal_forecast(df, "k", "d", "y", 30).filter("future").toPandas()
    assert out.groupby("series").size().tolist() == [30, 30]
    ahead = np.array([(pd.Timestamp(d) - pd.Timestamp(T0)).days for d in out["date"]])
    truth = np.where(out["series"] == "a", 20, 200) + 0.1 * ahead + 5 * np.array([pd.Timestamp(d).weekday() == 6 for d in out["date"]])
    assert np.abs(out["yhat"] - truth).mean() < 2.0


def test_stream_bars_equal_batch(spark, frame, tmp_path):
    frame.coalesce(1).sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    q = (ST.stream_ohlc(stream, "ts", "v", "i").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start(str(tmp_path / "out")))
    q.awaitTermination()
    got = {r["period"]: (r["open"], r["high"], r["low"], r["close"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["period"]: tuple(r)[1:] for r in TS.ohlc(frame, "ts", "v", "1 hour", "i").filter("open is not null").collect()}
    assert set(want) - set(got) and all(want[k] == v for k, v in got.items()) and len(want) - len(got) <= 3


def test_stream_routing_equals_batch(spark, tmp_path):
    from tests.test_sources import DUMP

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.xml").write_text(DUMP)
    ST.stream_wiki(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    (tmp_path / "in/b.xml").write_text(DUMP.replace("<id>", "<id>7"))
    ST.stream_wiki(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    batch = WK.wiki_tables(dumps.read_wiki_dump(spark, str(tmp_path / "in")))
    for name, table in batch.items():
        got = spark.read.parquet(str(tmp_path / "out" / name)).drop("batch")
        assert sorted(tuple(r) for r in got.select(*table.columns).collect()) == sorted(tuple(r) for r in table.collect())


def test_stream_dedupe(spark, tmp_path):
    rows = [(T0 + dt.timedelta(minutes=m), k) for m, k in ((0, 1), (1, 1), (2, 2), (3, 1))]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k int")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ST.stream_dedupe(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "ts", ["k"])
    q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]
