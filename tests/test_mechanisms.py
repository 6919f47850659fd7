"""Streams with state, table functions, chains, permutations, trees, boosting, file sources: brute-force twins."""

import hashlib
import math
import os
import random
import struct
import zlib
from statistics import NormalDist

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tabloom.functions import tables
from tabloom.operators import boosting, extra_trees, graphs, joins as J, models as MD, profiling as PR, ranking as RK
from tabloom.plans import draws
from tabloom.plans.quantiles import exact_medians
from tabloom.sources import dumps, files
from tabloom.streaming import rolling, twins

DAY = 86_400_000_000


# --- rolling frames on a stream ----------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.one_of(st.none(), st.integers(-5, 5))), max_size=30), st.integers(1, 15), st.sampled_from(rolling.FUNCTIONS))
def test_frames_by_hand(rows, period, fn):
    rows.sort(key=lambda r: r[0])
    us = np.array([r[0] for r in rows], np.int64)
    value = np.array([np.nan if r[1] is None else r[1] for r in rows], float)
    got = rolling.frame_values(us, value, us, period, fn)
    for t, g in zip(us, got):
        inside = [v for u, v in rows if t - period < u <= t and v is not None]
        want = {"count": lambda: len(inside), "sum": lambda: sum(inside), "avg": lambda: sum(inside) / len(inside), "max": lambda: max(inside), "min": lambda: min(inside)}
        if inside or fn == "count":
            assert g == pytest.approx(want[fn]())
        else:
            assert np.isnan(g)


def run_stream(spark, folder, parts, build, tmp):
    """Each part is a file of its own and a trigger of its own."""
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = f"{tmp}/out"
    df = build(stream)
    q = df.writeStream.format("parquet").option("checkpointLocation", f"{tmp}/state").trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out), q.recentProgress


def test_stream_rolling_equals_the_window_and_forgets(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, f"u{rnd.randrange(3)}" if i % 40 else None, i * 3600 + rnd.randrange(1800), None if i % 11 == 0 else float(rnd.randrange(100))) for i in range(480)]
    rows += [(1000 + i, "u0", rows[50][2], 7.5) for i in range(2)]  # ties
    df = spark.createDataFrame(rows, "id long, user string, s long, value double").select("id", "user", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "value")
    late = F.when(F.col("id") % 5 == 0, 1).otherwise(0)  # every fifth reading comes a slice late, within the delay
    slices = [df.filter((F.least(F.floor((F.col("id") % 1000) / 24) + late, F.lit(20))) == k) for k in range(21)]
    last = spark.createDataFrame([(-1, "end", 480 * 3600 + 40 * 86400, 0.0)], "id long, user string, s long, value double").select(
        "id", "user", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "value")
    got, progress = run_stream(spark, f"{tmp_path}/in", [*slices, last], lambda s: rolling.stream_rolling(s, ["user"], "ts", "3 days", "value", "id", delay="48 hours"), tmp_path)
    df.createOrReplaceTempView("readings")
    want = spark.sql("""SELECT id, user, ts, max(value) OVER (PARTITION BY user ORDER BY ts RANGE BETWEEN INTERVAL '2 23:59:59.999999' DAY TO SECOND PRECEDING AND CURRENT ROW) AS rolled FROM readings""")
    key = lambda r: (r["id"], str(r["user"]), r["ts"], r["rolled"])
    assert sorted(map(key, got.filter("id >= 0").collect()), key=str) == sorted(map(key, want.collect()), key=str)
    assert len([p for p in progress if p["numInputRows"] > 0]) > 10
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(held) < len(rows) and held[-1] <= 8  # the period and the delay bound the state; in the end little is left


def test_progress_of_a_running_stream(spark, tmp_path):
    spark.range(0, 95).select(F.concat(F.lit("<title>x</title></page>"), F.col("id")).alias("value"), F.col("id").cast("string").alias("file")).createOrReplaceTempView("p")
    parts = [spark.table("p").filter(f"file % 5 = {k}") for k in range(5)]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    said = []
    df = twins.with_progress(spark.readStream.schema("value string, file string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"))
    q = df.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    lines = twins.follow(q, every=30, say=said.append)
    assert [n for _, n, _, _ in lines if n] == [19] * 5 and lines[-1][3] == 95 and said == ["30 pages", "60 pages", "90 pages"]


# --- table function, chains --------------------------------------------------------------------------------------------


def test_template_tree_keeps_its_state_over_lines(spark):
    pages = {1: ["{{Infobox a", "|x={{convert", "|1}}", "|y=<!-- {{no}} -->{{{param|{{inner}}}}}", "}} {{stub}}"], 2: ["{{open", "|{{deeper}}", None, "end"], 3: ["}} }}} text", "<!-- {{x}}", "{{y}} --> {{z}}"],
             4: ["{{#if:x|{{a}}}}"], 5: ["plain"]}
    rows = [(p, i, t) for p, lines in pages.items() for i, t in enumerate(lines)]
    spark.createDataFrame(rows, "page long, line int, text string").repartition(3).createOrReplaceTempView("tree_lines")
    tables.register(spark)
    got = spark.sql("SELECT * FROM template_tree(TABLE(SELECT page, line, text FROM tree_lines) PARTITION BY page ORDER BY line)").collect()
    found = {}
    for r in got:
        found.setdefault(r["page"], []).append((r["line"], r["depth"], r["template"], r["path"]))
    assert sorted(found[1]) == [(0, 1, "Infobox a", "Infobox a"), (1, 2, "convert", "Infobox a/convert"), (3, 2, "inner", "Infobox a/inner"), (4, 1, "stub", "stub")]
    assert sorted(found[2], key=str) == sorted([(0, 1, "open", "open"), (1, 2, "deeper", "open/deeper"), (3, -1, "open", None)], key=str)
    assert found[3] == [(2, 1, "z", "z")] and [t for _, _, t, _ in found[4]] == ["a"] and 5 not in found


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=25))
def test_chains_end_where_steps_end(spark, edges):
    to = {}
    for a, b in edges:
        to[a] = min(b, to.get(a, b))
    want = {}
    for a in to:
        at, seen = to[a], {a}
        while at in to and at not in seen:
            seen.add(at)
            at = to[at]
        want[a] = None if at in to else at
    got = graphs.chain_ends(spark.createDataFrame([*edges, (None, 1), (2, None)], "a int, b int"), "a", "b").collect()
    assert {r["a"]: r["b"] for r in got} == want


def test_long_chains_take_few_rounds(spark, monkeypatch):
    n, rounds, plain = 300, [], graphs.written
    monkeypatch.setattr(graphs, "written", lambda df, label="step": rounds.append(1) or plain(df, label))
    got = graphs.chain_ends(spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")), "a", "b")
    assert {r["b"] for r in got.collect()} == {n} and len(rounds) <= 2 + 10
    links = spark.createDataFrame([(1, "x"), (2, "a"), (3, "loop"), (4, "none")], "source_article_id int, target_article_name string")
    redirects = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "x"), ("loop", "pool"), ("pool", "loop")], "title string, redirect string")
    articles = spark.createDataFrame([(10, "x")], "article_id int, title string")
    out = {r[0]: (r[1], r[2]) for r in J.resolve_redirects(links, redirects, articles).collect()}
    assert out == {1: ("x", 10), 2: ("x", 10), 3: (None, None), 4: ("none", None)}


# --- permutations and importance ---------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 500), st.integers(0, 1000))
def test_permutations_hit_every_position(n, seed):
    assert sorted(draws.permutation(n, seed)) == list(range(n))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1001])
def test_columns_permute_like_lists(spark, n):
    got = {r[0]: r[1] for r in spark.range(n).select("id", draws.permuted_position(F.col("id"), n, 5)).collect()}
    assert [got[i] for i in range(n)] == draws.permutation(n, 5)


def test_large_positions_stay_whole():
    a, b = draws._sides(10**15)
    assert a * b >= 10**15 and a * b - 10**15 < a
    seen = {draws._network(v, a, b, 3, lambda x, by: x // by) for v in range(10**15 - 1000, 10**15)}
    assert len(seen) == 1000 and all(0 <= v < a * b for v in seen)


def test_the_whole_column_is_permuted(spark):
    df = spark.createDataFrame([(i, float(i), None if i % 7 == 0 else f"t{i}") for i in range(300)], "id int, a double, b string")
    moved = RK.perturbed(df, ["a", "b"], seed=3, order=["id"])
    a = moved.filter("feature = 'a'").collect()
    pi = draws.permutation(300, 3)
    assert {r["id"]: r["a"] for r in a} == {pi[q]: float(q) for q in range(300)}
    assert all(r["b"] == (None if r["id"] % 7 == 0 else f"t{r['id']}") for r in a)
    b = {r["id"]: r["b"] for r in moved.filter("feature = 'b'").collect()}
    pi = draws.permutation(300, 4)
    assert b == {pi[q]: None if q % 7 == 0 else f"t{q}" for q in range(300)}


def test_stability_of_all_ranks_by_numpy(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(200, 3)) @ np.array([[1, 0.3, 0], [0, 1, 0.2], [0, 0, 1]])
    y = x @ [2.0, -1.0, 0.2] + rnd.normal(size=200)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id int, a double, b double, c double, y double")
    names, lengths = ["a", "b", "c"], [1, 3, 10]
    z, t = (x - x.mean(0)) / x.std(0), (y - y.mean()) / y.std()
    gram, goal = z.T @ z / 200, z.T @ t / 200
    weights = {0: np.zeros(3)}
    for n in range(1, 501):
        weights[n] = weights[n - 1] + (goal - gram @ weights[n - 1]) / 3
    base = np.abs(weights[500]) / np.abs(weights[500]).sum()

    def perturb(w):
        out = []
        for i in range(3):
            moved = z.copy()
            moved[draws.permutation(200, 42 + i), i] = z[:, i]
            out.append(np.mean((t - moved @ w) ** 2))
        return np.array(out) / sum(out)

    corr = np.abs(goal) / np.abs(goal).sum()
    for kind in ("weight", "perturb", "hybrid"):
        got = {r["length"]: r["distance"] for r in RK.rank_stability(df, names, "y", lengths, kind=kind, order=["id"]).collect()}
        for n in lengths:
            w = np.abs(weights[n]) / np.abs(weights[n]).sum()
            rank = {"weight": w, "perturb": perturb(weights[n]), "hybrid": (w + (perturb(weights[n]) + corr) / 2) / 2}[kind]
            assert got[n] == pytest.approx(np.sqrt(((rank - base) ** 2).sum()), abs=1e-9)


def grow_by_hand(x, t, trees, depth, seed, min_rows=2):
    """The same draws, one tree and node at a time."""
    t = t - t.mean(0)
    spread, out = (t * t).sum(), {}
    for tree in range(trees):
        todo = [(1, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) < min_rows or node >= 1 << depth:
                continue
            best = None
            for f in range(x.shape[1]):
                lo, hi = x[rows, f].min(), x[rows, f].max()
                if lo < hi:
                    cut = lo + draws.uniform(seed, tree, node, f) * (hi - lo)
                    left = x[rows, f] <= cut
                    if 0 < left.sum() < len(rows):
                        part = lambda r: (t[r].sum(0) ** 2).sum() / len(r)
                        gain = part(rows[left]) + part(rows[~left]) - part(rows)
                        if best is None or gain > best[0] + 1e-9:
                            best = gain, f, cut, left
            if best and best[0] > 1e-12 * spread:
                out[tree, node] = (best[1], best[2], best[0])
                todo += [(2 * node, rows[best[3]]), (2 * node + 1, rows[~best[3]])]
    return out


@pytest.mark.parametrize("classes", [None, ["r", "g", "b"]])
def test_extra_trees_by_hand(spark, classes):
    rnd = np.random.default_rng(8)
    x = np.round(rnd.normal(size=(150, 3)), 2)
    x[:, 2] = rnd.integers(0, 3, 150)
    y = np.array([["r", "g", "b"][int(v)] for v in np.clip(x[:, 0] + 1, 0, 2)]) if classes else 3 * x[:, 0] + x[:, 2] + rnd.normal(size=150) * 0.1
    rows = [(*map(float, r), v if classes else float(v)) for r, v in zip(x, y)] + [(float("nan"), 1.0, 1.0, rows_last(y, classes)), (None, 1.0, 1.0, rows_last(y, classes))]
    df = spark.createDataFrame(rows, f"a double, b double, c double, y {'string' if classes else 'double'}").repartition(4)
    forest = extra_trees.fit_extra_trees(df, ["a", "b", "c"], "y", classes=classes, trees=7, depth=4, seed=5)
    t = np.stack([y == c for c in classes], 1).astype(float) if classes else y[:, None]
    want = grow_by_hand(x, t, 7, 4, 5)
    got = {(r["tree"], r["node"]): r for r in forest.nodes.collect()}
    assert set(got) == set(want)
    for at, (f, cut, gain) in want.items():
        assert got[at]["feature"] == f and got[at]["cut"] == pytest.approx(cut) and got[at]["gain"] == pytest.approx(gain, rel=1e-6, abs=1e-9)
    ranks = forest.importances().collect()
    assert sum(r["importance"] for r in ranks) == pytest.approx(1) and ranks[0]["name"] == "a"
    constant = extra_trees.fit_extra_trees(df.select(F.lit(1.0).alias("a"), "y"), ["a"], "y", classes=classes, trees=2, depth=2)
    assert [r["importance"] for r in constant.importances().collect()] == [0.0]


def rows_last(y, classes):
    return "r" if classes else 1.0


# --- boosting ----------------------------------------------------------------------------------------------------------


def boost_by_hand(x, t, rounds, depth, step, classes):
    """Exact greedy histogram boosting on integer features, one row at a time."""
    k = t.shape[1]
    start = t.mean(0) if classes is None else np.log(np.clip(t.mean(0), 1e-9, 1))
    m = np.tile(start, (len(x), 1))
    for _ in range(rounds):
        e = np.exp(m - m.max(1, keepdims=True))
        p = m if classes is None else e / e.sum(1, keepdims=True)
        h = np.ones_like(p) if classes is None else p * (1 - p)
        g = t - p
        new = m.copy()
        for c in range(k):
            todo = [(np.arange(len(x)), 0)]
            while todo:
                rows, level = todo.pop()
                if not len(rows):
                    continue
                score = lambda r: g[r, c].sum() ** 2 / (h[r, c].sum() + 1e-300)
                best = (1e-12, None)
                if level < depth:
                    for f in range(x.shape[1]):
                        for cut in np.unique(x[rows, f])[:-1]:
                            left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                            gain = score(left) + score(right) - score(rows)
                            if min(h[left, c].sum(), h[right, c].sum()) >= 1 and gain > best[0] + 1e-9:
                                best = (gain, (left, right))
                if best[1]:
                    todo += [(part, level + 1) for part in best[1]]
                else:
                    new[rows, c] += step * g[rows, c].sum() / h[rows, c].sum()
        m = new
    return m


@pytest.mark.parametrize("classes", [None, [0, 1, 2]])
def test_boosting_by_hand(spark, classes):
    rnd = np.random.default_rng(3)
    x = rnd.integers(0, 9, (300, 2)).astype(float)
    y = (x[:, 0] // 3) if classes else np.sin(x[:, 0]) * 5 + x[:, 1] + rnd.normal(size=300)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id int, a double, b double, y double").repartition(3)
    model = boosting.fit_boosted(df, ["a", "b"], "y", classes=classes, rounds=4, depth=2, step=0.3)
    t = np.stack([y == c for c in classes], 1).astype(float) if classes else y[:, None]
    m = boost_by_hand(x, t, 4, 2, 0.3, classes)
    got = [r["prediction"] for r in model.predict(df).orderBy("id").collect()]
    assert got == pytest.approx(list(m.argmax(1) if classes else m[:, 0]))
    losses = [h[1] for h in model.history]
    assert len(losses) == 5 and losses == sorted(losses, reverse=True)


def test_boosting_stops_early_and_survives_gaps(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, float(v) if i % 9 else None, float(rnd.normal()), float("nan") if i % 50 == 3 else 1.0) for i, v in enumerate(rnd.normal(size=400))]
    df = spark.createDataFrame(rows, "id int, a double, y double, b double")
    model = boosting.fit_boosted(df, ["a", "b"], "y", held_out=F.col("id") % 4 == 0, rounds=60, depth=3, step=0.5, patience=4)
    assert len(model.trees) < 60 and model.best_round <= len(model.trees) and all(h[2] is not None for h in model.history)
    assert model.history_table(spark).count() == len(model.trees) + 1 or model.history_table(spark).count() == len(model.history)
    assert model.predict(df).filter("prediction is null or isnan(prediction)").count() == 0
    assert boosting.fit_boosted(df.limit(0), ["a"], "y", rounds=2, depth=1).history


def test_stored_margins_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 17), float(i % 5), float((i * i) % 23)) for i in range(200)], "a double, b double, y double")
    plain = boosting.fit_boosted(df, ["a", "b"], "y", rounds=7, depth=2)
    monkeypatch.setattr(boosting, "STORE_ROUNDS", 2)
    often = boosting.fit_boosted(df, ["a", "b"], "y", rounds=7, depth=2)
    assert [h[1] for h in often.history] == pytest.approx([h[1] for h in plain.history])


# --- other models ------------------------------------------------------------------------------------------------------


def test_coefficients_of_several_models_at_once(spark):
    rnd = np.random.default_rng(2)
    x = np.concatenate([rnd.normal(c, 0.3, (40, 2)) for c in ((0, 0), (4, 0), (0, 4))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0)], "x double, y double")
    start = x[[0, 50, 100, 10, 60]].tolist()
    got = {r["c"]: (r["coefficient"], r["rounds"]) for r in MD.partition_coefficients(df, ["x", "y"], range(2, 6), tol=0.0, max_iter=8, start=start).collect()}
    for c in range(2, 6):
        at = np.array(start[:c])
        for _ in range(8):
            near = 1 / np.maximum(((x[:, None] - at) ** 2).sum(2), 1e-16)
            u = near / near.sum(1, keepdims=True)
            fpc = (u * u).sum() / len(x)
            at = (u.T**2 @ x) / (u**2).sum(0)[:, None]
        assert got[c][0] == pytest.approx(fpc) and got[c][1] == 8
    assert max(got, key=lambda c: got[c][0]) == 3


def test_planted_change_points_are_found(spark):
    days = 1200
    rows = [("k", i, 50 + 0.05 * i + (0.3 * (i - 500) if i > 500 else 0) + 3 * math.sin(2 * math.pi * i / 7)) for i in range(days)]
    rows += [("flat", i, 50 + 0.05 * i + 2 * math.sin(2 * math.pi * i / 7)) for i in range(days)]
    df = spark.createDataFrame(rows, "key string, d int, y double").select("key", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d")).alias("ts"), "y")
    fitted = MD.seasonal_forecast(df, "key", "ts", "y", 100).join(df.withColumnsRenamed({"key": "series", "ts": "date"}), ["series", "date"])
    gap = {r["series"]: r["g"] for r in fitted.groupBy("series").agg(F.sqrt(F.avg(F.pow(F.col("yhat") - F.col("y"), 2.0))).alias("g")).collect()}
    straight = MD.seasonal_forecast(df, "key", "ts", "y", 100, changes=0).join(df.withColumnsRenamed({"key": "series", "ts": "date"}), ["series", "date"])
    before = {r["series"]: r["g"] for r in straight.groupBy("series").agg(F.sqrt(F.avg(F.pow(F.col("yhat") - F.col("y"), 2.0))).alias("g")).collect()}
    assert gap["k"] < 0.35 * before["k"] and gap["flat"] < 1.5
    bends = MD.seasonal_forecast(df, "key", "ts", "y", 1, weights=True).collect()
    assert len(bends) == 50
    strongest = max((r for r in bends if r["series"] == "k"), key=lambda r: abs(r["slope_change"]))
    assert abs((strongest["change"] - __import__("datetime").date(2020, 1, 1)).days - 500) <= 80
    assert sum(abs(r["slope_change"]) for r in bends if r["series"] == "flat") < 0.2 * sum(abs(r["slope_change"]) for r in bends if r["series"] == "k")
    assert sum(1 for r in bends if r["slope_change"] == 0) > 20


def test_rank_normality_by_hand(spark):
    rnd = np.random.default_rng(7)
    cols = {"bell": rnd.normal(3, 2, 300), "skew": rnd.exponential(1, 300), "same": np.ones(300)}
    rows = [tuple(float(cols[c][i]) for c in cols) for i in range(300)] + [(None, float("nan"), None)]
    got = {r["name"]: r for r in PR.normality_by_rank(spark.createDataFrame(rows, "bell double, skew double, same double"), list(cols)).collect()}
    scores = np.array([NormalDist().inv_cdf((i + 0.625) / 300.25) for i in range(300)])
    for c in ("bell", "skew"):
        assert got[c]["stat"] == pytest.approx(np.corrcoef(np.sort(cols[c]), scores)[0, 1] ** 2, abs=1e-12) and got[c]["n"] == 300
    assert got["bell"]["z"] < 1.645 < got["skew"]["z"] and got["same"]["z"] is None


def test_medians_stay_on_spark(spark):
    df = spark.createDataFrame([(float(i % 10), float(i * i % 101), None) for i in range(101)], "a double, b double, c double")
    a, b = np.median([i % 10 for i in range(101)]), np.median([i * i % 101 for i in range(101)])
    assert exact_medians(df, ["a", "b", "c"]) == {"a": a, "b": b, "c": None}


# --- files -------------------------------------------------------------------------------------------------------------


def png(width, height, kind):
    part = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + part(b"IDAT", zlib.compress(b"")) + part(b"IEND", b"")


def jpeg(width, height, channels, before=0):
    frame = struct.pack(">BHHB", 8, height, width, channels) + b"\0" * 3 * channels
    segment = lambda mark, data: b"\xff" + bytes([mark]) + struct.pack(">H", len(data) + 2) + data
    return b"\xff\xd8" + segment(0xE0, b"x" * before) + b"\xff" + segment(0xC2, frame) + b"\xff\xd9"


def test_headers_and_hashes_of_real_files(spark, tmp_path):
    made = {"a.png": png(7, 9, 2), "b.png": png(3, 3, 0), "c.jpg": jpeg(640, 480, 3, 5000), "d.jpg": jpeg(5, 6, 1), "e.gif": b"GIF89a" + struct.pack("<HH", 11, 12) + b"\0" * 30,
            "f.bmp": b"BM" + b"\0" * 16 + struct.pack("<ii", 20, -21) + struct.pack("<HH", 1, 24) + b"\0" * 8, "g.txt": b"no picture", "h": b"", "i.png": b"\x89PNG"}
    rows = [(f"sub{i % 2}/{n}", v) for i, (n, v) in enumerate(made.items())]
    root = f"{tmp_path}/files"
    assert files.write_files(spark.createDataFrame(rows, "name string, content binary").repartition(3), root) == len(made)
    sizes = {r["file"]: (r["width"], r["height"], r["channels"]) for r in files.read_image_sizes(spark, root).collect()}
    assert sizes == {"a.png": (7, 9, 3), "b.png": (3, 3, 1), "c.jpg": (640, 480, 3), "d.jpg": (5, 6, 1), "e.gif": (11, 12, 3), "f.bmp": (20, 21, 3), "g.txt": (None,) * 3,
                     "h": (None,) * 3, "i.png": (None,) * 3}
    assert {r["file"]: r["sha1_local"] for r in files.hash_files(spark, root).collect()} == {n: hashlib.sha1(v).hexdigest() for n, v in made.items()}
    meta = {os.path.basename(r["path"]): r for r in files.file_meta(spark, root).collect()}
    assert {n: m["length"] for n, m in meta.items()} == {n: len(v) for n, v in made.items()} and all(m["modified"] and m["sha1"] is None for m in meta.values())


def test_contents_are_hashed_piece_by_piece(tmp_path):
    path = tmp_path / "big"
    path.write_bytes(b"x" * (files.PIECE_BYTES * 2 + 17))
    (tmp_path / "_hidden").write_bytes(b"")
    reader = files.FileMetaReader({"path": str(tmp_path), "hash": "true"})
    parts = reader.partitions()
    (batch,) = [b for p in parts for b in reader.read(p)]
    assert batch.column("sha1").to_pylist() == [hashlib.sha1(path.read_bytes()).hexdigest()]
    assert dumps.reconcile is not None
