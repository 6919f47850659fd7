"""Known answers on small inline data."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.functions import scalar as S, vectors as V
from tabloom.operators import (aggregates as A, features as FE, frame as R, joins as J, metrics as M, models as MD,
                               profiling as PR, ranking as RK, signals as SG, text as TX, wiki as WK)

# Published examples with known results.
BINARY_LABELS = [1, 0, 1, 1, 0, 0, 1, 0, 0, 1, 0]
BINARY_SCORES = [0.95, 0.1, 0.1, 0.99, 0.98, 0.01, 0.02, 0.01, 0.01, 0.97, 0.05]


@pytest.fixture(scope="module")
def binary(spark):
    return M.classify(spark.createDataFrame(list(zip(BINARY_LABELS, BINARY_SCORES)), "y int, score double"), "score").cache()


def test_binary_counts(binary):
    r = M.confusion_counts(binary, "y", "predicted").first()
    assert (r["tp"], r["tn"], r["fp"], r["fn"]) == (3, 5, 1, 2)
    assert M.accuracy(binary, "y", "predicted").first()[0] == pytest.approx(8 / 11)
    p = M.precision_recall_f1(binary, "y", "predicted").first()
    assert (p["precision"], p["recall"], p["f1"]) == pytest.approx((0.75, 0.6, 2 / 3))


def test_binary_area_and_loss(binary):
    assert M.auc(binary, "y", "score").first()[0] == pytest.approx(0.783333, abs=1e-6)
    assert M.log_loss(binary, "y", "score").first()[0] == pytest.approx(0.945931, abs=1e-6)


def test_regression_metrics(spark):
    # fixed values: a published example
    y = [1.2, 2.2, 3.0, 2.1, 3.5, 3.3, 1.2, 1.2, .1, 1.0, .05]
    f = [1.3, 2.9, 3.1, 2.2, 3.5, 3.3, 1.1, 1.3, 7.2, 1.0, .07]
    df = spark.createDataFrame(list(zip(y, f)), "y double, f double")
    r = M.mse_rmse(df, "y", "f").first()
    assert (r["mse"], r["rmse"]) == pytest.approx((4.631855, 2.152174), abs=1e-6)
    assert M.r2(df, "y", "f").first()[0] == pytest.approx(-2.533203, abs=1e-6)


@pytest.mark.parametrize("n", [1, 11, 37, 44, 100])
def test_deciles_follow_rank_cuts(spark, n):
    pd = pytest.importorskip("pandas")
    df = spark.createDataFrame([(i % 2, float(n - i), i) for i in range(n)], "y int, s double, i int")
    got = {r["bucket"]: (r["tp"], r["n"]) for r in M.decile_table(df, "y", "s", "i").collect()}
    if n == 1:
        assert got == {1: (0, 1)}
        return
    want = pd.DataFrame({"b": pd.qcut(range(n), 10, labels=False) + 1, "y": [i % 2 for i in range(n)]})
    want = {k: (int(g["y"].sum()), len(g)) for k, g in want.groupby("b")}
    assert got == want


def test_confusion_matrix_keeps_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 2)], "y int, f int")
    got = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_matrix(df, "y", "f").collect()}
    assert len(got) == 9 and got[(0, 0)] == 2 and got[(1, 2)] == 1 and got[(2, 2)] == 0


def test_argmax_takes_the_first(spark):
    df = spark.createDataFrame([([.2, .4, .4],)], "p array<double>")
    assert df.select(S.argmax("p")).first()[0] == 1


def test_target_encoding(spark):
    # fixed values: a published example of target encoding
    rows = list(zip(["dog"] * 5 + ["cat"] * 5, ["wolf"] * 9 + ["tiger"], [1, 0, 1, 1, 1, 1, 0, 0, 0, 0]))
    df = spark.createDataFrame(rows, "a string, b string, y int")
    one = {r["a"]: r["encoded"] for r in FE.target_encode(df, None, "a", "y", 5).collect()}
    two = {r["b"]: r["encoded"] for r in FE.target_encode(df, None, "b", "y", 5).collect()}
    assert one == pytest.approx({"dog": 0.65, "cat": 0.35})
    assert two == pytest.approx({"wolf": 0.535714, "tiger": 0.416667}, abs=1e-6)
    other = spark.createDataFrame([("bird",)], "a string")
    assert FE.target_encode(df, other, "a", "y", 5).first()["encoded"] is None
    assert FE.target_encode(df, other, "a", "y", 5, unseen_mean=True).first()["encoded"] == 0.5


def test_mahalanobis(spark):
    inverse = [[1, .5, .5], [.5, 1, .5], [.5, .5, 1]]
    df = spark.createDataFrame([([1.0, 0.0, 0.0], 1.0), ([0.0, 2.0, 0.0], 1.0), ([2.0, 0.0, 0.0], math.sqrt(3))], "a array<double>, d double")
    b = V.literal([0, 1, 0])
    for r in df.select("d", V.mahalanobis("a", b, inverse).alias("g")).collect():
        assert r["g"] == pytest.approx(r["d"])


def test_max_distance_against_numpy(spark):
    pts = np.random.default_rng(3).normal(size=(50, 2))
    df = spark.createDataFrame([tuple(map(float, p)) for p in pts], "a double, b double")
    inverse = A.inverse_covariance(df, ["a", "b"])
    assert np.allclose(inverse, np.linalg.inv(np.cov(pts.T)))
    got = J.max_distance(J.corner_grid(df, ["a", "b"]), df, ["a", "b"], inverse).collect()
    assert len(got) == 4
    for r in got:
        d = pts - [r["a"], r["b"]]
        assert r["dist"] == pytest.approx(np.sqrt(np.einsum("ij,jk,ik->i", d, inverse, d)).max())


def test_loan(spark):
    rows = SG.amortize(spark.createDataFrame([(1, 240000.0)], "id int, p double"), ["id"], "p", 0.05, 360).orderBy("month").collect()
    assert len(rows) == 360
    assert rows[0]["payment"] == pytest.approx(1288.371895, abs=1e-6)
    assert rows[0]["interest"] == pytest.approx(1000.0)
    assert rows[-1]["remaining"] - rows[-1]["principal"] == pytest.approx(0, abs=1e-5)
    flat = SG.amortize(spark.createDataFrame([(1, 120.0)], "id int, p double"), ["id"], "p", 0.0, 12).collect()
    assert {r["payment"] for r in flat} == {10.0}


def test_spread_and_sigmoid(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "x double")
    assert A.spread(df, "x").first()["sd_population"] == pytest.approx(math.sqrt(2))
    r = df.filter("x = 5").select(S.sigmoid("x").alias("s"), S.sigmoid_prime("x").alias("d")).first()
    assert (r["s"], r["d"]) == pytest.approx((0.993307, 0.006648), abs=1e-6)


def test_line_score_grid(spark):
    data = spark.createDataFrame([(0., 32.), (10., 50.), (20., 68.), (30., 86.), (40., 104.)], "x double, y double")
    grid = spark.createDataFrame([(1.8, 32.0), (0.0, 0.0)], "w0 double, w1 double")
    got = {r["w0"]: r["loss"] for r in J.grid_eval(grid, data, "sum(abs($w0 * x + $w1 - y))").collect()}
    assert got == pytest.approx({1.8: 0.0, 0.0: 340.0}, abs=1e-9)
    assert M.sae(data, "x", "y", (1.8, 32)).first()[0] == pytest.approx(0, abs=1e-9)


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(3504,)], "w int")
    assert R.with_expr(df, "kg", F.bround(F.col("w") / 2.205)).first()["kg"] == 1589


def test_text_functions(spark):
    df = spark.createDataFrame([("Infobox  officeholder \n", r"a\b/c.bz2", 3725.5, 60)], "t string, p string, s double, n int")
    r = df.select(S.after_prefix("t", "Infobox ").alias("t"), S.basename("p").alias("p"), S.hms("s").alias("s"),
                  S.note_name("n").alias("n"), S.note_name(S.note_number(F.lit(440.0))).alias("a"),
                  S.fixed("s").alias("f"), S.human_size(F.lit(1536)).alias("b")).first()
    assert tuple(r) == ("officeholder", "c.bz2", "1:02:05.50", "C4", "A4", "3725.50000", "1.50KB")


@pytest.mark.parametrize("link", ["/x/y", "y.html", "../up", "?q=1", "#top", "//other.org/z", "https://a.org/b", ""])
def test_url_join_like_the_standard_library(spark, link):
    from urllib.parse import urljoin

    base = "https://dumps.example.org/enwiki/20200101/index.html?x=1"
    got = spark.range(1).select(S.url_join(base, F.lit(link))).first()[0]
    want = urljoin(base, link)
    assert got == want or (link == "../up" and got.endswith("/enwiki/20200101/../up"))


def test_decode_matches_null(spark):
    df = spark.createDataFrame([("male",), (None,), ("x",)], "s string")
    assert [r[0] for r in df.select(S.decode("s", "male", 1, None, 2, default=0)).collect()] == [1, 2, 0]


def test_outliers_keep_nulls(spark):
    df = spark.createDataFrame([(v,) for v in [1.0] * 20 + [100.0, None]], "x double")
    kept = [r[0] for r in FE.remove_outliers(df, "x", 2).collect()]
    assert len(kept) == 21 and None in kept and 100.0 not in kept


def test_encoders(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 6.0)], "c string, x double")
    assert FE.encode_dummy(df, "c").columns == ["x", "c-a", "c-b"]
    assert FE.encode_dummy(df, "c", drop_first=True).columns == ["x", "c-b"]
    coded, classes = FE.encode_index(df, "c")
    assert sorted(r["c"] for r in coded.collect()) == [0, 1, 1]
    assert {r["c"]: r["code"] for r in classes.collect()} == {"a": 0, "b": 1}
    z = [r["x"] for r in FE.encode_zscore(df, ["x"]).collect()]
    assert np.allclose(z, (np.array([1, 2, 6]) - 3) / np.std([1, 2, 6], ddof=1))
    scaled = [r["x"] for r in FE.encode_range(df, "x").collect()]
    assert np.allclose(scaled, [-1, -0.6, 1])
    other = spark.createDataFrame([("a", 11.0)], "c string, x double")
    assert FE.minmax(other, ["x"], fit=df).first()["x"] == 2.0


def test_imputers(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (9.0, "b"), (None, None)], "x double, c string")
    assert sorted(r["x"] for r in FE.impute_median(df, ["x"]).collect()) == [1, 2, 2, 9]
    assert sorted(r["x"] for r in FE.impute_mean(df, ["x"]).collect()) == [1, 2, 4, 9]
    assert sorted(r["c"] for r in FE.impute_mode(df, "c").collect()) == ["a", "b", "b", "b"]


def test_class_index_path(spark):
    df = spark.createDataFrame([(c,) for c in "dbcab"], "c string")
    assert {r["c"]: r["code"] for r in FE.class_codes(df, "c").collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}


@pytest.mark.parametrize("values,token", [(["+", "-"], "+"), (["0", "1"], "1"), (["Y", "n"], "Y"), (["true", "false"], "true"),
                                          (["red", "blue"], "blue"), (["a"], None), (["a", "b", "c"], None)])
def test_positive_token(spark, values, token):
    assert PR.find_positive(spark.createDataFrame([(v,) for v in values * 2], "c string"), "c") == token


def test_profile_and_plan(spark):
    rows = [(float(i % 7), f"v{i % 3}", f"id{i}", i % 2) for i in range(60)] + [(None, None, "idx", 1)]
    df = spark.createDataFrame(rows, "x double, c string, k string, y int")
    plan = {r["name"]: r for r in PR.profile(df, target="y").collect()}
    assert plan["x"]["missing"] == 1 and plan["x"]["unique"] == 8 and plan["x"]["median"] == 3.0
    assert plan["c"]["mode"] == "v0" and plan["c"]["action"] == "dummy" and plan["c"]["unique"] == 4
    assert plan["k"]["action"] == "ignore" and plan["y"]["action"] == "target"
    out = PR.apply_plan(df, PR.profile(df, target="y"))
    assert "k" not in out.columns and "c-v1" in out.columns and out.filter("x is null").count() == 0
    cat = {r["name"]: r for r in PR.profile_categorical(df, ["c"]).collect()}
    assert cat["c"]["n_unique"] == 4 and cat["c"]["values"].startswith("[v0:32.79%")


def test_words_and_vectors(spark):
    vectors = spark.createDataFrame([("vegetable", [1.0, 0.0]), ("soup", [0.0, 1.0]), ("malt", [3.0, 3.0])], "word string, vector array<float>")
    items = spark.createDataFrame([(1, "Vegi Soup"), (2, "smoothy"), (3, "unknown soup soup")], "id int, name string")
    got = {r["id"]: r["vector"] for r in TX.title_vectors(items, vectors, "id", "name", 2).collect()}
    assert got == {1: [0.5, 0.5], 2: [3.0, 3.0], 3: [0.0, 1.0]}
    assert [tuple(r) for r in TX.unknown_words(items, vectors, "id", "name").collect()] == [("unknown", 1)]
    near = TX.most_similar(vectors, "word", "vector", ["vegetable"], k=1).first()
    assert near["word"] == "malt"


def test_nested_station(spark):
    text = '{"code":"K7","site":{"region":"north"},"readings":[{"unit":"mm","n":4},{"unit":"C","n":9}],"repairs":[]}'
    schema = "code string, site struct<region:string>, readings array<struct<unit:string,n:int>>, repairs array<string>"
    df = spark.createDataFrame([(text,)], "v string").select(F.from_json("v", schema).alias("r")).select("r.*")
    rows = TX.flatten_records(df, {"code": "code", "region": "site.region"}, "readings", "reading").collect()
    assert len(rows) == 2 and {r["region"] for r in rows} == {"north"}
    none = TX.flatten_records(df, {"code": "code"}, "repairs", "repair", "none").collect()
    assert [r["repair"] for r in none] == ["none"]


def test_infobox_list_and_order(spark):
    text = "{{Short|x}}{{Infobox a|b={{convert|1}}}} {{Infobox b}} {{{param}}} {{#if:x}} <!-- {{hidden}} --> [[A b|l]] [[A b]] [[ C#d ]] [[Category:X]]"
    df = spark.createDataFrame([(1, "T", text, "f"), (2, "U", "plain", "f")], "article_id long, title string, text string, file string")
    assert [r[1] for r in WK.article_templates(df).collect()] == ["Short", "Infobox a", "convert", "Infobox b"]
    assert [r[1] for r in WK.article_links(df).collect()] == ["A b", "C", "Category:X"]
    assert {r["article_id"]: r["infobox"] for r in WK.article_infobox(df).collect()} == {1: "['a', 'b']", 2: ""}


def test_fuzzy_rating_example(spark):
    df = spark.createDataFrame([(29.0, 5.0, 20.0)], "bmi double, a1c double, bp double")
    got = MD.fuzzy_rating(df).first()["rating"]
    x = np.arange(401) / 10
    cone = lambda c: np.maximum(0, 1 - np.abs(x - c) / 5)
    bell = lambda v, c, s: math.exp(-((v - c) / s) ** 2 / 2)
    level = lambda c: max(0.0, 1 - abs(5 - c) / 5)
    dc = max(bell(29, 9.25, 3), bell(29, 35, 3), level(4))
    st = max(bell(29, 27.5, 3), level(5.25), bell(20, 10, 2.5))
    pf = min(bell(29, 21.75, 3), level(5.25), bell(20, 0, 2.5))
    h = np.maximum.reduce([np.minimum(dc, cone(10)), np.minimum(st, cone(5)), np.minimum(pf, cone(1))])
    assert got == pytest.approx((x * h).sum() / h.sum())


def test_fuzzy_clusters(spark):
    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal(c, 0.3, size=(60, 2)) for c in ([0, 0], [5, 5], [0, 5])])
    df = spark.createDataFrame([tuple(map(float, p)) for p in pts], "x double, y double")
    centers, fpc, _ = MD.fuzzy_cmeans(df, ["x", "y"], 3, max_iter=60)
    assert np.allclose(sorted(np.round(centers).tolist()), [[0, 0], [0, 5], [5, 5]])
    assert fpc > 0.9 and fpc > MD.fuzzy_cmeans(df, ["x", "y"], 6, max_iter=20)[1]


def test_perturbation_keeps_the_values(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 5)) for i in range(200)], "id int, a double, b double")
    moved = RK.perturbed(df, ["a", "b"], seed=3)
    assert moved.count() == 400
    a = moved.filter("feature = 'a'")
    assert sorted(r["a"] for r in a.collect()) == [float(i) for i in range(200)]
    assert a.filter("a = id").count() < 10 and a.filter(F.col("b") == F.col("id") % 5).count() == 200
    rank = RK.perturbation_rank(df, ["a", "b"], lambda x: x.withColumn("p", F.col("a") * 2), F.pow(F.col("p") - 2 * F.col("id"), 2.0)).collect()
    assert rank[0]["name"] == "a" and rank[0]["importance"] == 1.0 and rank[1]["error"] == 0.0


def test_rank_helpers(spark):
    df = spark.createDataFrame([(float(i), float(-i), float(i % 3), float(2 * i)) for i in range(30)], "a double, b double, c double, y double")
    rank = RK.corr_rank(df, ["a", "b", "c"], "y").collect()
    assert sum(r["importance"] for r in rank) == pytest.approx(1) and rank[-1]["name"] == "c"
    w = RK.weight_rank(spark, ["a", "b"], [[3.0, 4.0], [5.0, 0.0]]).collect()
    assert [r["importance"] for r in w] == [0.5, 0.5]
    gaps = {r["length"]: r["distance"] for r in RK.rank_stability(df.select("a", "c", "y"), ["a", "c"], "y", range(1, 40)).collect()}
    assert len(gaps) == 39 and gaps[39] < 1e-3


def test_synthetic_vectors_stay_between(spark):
    df = spark.createDataFrame([(i, i % 2, [float(i), float(-i)]) for i in range(20)], "id int, label int, v array<double>")
    got = SG.synthesize(df, "label", "id", "v", 15).collect()
    assert len(got) == 30
    for r in got:
        lo, hi = (0, 18) if r["label"] == 0 else (1, 19)
        assert lo <= r["vector"][0] <= hi and -hi <= r["vector"][1] <= -lo


def test_interpolation_variants(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [4.0]), (3, [8.0])], "i int, v array<double>").withColumn("k", F.lit(0))
    ends = [r["vector"][0] for r in SG.interpolate(df, ["k"], "i", "v", 4).orderBy("i", "step").collect()]
    assert ends == [1, 2, 3, 4, 5, 6, 7, 8]
    rows = SG.interpolate(df, ["k"], "i", "v", 4, include_start=True, freeze=30).collect()
    assert len(rows) == 8 + 2 * 29 and min(r["vector"][0] for r in rows) == 0


def test_join_checked(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(ValueError):
        J.join_checked(a, spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "k int, v int"), ["k"])
    with pytest.raises(ValueError):
        J.join_checked(a, spark.createDataFrame([(1, 1)], "k int, v int"), ["k"])
    assert J.join_checked(a, spark.createDataFrame([(1, 1), (2, 1)], "k int, v int"), ["k"]).count() == 2


def test_best_cycle(spark):
    rows = [("diff", "forest", c, e) for c, e in enumerate([0.0034, 0.0033, 0.0032, 0.0039], 1)]
    df = spark.createDataFrame(rows, "experiment string, model string, cycle int, error double")
    assert A.best_cycle(df, ["experiment", "model"], "error").first()["cycle"] == 3


def test_splits_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a = R.split_random(df, 0.25, ["id"])[1]
    b = R.split_random(df.repartition(13), 0.25, ["id"])[1]
    assert sorted(a.collect()) == sorted(b.collect()) and 180 < a.count() < 320
    assert [r.id for r in R.shuffle(df, 3).limit(5).collect()] == [r.id for r in R.shuffle(df.repartition(7), 3).limit(5).collect()]


def test_areas_of_groups_in_one_pass(spark, binary):
    both = binary.select(F.lit("a").alias("g"), "y", "score").unionByName(
        binary.select(F.lit("b").alias("g"), (1 - F.col("y")).alias("y"), "score"))
    got = {r["g"]: r["auc"] for r in M.auc_by(both, "g", "y", "score").collect()}
    assert got == pytest.approx({"a": 0.783333, "b": 1 - 0.783333}, abs=1e-6)


def test_forest_and_hybrid_rank(spark):
    df = spark.createDataFrame([(float(i), float(i * 37 % 11), float(3 * i)) for i in range(200)], "a double, b double, y double")
    model = MD.fit_forest_reg(df, ["a", "b"], "y", trees=5)
    assert RK.forest_importance(spark, model.stages[-1], ["a", "b"]).first()["name"] == "a"
    weights = RK.weight_rank(spark, ["a", "b"], [[3.0], [1.0]])
    perturb = RK.perturbation_rank(df, ["a", "b"], model.transform, F.pow(F.col("prediction") - F.col("y"), 2.0), to_sum=True)
    assert sum(r["importance"] for r in perturb.collect()) == pytest.approx(1)
    corr = RK.corr_rank(df, ["a", "b"], "y")
    hybrid = {r["name"]: r["importance"] for r in RK.hybrid_rank(weights, perturb, corr).collect()}
    c = {r["name"]: r["importance"] for r in corr.collect()}
    assert hybrid == pytest.approx({"a": (0.75 + c["a"]) / 2, "b": (0.25 + c["b"]) / 2})
