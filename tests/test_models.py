import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.operators import clean, conjoint, models, moments, scales, segments, stat_tests
from surveyloom.operators.profile import profile
from surveyloom.plans.fixtures import view


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=400)
    m = 0.6 * x + rng.normal(size=400)
    y = 0.3 * x + 0.5 * m + rng.normal(size=400)
    rows = [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, m, y))]
    return spark.createDataFrame(rows, "id bigint, x double, m double, y double").persist()


def standardized(v):
    return (v - v.mean()) / v.std()


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_regression_matches_least_squares(spark, noisy, partitions):
    rows, meta = models.fit_ols(noisy.repartition(partitions), "y", models.encode_predictors(noisy, ["x", "m"]))
    a = np.array([r[1:] for r in noisy.collect()])
    design = np.column_stack([np.ones(400), standardized(a[:, 0]), standardized(a[:, 1])])
    y = standardized(a[:, 2])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    resid = y - design @ beta
    se = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * (resid @ resid) / 397)
    assert [r[1] for r in rows] == pytest.approx(beta, abs=1e-10)
    assert [r[2] for r in rows] == pytest.approx(se, rel=1e-9)
    assert meta["r2"] == pytest.approx(1 - resid @ resid / (y @ y))


def test_too_few_rows_give_no_model(spark, noisy):
    few = noisy.limit(8)
    assert models.run_regression(few, "y", ["x", "m"])[0].isEmpty()
    assert models.run_regression(few, None, ["x"])[0].isEmpty()
    assert models.run_mediation(few, [("x", "m", "y")], "id").isEmpty()
    assert models.run_moderation(few, "y", ["x"], ["m"]).isEmpty()


def test_constant_outcome_gives_no_model(spark, noisy):
    assert models.run_regression(noisy.withColumn("y", F.lit(3.0)), "y", ["x"])[0].isEmpty()


def test_correlation_of_constant_is_null(spark, noisy):
    t = moments.correlations(noisy.withColumn("c", F.lit(0.1)), ["x", "c", "y"])
    r = {(row["a"], row["b"]): row["r"] for row in t.collect()}
    assert r[("x", "c")] is None and r[("c", "y")] is None and r[("x", "y")] is not None
    square = moments.correlation_square(t, ["x", "c", "y"]).collect()
    assert len(square) == 3 and {row["variable"] for row in square} == {"x", "c", "y"}


@pytest.mark.parametrize("partitions", [1, 5])
def test_bootstrap_does_not_depend_on_partitions(spark, noisy, partitions):
    path = [("x", "m", "y")]
    a = models.run_mediation(noisy.repartition(partitions), path, "id", draws=200).first()
    b = models.run_mediation(noisy.repartition(3, "x"), path, "id", draws=200).first()
    for c in ("indirect_effect", "boot_ci_low", "boot_ci_high"):
        assert a[c] == pytest.approx(b[c], rel=1e-9)


def test_bootstrap_interval_is_like_resampling(spark, noisy):
    got = models.run_mediation(noisy, [("x", "m", "y")], "id", draws=600).first()
    a = np.array([r[1:] for r in noisy.collect()])
    rng = np.random.default_rng(0)
    effects = []
    for _ in range(1500):
        r = np.corrcoef(a[rng.integers(0, 400, 400)].T)
        effects.append(r[0, 1] * (r[1, 2] - r[0, 1] * r[0, 2]) / (1 - r[0, 1] ** 2))
    low, high = np.percentile(effects, [2.5, 97.5])
    assert got["boot_ci_low"] == pytest.approx(low, abs=0.03) and got["boot_ci_high"] == pytest.approx(high, abs=0.03)
    assert got["boot_ci_low"] < got["indirect_effect"] < got["boot_ci_high"] and got["supported"]


def test_poisson_weights(spark):
    w = models.poisson_weights(np.arange(20000, dtype=np.int64) * 7919, 40, 42)
    assert w.mean() == pytest.approx(1.0, abs=0.01) and w.var() == pytest.approx(1.0, abs=0.02)
    assert (w == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)
    assert np.abs(np.corrcoef(w[:, :5].T)[np.triu_indices(5, 1)]).max() < 0.03


def gradient_descent(x, y, steps):
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    for _ in range(steps):
        g = design.T @ (1 / (1 + np.exp(-design @ beta)) - y) / len(y)
        g[1:] += 0.001 * beta[1:]
        beta -= 0.08 * g
    return beta


@pytest.mark.parametrize("cells", [50, 10**6])
def test_choice_model_on_profiles_equals_rows(spark, data_dir, cells):
    choice = view(spark, data_dir, "choice")
    attributes = ["product_type", "price_band", "package"]
    stats = profile(choice, attributes)
    profiles = conjoint.choice_profile_counts(choice, "chosen", attributes)
    design, groups = conjoint.attribute_design(profiles, attributes, stats)
    beta = conjoint.fit_choice(profiles, design, steps=12, task_cells=cells)
    row_design, _ = conjoint.attribute_design(choice, attributes, stats)
    rows = choice.select(*[c.alias(f"x{k}") for k, c in enumerate(row_design.values())], "chosen").toPandas().to_numpy(dtype=float)
    assert beta == pytest.approx(gradient_descent(rows[:, :-1], rows[:, -1], 12), abs=1e-10)
    assert list(groups) == attributes


def test_rating_model_is_minimum_norm(spark, data_dir):
    choice = view(spark, data_dir, "choice").drop("chosen")
    attributes = ["product_type", "price_band", "package"]
    got = conjoint.run_conjoint(choice, None, "rating", attributes)[0].collect()
    design, _ = conjoint.attribute_design(choice, attributes, profile(choice, attributes))
    rows = choice.select(*[c.alias(f"x{k}") for k, c in enumerate(design.values())], "rating").toPandas().to_numpy(dtype=float)
    x = np.column_stack([np.ones(len(rows)), rows[:, :-1]])
    beta = np.linalg.pinv(x.T @ x, rcond=1e-10) @ x.T @ standardized(rows[:, -1])
    assert [r["utility"] for r in got] == pytest.approx(beta, abs=1e-8)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_runs_do_not_depend_on_partitions(spark, partitions):
    rng = np.random.default_rng(2)
    values = np.round(rng.normal(size=500), 1)
    df = spark.createDataFrame([(i, float(v), "ab"[int(v > 0.4)]) for i, v in enumerate(values)], "i int, v double, g string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r["variable"]: r for r in stat_tests.runs_test(df.repartition(5), ["v", "g"], ["i"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    med = np.median(values)
    s = values[values != med] > med
    assert got["v"]["runs"] == 1 + (s[1:] != s[:-1]).sum() and got["v"]["n"] == len(s)
    top = values > 0.4 if (values > 0.4).mean() > 0.5 else values <= 0.4
    assert got["g"]["runs"] == 1 + (top[1:] != top[:-1]).sum() and got["g"]["n_high_or_top"] == top.sum()


def test_short_or_constant_sequences_are_left_out(spark):
    df = spark.range(19).withColumn("one", F.lit(1)).withColumn("x", F.col("id") % 2)
    assert stat_tests.runs_test(df, ["one", "x"], ["id"]).isEmpty()


def test_packed_and_text_cells_agree(spark, data_dir):
    survey = view(spark, data_dir, "survey")
    pairs = [("market_segment", "product_quality_3"), ("income", "segment")]
    stats = profile(survey)
    codes = {c: stat_tests.level_code(survey, c, [lv for lv, _ in stats[c].levels]) for p in pairs for c in p}
    a = stat_tests.coded_tests(survey, codes, pairs).orderBy("pair").collect()
    b = stat_tests.chi_square_cells(stat_tests.text_cells(survey, [(i, *p) for i, p in enumerate(pairs)])).orderBy("pair").collect()
    for x, y in zip(a, b):
        assert tuple(x) == pytest.approx(tuple(y), rel=1e-12)


def test_explicit_pair_with_many_levels(spark):
    df = spark.createDataFrame([(f"v{i % 90}", "ab"[i % 2], i % 3) for i in range(900)], "a string, b string, c int")
    t = stat_tests.run_independence_tests(df, [("a", "b")]).where("method = 'chi_square_independence'").collect()
    assert len(t) == 1 and t[0]["df"] == 89 and t[0]["statistic"] == pytest.approx(900.0)


def test_unknown_pairs_fall_back_to_all(spark):
    df = spark.createDataFrame([("ab"[i % 2], "xyz"[i % 3], float(i % 40)) for i in range(120)], "a string, b string, c double")
    t = stat_tests.run_independence_tests(df, [("a", "gone")]).where("method = 'chi_square_independence'").collect()
    assert [(r["variable_a"], r["variable_b"]) for r in t] == [("a", "b")]


def test_kmeans_matches_plain_lloyd(spark, noisy):
    points = segments.counted_points(noisy.select("x", "m"), ["x", "m"])
    centers, inertia = segments.fit_kmeans(points, ["x", "m"], 3, restarts=10)
    x = np.array([(r["x"], r["m"]) for r in noisy.collect()])
    best = np.inf
    rng = np.random.default_rng(0)
    for _ in range(20):
        c = x[rng.choice(400, 3, replace=False)]
        for _ in range(100):
            label = ((x[:, None] - c) ** 2).sum(2).argmin(1)
            c = np.array([x[label == k].mean(0) if (label == k).any() else x[0] for k in range(3)])
        best = min(best, ((x - c[label]) ** 2).sum())
    assert inertia == pytest.approx(best, rel=0.01)
    assert inertia == pytest.approx(((x[:, None] - centers) ** 2).sum(2).min(1).sum(), rel=1e-9)


def test_silhouette_by_definition(spark, noisy):
    points = segments.counted_points(noisy.select("x", "m"), ["x", "m"])
    centers = np.array([[-1.0, -1.0], [0.0, 0.5], [1.5, 1.0]])
    got = segments.silhouette(points, ["x", "m"], centers, noisy.orderBy("id").limit(60)).first()
    x = np.array([(r["x"], r["m"]) for r in noisy.orderBy("id").collect()])
    label = ((x[:, None] - centers) ** 2).sum(2).argmin(1)
    scores = []
    for i in range(60):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        a = d[label == label[i]].sum() / ((label == label[i]).sum() - 1)
        b = min(d[label == c].mean() for c in range(3) if c != label[i])
        scores.append((b - a) / max(a, b))
    assert got["silhouette"] == pytest.approx(np.mean(scores), rel=1e-9) and got["anchors"] == 60


def test_choice_of_k():
    assert segments.choose_k([(2, 0.3, 0.9), (3, 0.2, 0.4), (4, 0.1, 0.5)]) == 4
    assert segments.choose_k([(2, 0.3, 0.9), (3, 0.2, 0.4), (4, 0.01, 0.5)]) == 3
    assert segments.choose_k([(2, 0.3, 0.2), (5, 0.1, 0.6)]) == 5
    assert segments.choose_k([(2, 0.3, 0.9), (3, 0.2, 0.4)], 2) == 2
    assert segments.choose_k([(2, 0.01, 0.9)]) is None


def test_alpha_limits(spark):
    df = spark.createDataFrame([(1.0, 2.0, None)] * 20, "a double, b double, c double")
    rows = scales.cronbach_alphas(df, [["a", "b"], ["a", "c"]]).orderBy("subset").collect()
    assert [(r["n"], r["alpha"]) for r in rows] == [(20, None), (0, None)]


def test_correlated_items_form_a_construct(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(1, 6, 300)
    data = {n: np.clip(base + rng.integers(-1, 2, 300), 1, 5) for n in ("alpha", "bravo", "charlie")}
    data["noise"] = rng.integers(1, 6, 300)
    df = spark.createDataFrame([tuple(int(data[c][i]) for c in data) for i in range(300)], list(data))
    scored, summary, items = scales.detect_constructs(df)
    row = summary.first()
    assert row["construct"] == "construct_auto_1" and row["source"] == "correlation_auto"
    assert set(items["construct_auto_1"]) == {"alpha", "bravo", "charlie"}
    assert scored.select("construct_auto_1").first()[0] is not None


def test_configured_construct_takes_a_free_name(spark, data_dir):
    survey = view(spark, data_dir, "survey")
    scored, summary, items = scales.detect_constructs(survey, {"brand_trust": ["brand_trust", "brand_trust_2"]})
    assert items["brand_trust_score"] == ["brand_trust", "brand_trust_2"]
    assert summary.where("source = 'config'").first()["construct_base"] == "brand_trust"


def test_k_of_equal_silhouettes_is_the_smaller():
    assert segments.choose_k([(3, 0.2, 0.5), (4, 0.2, 0.5)]) == 3


def test_start_rows_do_not_depend_on_repeated_rows(spark):
    rows = [(float(i % 13), float(i % 7)) for i in range(400)]
    once = spark.createDataFrame(sorted(set(rows)), "x double, m double")
    many = segments.counted_points(spark.createDataFrame(rows, "x double, m double"), ["x", "m"])
    assert many.count() == once.count()
    drawn = segments.start_rows(many, ["x", "m"], 12, 42)
    assert len({tuple(r) for r in drawn.tolist()}) == 12


def test_attributes_with_many_levels_are_complete(spark):
    rows = [(i, f"b{i % 80:02d}", f"c{i % 3}", int(i * 7 % 5 < 2)) for i in range(1600)]
    df = spark.createDataFrame(rows, "respondent int, brand string, color string, chosen int")
    utilities, importance, kind = conjoint.run_conjoint(df, attributes=("brand", "color"), steps=20)
    assert kind == "choice" and {r["term"] for r in utilities.collect()} >= {f"brand_b{i:02d}" for i in range(80)} | {"color_c0", "color_c1", "color_c2"}
    assert {r["attribute"] for r in importance.collect()} == {"brand", "color"}
    assert clean.dummy_encode(df, "brand", False, ["respondent"]).columns[1:] == [f"brand_b{i:02d}" for i in range(80)]


def test_named_entries_are_not_cut(spark):
    names = [f"v{i}" for i in range(16)]
    df = spark.createDataFrame([tuple((r >> i % 5) % 4 for i in range(16)) for r in range(60)], ", ".join(f"{n} int" for n in names))
    pairs = [(a, b) for a in names for b in names if a < b][:120]
    tests = stat_tests.run_independence_tests(df, pairs).where("method = 'chi_square_independence'")
    assert tests.count() == 120


def test_correlation_square_of_awkward_columns(spark):
    df = spark.createDataFrame([(float(i), float(-i), 3.0) for i in range(20)], "a double, b double, flat double")
    square = {r["variable"]: r for r in moments.correlation_square(moments.correlations(df, ["a", "b", "flat"]), ["a", "b", "flat"]).collect()}
    assert square["a"]["a"] == 1 and square["a"]["b"] == pytest.approx(-1) and square["flat"]["flat"] is None and square["flat"]["a"] is None


def test_persona_details_without_variables(spark):
    df = spark.createDataFrame([(1, 2.0)], "segment int, x double")
    details = segments.persona_details(df, "segment", {"basic": [], "behavior": [], "cognitive": []}, {})
    assert details.count() == 0 and segments.persona_info(details, "segment").count() == 0


def test_configured_constructs_get_variable_names(spark):
    rows = [(i % 5 + 1, (i + i % 2) % 5 + 1) for i in range(50)]
    df = spark.createDataFrame(rows, "first_item int, second_item int")
    _, summary, found = scales.detect_constructs(df, {"Product Quality": ["first_item", "second_item"]})
    assert list(found) == ["product_quality"] and summary.first()["source"] == "config"


def test_construct_bases():
    names = {"price_value_2": "price_value", "taste_a": "taste", "taste_a_12": "taste", "taste_12_a": "taste_12", "deep_blue_sea": "deep_blue", "q07": "q07", "product_quality_x": "product_quality"}
    assert {n: scales.base_construct_name(n) for n in names} == names


@pytest.mark.parametrize("cells", [40, 10**6])
def test_kmeans_from_given_centers(spark, noisy, cells):
    """One task or many that exchange sums: the same passes as a plain loop."""
    points = segments.counted_points(noisy.select("x", "m"), ["x", "m"])
    start = np.array([[-1.0, 0.0], [0.0, 0.0], [1.0, 0.5]])
    centers, inertia = segments.fit_many(points, ["x", "m"], [3], max_iter=4, starts={3: [start]}, task_cells=cells)[3]
    x, c = np.array([(r["x"], r["m"]) for r in noisy.collect()]), start
    for _ in range(4):
        label = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        c = np.array([x[label == k].mean(0) for k in range(3)])
    assert centers == pytest.approx(c, abs=1e-9) and inertia == pytest.approx(((x[:, None] - c) ** 2).sum(2).min(1).sum(), rel=1e-9)


def test_iteration_over_empty_tables(spark):
    from surveyloom.operators.rounds import iterated
    assert iterated(spark.createDataFrame([], "x double, y double"), 0, lambda rows, exchange: exchange.total(rows.sum(axis=0)) + len(rows)).tolist() == [0, 0]


@pytest.mark.parametrize("room", [1, 64 << 20])
def test_reliability_of_many_sets(spark, monkeypatch, room):
    """Pairs, triples and a long set over answers with gaps, in one scan, also where patterns are folded one by one."""
    monkeypatch.setattr(scales, "_PATTERN_BYTES", room)
    rng = np.random.default_rng(6)
    base = rng.integers(1, 6, 400)
    x = np.clip(base[:, None] + rng.integers(-2, 3, (400, 12)), 1, 7).astype(float)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 11] = 4.0
    names = [f"i{k}" for k in range(12)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{n} double" for n in names))
    sets = [*scales.item_subsets(names), names[:9], ["i3", "i11"], ["i11"]]
    rows = {r["subset"]: r for r in scales.cronbach_alphas(df, sets).collect()}
    assert len(rows) == len(sets) == 12 * 11 // 2 + 220 + 3
    for s, items in enumerate(sets):
        part = x[:, [names.index(i) for i in items]]
        part = part[~np.isnan(part).any(axis=1)]
        k, total = len(items), part.sum(axis=1).var(ddof=1)
        want = k / (k - 1) * (1 - part.var(axis=0, ddof=1).sum() / total) if k > 1 and total > 1e-12 else None
        assert rows[s]["n"] == len(part) and rows[s]["alpha"] == (None if want is None else pytest.approx(want, abs=1e-9))


def test_picks_of_the_threshold_graph():
    rng = np.random.default_rng(8)
    for _ in range(30):
        items = [f"v{k}" for k in range(9)]
        r = {(a, b): float(rng.choice([0.3, 0.46, 0.5, 0.6, 0.7, rng.random()])) for i, a in enumerate(items) for b in items[i + 1:]}
        at = lambda a, b: r[min(a, b), max(a, b)]
        graph, free, want = scales.ThresholdGraph(items, r), [i for i in items if i != "v4"], []
        while True:
            pairs = [(a, b) for i, a in enumerate(free) for b in free[i + 1:]]
            pair = max(pairs, key=lambda p: at(*p), default=None)
            if pair is None or at(*pair) < 0.55:
                break
            third = [c for c in free if c not in pair and all(at(c, p) >= 0.45 for p in pair)][:1]
            want.append([*pair, *third])
            free = [i for i in free if i not in want[-1]]
        assert list(graph.picks({"v4"})) == want and all(w in graph.candidates() for w in want)


def test_descriptives_of_awkward_columns(spark):
    from surveyloom.operators import describe
    df = spark.createDataFrame([(None, 5.0, -0.0), (None, 5.0, 0.0), (None, float("nan"), 1e9 + 1), (None, 5.0, 1e9 + 2)], "none double, flat double, big double")
    got = {r["variable"]: r for r in describe.descriptives(df).collect()}
    assert (got["none"]["count"], got["none"]["missing"], got["none"]["unique"], got["none"]["mean"]) == (0, 4, 0, None)
    assert (got["flat"]["count"], got["flat"]["missing"], got["flat"]["std"], got["flat"]["unique"]) == (3, 1, 0.0, 1)
    assert got["big"]["unique"] == 3 and got["big"]["std"] == pytest.approx(np.std([0, 0, 1e9 + 1, 1e9 + 2], ddof=1), rel=1e-12)
    assert describe.descriptives(df.limit(0)).count() == 0


def test_values_sent_in_parts_count_alike(spark, monkeypatch):
    from surveyloom.operators import profile as profiles
    df = spark.range(5000).selectExpr("cast(id % 700 as double) as a", "cast(id as double) as b")
    want = {("a", float(v)): len(range(v, 5000, 700)) for v in range(700)} | {("b", float(v)): 1 for v in range(5000)}
    for held in (10, 2_000_000):
        monkeypatch.setattr(profiles, "_HELD_VALUES", held)
        assert {(r["variable"], r["value"]): r["n"] for r in profiles.numeric_frequencies(df, ["a", "b"]).collect()} == want
