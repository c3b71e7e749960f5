import numpy as np
import random
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from surveyloom.operators import describe, headers, ordered, pricing


def frequency_rows():
    rng = np.random.default_rng(1)
    rows = [("hot", float(v), int(n)) for v, n in zip(rng.permutation(3000) * 0.5, rng.integers(1, 5, 3000))]
    rows += [("spread", float(v) ** 9, 1) for v in range(1, 900)]
    rows += [("single", 4.0, 7)]
    return rows


@pytest.mark.parametrize("partitions", [1, 7, 64])
@pytest.mark.parametrize("max_rows", [50, 10**6])
def test_running_totals_match_numpy(spark, partitions, max_rows):
    rows = frequency_rows()
    df = spark.createDataFrame(rows, "k string, v double, n bigint").repartition(partitions)
    got = {(r["k"], r["v"]): (r["cum_n"], r["tot_n"]) for r in ordered.running_totals(df, ["k"], "v", ["n"], max_rows).collect()}
    assert len(got) == len(rows)
    for k in ("hot", "spread", "single"):
        mine = sorted((v, n) for kk, v, n in rows if kk == k)
        total = sum(n for _, n in mine)
        cum = 0
        for v, n in mine:
            cum += n
            assert got[(k, v)] == (cum, total)


@pytest.mark.parametrize("max_rows", [40, 10**6])
def test_quantiles_match_numpy(spark, max_rows):
    df = spark.createDataFrame(frequency_rows(), "k string, v double, n bigint")
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.75, "e": 1.0}
    for r in ordered.weighted_quantiles(df, ["k"], "v", "n", probs, max_rows).collect():
        values = np.repeat([v for k, v, _ in frequency_rows() if k == r["k"]], [n for k, _, n in frequency_rows() if k == r["k"]])
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


@pytest.mark.parametrize("max_rows", [20, 10**6])
def test_descriptives_of_a_large_group(spark, max_rows):
    rng = np.random.default_rng(3)
    values = rng.normal(1e6, 3, 500)
    df = spark.createDataFrame([(float(v), None) for v in values], "x double, empty double")
    rows = {r["variable"]: r for r in describe.descriptives(df, max_rows=max_rows).collect()}
    x = rows["x"]
    assert x["std"] == pytest.approx(values.std(ddof=1), rel=1e-9)
    assert x["p25"] == pytest.approx(np.quantile(values, 0.25), rel=1e-12)
    assert (x["count"], x["unique"]) == (500, 500)
    assert (rows["empty"]["count"], rows["empty"]["missing"], rows["empty"]["unique"], rows["empty"]["median"]) == (0, 500, 0, None)


@pytest.mark.parametrize("max_rows", [10, 10**6])
def test_dedupe_of_a_hot_base(spark, max_rows):
    df = spark.createDataFrame([(1, "x", i) for i in range(100)] + [(1, "y", 200), (2, "x", 5)], "s int, base string, position int")
    names = {(r["s"], r["position"]): r["variable_name"] for r in headers.dedupe_names(df, ["s"], "base", "position", max_rows).collect()}
    assert names[(1, 0)] == "x" and names[(1, 1)] == "x_2" and names[(1, 99)] == "x_100"
    assert names[(1, 200)] == "y" and names[(2, 5)] == "x"


@pytest.mark.parametrize("max_rows", [60, 10**6])
def test_price_curves_by_definition(spark, max_rows):
    rng = np.random.default_rng(5)
    a = rng.integers(10, 40, 300)
    rows = [(1, float(x), float(x + 1 + i % 9), float(x + 12 + i % 4), float(x + 20 + i % 7)) for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "g int, too_cheap double, cheap double, expensive double, too_expensive double")
    checked = pricing.monotonicity(df, {k: k for k in pricing.fv.PRICE_KEYS}, ["g"])
    got = pricing.curves(pricing.cumulative_prices(checked, "g", 50, max_rows), "g").collect()
    m = np.array(rows)
    assert len(got) >= 50
    for r in got:
        p = r["price"]
        assert r["too_cheap_curve"] == pytest.approx((m[:, 1] >= p).mean())
        assert r["cheap_curve"] == pytest.approx((m[:, 2] >= p).mean())
        assert r["expensive_curve"] == pytest.approx((m[:, 3] <= p).mean())
        assert r["too_expensive_curve"] == pytest.approx((m[:, 4] <= p).mean())


def curve_table(spark, points):
    """(price, too_cheap, cheap, expensive, too_expensive) counts of ten answers."""
    return spark.createDataFrame([(1, float(p), a, b, c, d, 10) for p, a, b, c, d in points],
                                 "g int, price double, c_too_cheap bigint, c_cheap bigint, c_expensive bigint, "
                                 "c_too_expensive bigint, rows bigint").withColumns(
        {f"u_{k}": F.col(f"c_{k}") for k in pricing.fv.PRICE_KEYS})


def test_crossing_by_equality_block(spark):
    t = curve_table(spark, [(1, 9, 9, 0, 0), (2, 5, 9, 0, 5), (3, 5, 9, 0, 5), (4, 1, 9, 0, 6)])
    r = pricing.intersections(t, "g").first()
    assert (r["OPP"], r["OPP_gap"]) == (2.5, 0.0)


def test_crossing_by_sign_change(spark):
    t = curve_table(spark, [(1, 9, 9, 0, 0), (2, 6, 9, 0, 3), (4, 2, 9, 0, 5)])
    r = pricing.intersections(t, "g").first()
    assert r["OPP"] == pytest.approx(2 + 2 * 0.3 / 0.6)
    assert r["OPP_gap"] == 0.0


def test_crossing_by_smallest_gap(spark):
    t = curve_table(spark, [(1, 9, 9, 0, 0), (2, 6, 9, 0, 3), (3, 6, 9, 0, 3)])
    r = pricing.intersections(t, "g").first()
    assert (r["OPP"], r["OPP_gap"]) == (2.0, pytest.approx(0.3))


@pytest.mark.parametrize("max_rows", [10, 10**6])
def test_rows_with_null_keys_stay(spark, max_rows):
    rows = [("a" if i % 3 else None, i % 2 or None, float(i), 1) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, m long, v double, n bigint")
    got = ordered.running_totals(df, ["k", "m"], "v", ["n"], max_rows).collect()
    assert len(got) == 60
    for r in got:
        mine = [v for k, m, v, _ in rows if (k, m) == (r["k"], r["m"])]
        assert (r["cum_n"], r["tot_n"]) == (sum(v <= r["v"] for v in mine), len(mine))


def test_numbered_headers_keep_names_apart(spark):
    rows = [("s", 1, "x"), ("s", 2, "x"), ("s", 3, "x_2"), ("s", 4, "x"), ("t", 1, "x"), ("t", 2, "x"), (None, 1, "y_2"), (None, 2, "y"), (None, 3, "y")]
    df = spark.createDataFrame(rows, "survey string, position int, base string")
    got = {(r["survey"], r["position"]): r["variable_name"] for r in headers.dedupe_names(df, ["survey"], "base", "position").collect()}
    assert got == {("s", 1): "x", ("s", 2): "x_3", ("s", 3): "x_2", ("s", 4): "x_4", ("t", 1): "x", ("t", 2): "x_2",
                   (None, 1): "y_2", (None, 2): "y", (None, 3): "y_3"}


def test_names_of_many_numbered_headers_differ(spark):
    """Rank arithmetic over the taken numbers gives what counting on gives, and no name twice."""
    rng = random.Random(3)
    bases = [rng.choice(["x", "x", "x_2", "x_3", "x_5", "x_02", "x_2_2", "x_0", "x_1", "y", "y_9", "z\n_2", "z\n"]) for _ in range(200)]
    df = spark.createDataFrame([("s", i, b) for i, b in enumerate(bases)], "survey string, position int, base string")
    for max_rows in (1_000_000, 20):
        got = [r["variable_name"] for r in headers.dedupe_names(df, ["survey"], "base", "position", max_rows).orderBy("position").collect()]
        assert got == headers.unique_names(bases) and len(set(got)) == len(got)


def test_resolved_names(spark):
    names = spark.createDataFrame([("What?", 1), ("kept", 2), (None, 3), ("twice", 4)], "asked string, variable_name int")
    known = spark.createDataFrame([("What?", "what"), ("twice", "b"), ("twice", "a"), (None, "lost")], "original_question string, variable_name string")
    got = {r["variable_name"]: r["resolved"] for r in headers.resolve_table(names, "asked", known).collect()}
    assert got == {1: "what", 2: "kept", 3: None, 4: "a"}


def test_missing_variable_names_are_dropped_after_the_scan(spark, tmp_path):
    rows = [(1, "Purchase frequency of the household", "s", "en"), (2, "nothing of note", "s", "en"), (3, "Purchase frequency of the household", "s", "de"),
            (4, None, "s", "en"), (5, "Purchase frequency of the household", None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    resolved = contract.queries()["name_resolution"](spark, str(tmp_path))
    assert {r["doc_id"]: r["resolved"] for r in resolved.collect()} == {
        1: "purchase_frequency", 2: "nothing of note", 3: "s", 4: None, 5: "purchase_frequency"}
    plan = resolved._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "Contains(" in line]


def test_map_rows_without_a_variable_name_leave_the_name_as_it_is(spark):
    known = spark.createDataFrame([("a", None), ("b", None), ("b", "v"), (None, "w")], "original_question string, variable_name string")
    names = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    assert sorted((tuple(r) for r in headers.resolve_table(names, "name", known).collect()), key=str) == [("a", "a"), ("b", "v"), (None, None)]
