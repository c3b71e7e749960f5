import pytest
from pyspark.sql import functions as F

from surveyloom.functions.scalars import matches_hints, normalized_answer, normalized_number
from surveyloom.operators import clean, headers, profile, purchase
from surveyloom.sources import tables

DEMO_HEADERS = {
    "受访者ID": "id", "我认为这个产品质量很好": "product_quality", "这个产品的做工可靠": "product_quality_2",
    "这个产品品质让我放心": "product_quality_3", "这个产品值得这个价格": "price_value", "这个产品性价比高": "price_value_2",
    "我信任这个品牌": "brand_trust", "这个品牌让我感到可靠": "product_quality_4", "我对这个品类很感兴趣": "category_involvement",
    "我经常关注类似产品": "category_involvement_2", "我了解这个品牌": "brand_awareness", "我担心这个产品不适合我": "perceived_risk",
    "过去一个月购买类似产品的频率": "purchase_frequency", "常用购买渠道": "purchase_channel", "月均消费金额": "monthly_spend",
    "主要使用场景": "usage_scene", "我愿意购买这个产品": "purchase_intention", "我会考虑把这个产品推荐给朋友": "purchase_intention_2",
    "年龄": "age", "收入": "income", "性别": "gender",
}


def test_headers_of_a_questionnaire(spark):
    df = spark.createDataFrame([tuple(range(len(DEMO_HEADERS)))], list(DEMO_HEADERS))
    renamed, variable_map, mapping = headers.rename_columns(df)
    assert mapping == DEMO_HEADERS
    assert renamed.columns == list(DEMO_HEADERS.values())
    assert variable_map.count() == len(DEMO_HEADERS)


@pytest.mark.parametrize("header, position, name", [
    ("Q7 how often", 3, "q07"), ("第 12 Brand", 1, "q12"), ("", 4, "q04"), ("题目", 5, "q05"), ("Unnamed: 3", 6, "q06"),
    ("2nd try", 1, "v_2nd_try"), ("Crème brûlée", 1, "creme_brulee"), ("x", 9, "q09"), ("a" * 80, 1, "a" * 64), ("ＡＢＣ", 2, "abc"),
])
def test_fallback_names(spark, header, position, name):
    row = headers.with_base_names(spark.createDataFrame([(header, position)], "h string, p int"), "h", "p").first()
    assert row["base"] == name


def test_suffixes_stay_unique(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["alpha", "Alpha", "alpha 2"])
    names = headers.rename_columns(df)[0].columns
    assert names == ["alpha", "alpha_3", "alpha_2"]  # a number whose name is a header's own is left out
    renamed = headers.rename_columns(df, {"Alpha": "Brand Love"})[0].columns
    assert renamed == ["alpha", "brand_love", "alpha_2"]


@pytest.mark.parametrize("raw, number, text", [
    (None, None, None), (" ", None, None), ("N/A", None, None), ("不 清 楚", None, None), ("　同意　", 4.0, "4.0"),
    ("很 可能 会", 4.0, "4.0"), ("YES", 1.0, "1.0"), ("45%", 0.45, "0.45"), ("-3.5%", -0.035, "-0.035"), ("18-24岁", 18.0, "18.0"),
    ("2024-05-01", 2024.0, "2024.0"), ("1,200", 1.0, "1.0"), ("非常满意 5", 5.0, "5.0"), ("surely more than 7", None, "surely more than 7"),
    ("１２", 12.0, "12.0"), ("1234567890123", 1234567890123.0, "1234567890123"), ("word", None, "word"), ("1d", 1.0, "1.0"),
    ("five", None, "five"),
])
def test_answers(spark, raw, number, text):
    row = spark.createDataFrame([(raw,)], "a string").select(normalized_number(F.col("a")), normalized_answer(F.col("a"))).first()
    assert row[1] == text
    assert row[0] == (pytest.approx(number) if number is not None else None)


def test_types_follow_the_share_of_all_rows(spark):
    rows = [("1", "1", True, 1.5)] * 7 + [(None, "x", False, float("nan"))] * 3 + [("y", "z", None, None)] * 0
    df = spark.createDataFrame(rows, "a string, b string, c boolean, d double")
    t = clean.clean_values(df)
    assert [f.dataType.simpleString() for f in t.schema] == ["double", "double", "double", "double"]
    assert t.where(F.col("d").isNotNull()).count() == 7
    mixed = clean.clean_values(spark.createDataFrame([("1",)] * 6 + [("no idea",)] * 4, "a string"))
    assert {r[0] for r in mixed.collect()} == {"1.0", "no idea"}


def test_columns_without_spread(spark):
    df = spark.createDataFrame([(5, None, 1.0), (5, None, 2.0)], "same int, empty double, x double")
    z = clean.zscore(df, ["same", "empty", "x"]).collect()
    assert [r["same"] for r in z] == [None, None] and [r["empty"] for r in z] == [None, None]
    assert sorted(r["x"] for r in z) == [-1.0, 1.0]
    assert clean.reverse_code(df, ["same", "missing"]).collect() == df.collect()
    assert clean.impute_and_standardize(df, ["same", "empty", "x"], [])[1] == ["x"]


def test_missing_level_is_all_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "g string")
    rows = clean.dummy_encode(df, "g", True, ["g"]).collect()
    assert {(r["g"], r["g_b"], r["g_c"]) for r in rows} == {("b", 1, 0), ("a", 0, 0), (None, 0, 0), ("c", 0, 1)}


def test_profile_of_odd_tables(spark):
    assert profile.profile(spark.createDataFrame([], "t timestamp")) == {}
    empty = profile.profile(spark.createDataFrame([], "a int, b string"))
    assert empty["a"].count == 0 and not profile.is_categorical(empty["b"]) and not profile.is_likert_item(empty["a"])


@pytest.mark.parametrize("name, hints, hit", [
    ("usage", ("age",), False), ("age_group", ("age",), True), ("home_city_tier", ("city_tier",), True), ("city_tier", ("city_tier",), True),
    ("brandlove", ("brand",), True), ("packages", ("age",), False), ("a.risk", ("risk",), True)])
def test_hints_agree(spark, name, hints, hit):
    assert profile.variable_matches(name, hints) is hit
    assert spark.createDataFrame([(name,)], "n string").select(matches_hints(F.col("n"), hints)).first()[0] is hit


@pytest.mark.parametrize("question, stem, option", [
    ("Where - online", "Where", "online"), ("A - B - C", "A - B", "C"), ("哪里购买—网店", "哪里购买", "网店"), ("x-y", "x", "y"),
    ("plain", "plain", ""), ("line one\nx - opt", "line one\nx", "opt"), ("a-b - ", "a-b -", ""), (" - lead", "- lead", "")])
def test_stems(spark, question, stem, option):
    s, o = purchase.split_stem(F.col("q"))
    assert tuple(spark.createDataFrame([(question,)], "q string").select(s, o).first()) == (stem, option)


def test_csv_with_bom_and_line_breaks(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('﻿"Q1\nhow?",b\n"a ""quoted"", cell\nnext",  2\n,x\n', encoding="utf-8")
    df = tables.read_survey(spark, str(path), multi_line=True)
    assert df.columns == ["Q1\nhow?", "b"]
    assert [tuple(r) for r in df.collect()] == [('a "quoted", cell\nnext', "  2"), (None, "x")]


def test_empty_tables_are_not_written(spark, tmp_path):
    some, none = spark.range(2), spark.range(0)
    assert tables.write_tables({"a": some, "b": none, "variable_map": none}, str(tmp_path), "csv") == ["a", "variable_map"]
