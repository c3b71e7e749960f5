"""The whole analysis on a questionnaire made of the given tables: the survey, price and rank views joined by respondent."""

import pytest
from pyspark.sql import functions as F

from surveyloom.plans import fixtures
from surveyloom.plans.analysis import SurveyConfig, analyze, run
from surveyloom.sources import tables

SURVEY = {
    "respondent": "respondent", "market_segment": "市场分类", "income": "Household income", "monthly_spend": "Monthly spend",
    "product_quality": "Quality of the fabric", "product_quality_2": "Quality of the seams", "product_quality_3": "Durable after washing",
    "perceived_value": "Perceived value today", "perceived_value_2": "Perceived value in a year",
    "brand_trust": "Trust in the maker", "brand_trust_2": "Credibility of its promises",
    "purchase_intention": "Likely to recommend the coat", "purchase_intention_2": "Willingness to wear it again",
}
PRICES = {"too_cheap": "大衣什么价太便宜", "cheap": "大衣什么价比较便宜", "expensive": "大衣什么价比较贵", "too_expensive": "大衣什么价太贵"}


def questionnaire(spark, data_dir):
    """Texts, as a CSV export has them; one row per customer that is also a part number."""
    survey, psm, ranks = (fixtures.view(spark, data_dir, v) for v in ("survey", "psm", "ranks"))
    answers = survey.select(*SURVEY).join(psm.select("respondent", *PRICES), "respondent").join(
        ranks.select("respondent", "health_rank_alpha", "health_rank_beta"), "respondent")
    marks = {"Buy channel - market": 3, "Buy channel - web": 2}
    answers = answers.withColumns({m: F.when(F.col("respondent") % n == 0, "yes").otherwise("no") for m, n in marks.items()})
    names = {**SURVEY, **PRICES}
    return answers.orderBy("respondent").select(*[F.col(c).cast("string").alias(names.get(c, c)) for c in answers.columns]).coalesce(1)


@pytest.fixture(scope="module")
def source(spark, data_dir):
    return questionnaire(spark, data_dir).persist()


@pytest.fixture(scope="module")
def results(source):
    return analyze(source, draws=60, restarts=2)


EXPECTED = {
    "variable_map", "cleaned_data", "construct_scores", "construct_summary", "descriptives", "categorical_distributions",
    "correlations", "randomness_tests", "independence_tests", "regression_coefficients", "mediation", "moderation",
    "conjoint_utilities", "conjoint_importance", "psm_monotonicity", "psm_summary", "psm_curves", "psm_segment_monotonicity",
    "psm_segment_summary", "psm_segment_curves", "segment_assignments", "segment_profiles", "persona_profile_details",
    "consumer_persona_summary", "purchase_question_distributions", "ranking_summary",
}


def test_all_tables_are_there(results):
    assert set(results) >= EXPECTED


def test_main_results(results, source):
    n = source.count()
    constructs = {r["construct_base"]: r["reliability"] for r in results["construct_summary"].collect()}
    assert constructs["product_quality"] == "good"
    terms = {r["term"]: r for r in results["regression_coefficients"].collect()}
    assert terms["product_quality_score"]["standardized_beta"] > 0
    segments = results["segment_profiles"].collect()
    assert 2 <= len(segments) <= 6 and sum(r["size"] for r in segments) == n
    assert [r["segment"] for r in sorted(segments, key=lambda r: -r["size"])][0] == 1
    metrics = {r["metric"]: r["value"] for r in results["psm_summary"].collect()}
    assert metrics["valid_raw_rows"] == source.where("respondent % 23 <> 0").count()
    assert metrics["PMC_lower_acceptable_price"] < metrics["PME_upper_acceptable_price"]


def test_row_numbers_follow_the_file(results, source):
    numbers = sorted(r["row_number"] for r in results["segment_assignments"].collect())
    assert numbers == list(range(1, source.count() + 1))


def test_multi_select_and_ranks(results, source):
    t = {r["level"]: r["count"] for r in results["purchase_question_distributions"].where("chart_type = 'multi_select_group'").collect()}
    assert t == {"market": source.count() // 3, "web": source.count() // 2}
    assert results["ranking_summary"].count() == 2


def test_facts_are_complete(results):
    facts = {(r["section"], r["fact"]) for r in results["report_facts"].collect()}
    assert {("sample", "valid_rate"), ("independence", "strongest"), ("regression", "strongest"), ("segments", "largest"), ("regression", "r2"),
            ("regression", "adj_r2"), ("regression", "n"), ("pricing", "metric"), ("ranking", "top_brand"), ("segment_tests", "significant")} <= facts


def test_segments_are_a_projection(results):
    """No shuffle by the row key: assignments come from the cleaned table without a join."""
    plan = results["segment_assignments"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_release_keeps_the_results_computable(source):
    tables_ = analyze(source, draws=20, restarts=1)
    assert tables_.held
    tables_.release()
    assert not tables_.held and tables_["descriptives"].count() > 0


def test_sequence_tests_follow_the_file_or_a_given_column(spark):
    """A drift in the file is not random, whatever the respondent ids look like; sorted by the shuffled column it is."""
    rows = [(f"id{(i * 7919) % 300:03d}", (i * 7919) % 300, 1 if i < 150 else 5) for i in range(300)]
    raw = spark.createDataFrame(rows, "respondent string, moment int, score int").coalesce(1)
    by_file = analyze(raw, row_id="respondent")["randomness_tests"].where("variable = 'score'").first()
    assert by_file["runs"] == 2
    by_moment = analyze(raw, row_id="respondent", order_by="moment")["randomness_tests"].where("variable = 'score'").first()
    assert by_moment["runs"] > 50


def test_configuration_and_sink(spark, source, tmp_path):
    config = SurveyConfig.from_dict({
        "rename": {"Trust in the maker": "trust item"}, "segment_k": 3, "segment_names": {"1": "主力"}, "unused": 1,
        "constructs": {"Cloth Quality": ["Quality of the fabric", "Quality of the seams"]}, "outcome": "Likely to recommend the coat",
        "reverse_items": ["Perceived value in a year"], "independence_pairs": [["市场分类", "Household income"]],
        "metadata": {"raw_sample": 205, "valid_sample": 196}})
    path = str(tmp_path / "in.csv")
    tables.write_csv(source, path)
    written = run(tables.read_survey(spark, path), str(tmp_path / "out"), config, row_id="respondent", format="parquet")
    assert {"psm_segment_summary", "variable_map", "cleaned_data"} <= set(written)
    out = {n: spark.read.parquet(str(tmp_path / "out" / n)) for n in written}
    assert "trust_item" in out["cleaned_data"].columns and "cloth_quality" in out["cleaned_data"].columns
    assert "主力" in {r["persona"] for r in out["segment_profiles"].collect()}
    assert "respondent" in out["segment_assignments"].columns
    pairs = {(r["variable_a"], r["variable_b"]) for r in out["independence_tests"].where("method = 'chi_square_independence'").collect()}
    assert len(pairs) == 1 and "income" in next(iter(pairs))
    rate = out["report_facts"].where("fact = 'valid_rate'").first()["value"]
    assert rate == pytest.approx(196 / 205)


def test_tasks_find_the_package_from_elsewhere(tmp_path):
    """A driver in another folder, without the registration of the entry module: Python tasks still run."""
    import subprocess
    import sys
    from pathlib import Path

    code = ("from surveyloom.plans.session import local_session\n"
            "from surveyloom.operators.moments import correlations\n"
            "spark = local_session(2)\n"
            "import sys; sys.path.pop(0)\n"
            "df = spark.createDataFrame([(float(i), float(i * i % 7)) for i in range(50)], 'a double, b double')\n"
            "print('rows', correlations(df, ['a', 'b']).count())\n")
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {root!r})\n" + code], cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert "rows 1" in done.stdout, done.stderr[-2000:]
