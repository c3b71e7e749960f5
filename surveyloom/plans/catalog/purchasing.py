"""Purchase questions and report facts."""

from pyspark.sql import functions as F

from ...functions import fixed_values as fv
from ...functions.scalars import round6
from ...operators import describe, facts, purchase, stat_tests
from ...operators.profile import level_frequencies, profile
from ..fixtures import table, view, with_views
from ..holding import hold
from . import ORACLES, QUERIES, query
from .cleaning import _SURVEY, _class_sql
from .describing import _levels_sql, bins_sql
from .sql import contains_any, r6, union_all


@query("purchase_vars", f"""
with c as ({with_views(_class_sql('survey', _SURVEY), 'survey')})
select variable, replace(variable, '_', ' ') as question from c where not id_like and "distinct" >= 2
  and {contains_any("(variable || ' ' || replace(variable, '_', ' '))", fv.PURCHASE_QUESTION_HINTS)}""")
def purchase_vars(spark, d):
    survey = view(spark, d, "survey")
    variable_map = spark.createDataFrame([(c.replace("_", " "), c) for c in survey.columns], "original_question string, variable_name string")
    found = purchase.purchase_questions(variable_map, profile(survey))
    return spark.createDataFrame(found, "variable string, question string")


# One language with the separator " - ", the others with whatever dashes the text holds.
_QUESTION = "case when lang = 'en' then concat(source, ' - ', text) else text end"
_EDGE = "'^[\\s\\x{3000}]+|[\\s\\x{3000}]+$'"


def _split_sql() -> str:
    cases_stem, cases_option = [], []
    for sep in fv.STEM_SEPARATORS:
        left = f"regexp_replace(regexp_extract(t, '(?s)^(.*){sep}(.*)$', 1), {_EDGE}, '', 'g')"
        right = f"regexp_replace(regexp_extract(t, '(?s)^(.*){sep}(.*)$', 2), {_EDGE}, '', 'g')"
        hit = f"contains(t, '{sep}') and {left} <> '' and {right} <> ''"
        cases_stem.append(f"when {hit} then {left}")
        cases_option.append(f"when {hit} then {right}")
    return (f"select doc_id, case {' '.join(cases_stem)} else t end as stem, case {' '.join(cases_option)} else '' end as option "
            f"from (select doc_id, regexp_replace({_QUESTION}, {_EDGE}, '', 'g') as t from documents)")


@query("stem_split", _split_sql())
def stem_split(spark, d):
    stem, option = purchase.split_stem(F.expr(_QUESTION))
    return table(spark, d, "documents").select("doc_id", stem.alias("stem"), option.alias("option"))


_OPTIONS = [("outcome_returned", "returned"), ("outcome_accepted", "accepted"), ("outcome_none", "none")]


@query("multi_select", with_views("with c as (" + union_all(
    f"select {i} as level_order, '{o}' as level, '{v}' as source_variable, cast(sum({v}) as bigint) as count, "
    f"count(coalesce({', '.join(v for v, _ in _OPTIONS)})) as respondent_n from multi" for i, (v, o) in enumerate(_OPTIONS, 1)) + f""")
select 'outcome' as variable, 'Which outcomes occurred' as original_question, level_order, level, count,
       {r6('count / (select sum(count)::double from c)')} as percent, source_variable, respondent_n,
       {r6('count / respondent_n::double')} as respondent_percent from c where count > 0""", "multi"))
def multi_select(spark, d):
    multi = hold(view(spark, d, "multi"))
    variable_map = spark.createDataFrame(
        [("respondent", "respondent")] + [(f"Which outcomes occurred - {o}", v) for v, o in _OPTIONS],
        "original_question string, variable_name string")
    stats = profile(multi)
    t = purchase.question_distributions(multi, variable_map, [(v, q) for q, v in
                                        [(r["original_question"], r["variable_name"]) for r in variable_map.collect()][1:]], stats)
    return t.where(F.col("chart_type") == "multi_select_group").select(
        "variable", "original_question", "level_order", "level", "count", round6(F.col("percent")).alias("percent"),
        "source_variable", "respondent_n", round6(F.col("respondent_percent")).alias("respondent_percent"))


_QUESTIONS = ["purchase_intention", "market_segment", "product_quality_3"]
_LEVELS = _levels_sql("survey", _QUESTIONS)


@query("purchase_single", with_views(
    f"select variable, level_order, level, count, percent from ({_LEVELS}) union all "
    f"select variable, bin, cast(bin_lo as varchar) || ' to ' || cast(bin_hi as varchar), count, percent from ({bins_sql('survey', ['monthly_spend'], 6)})",
    "survey"))
def purchase_single(spark, d):
    survey = view(spark, d, "survey")
    names = [*_QUESTIONS, "monthly_spend"]
    t = purchase.single_questions(survey, [(v, v) for v in names], profile(survey))
    bins = describe.quantile_bins(survey, ["monthly_spend"], 6).select(
        "variable", F.col("bin").alias("level_order"),
        F.concat(round6(F.col("bin_lo")).cast("string"), F.lit(" to "), round6(F.col("bin_hi")).cast("string")).alias("text"))
    # Interval ends are compared as rounded numbers.
    return t.join(bins, ["variable", "level_order"], "left").select(
        "variable", "level_order", F.coalesce("text", "level").alias("level"), "count", round6(F.col("percent")).alias("percent"))


def _distribution(spark, d):
    lineitem = table(spark, d, "lineitem")
    return describe.top_levels_per_key(
        level_frequencies(lineitem, ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount"]), ["variable"])


_DIST = """with long as (select unnest(['l_returnflag', 'l_linestatus', 'l_linenumber', 'l_discount']) as variable,
    unnest([l_returnflag, l_linestatus, cast(l_linenumber as varchar), cast(l_discount as varchar)]) as level from lineitem),
c as (select variable, level, count(*)::double as n from long group by all),
s as (select *, n / sum(n) over (partition by variable) as share, row_number() over (partition by variable order by n desc, level) as level_order from c)"""


@query("pie_stops", f"""{_DIST}, e as (select *, sum(share * 100) over (partition by variable order by level_order) as stop from s)
select variable, cast(level_order as int) as level_order, level, {r6('stop - share * 100')} as start, {r6('stop')} as "end" from e""")
def pie_stops(spark, d):
    t = purchase.pie_stops(_distribution(spark, d))
    return t.select("variable", "level_order", "level", round6(F.col("start")).alias("start"), round6(F.col("end")).alias("end"))


@query("top_levels", f"""{_DIST} select variable, cast(level_order as int) as place, level, {r6('share')} as percent from s where level_order <= 3""")
def top_levels(spark, d):
    return purchase.top_levels(_distribution(spark, d)).withColumn("percent", round6(F.col("percent")))


@query("report_facts", f"""
with i as ({ORACLES.get('chi_square_pairs', 'select 1')}),
r as ({ORACLES.get('ranking_top3', 'select 1')}),
n as (select count(*)::double as n from lineitem),
top as (select *, row_number() over (order by abs(effect_size) desc, variable_a || ' vs ' || variable_b) as place from i)
select 'sample' as section, 'raw_rows' as fact, 1 as place, '' as name, n as value from n
union all select 'sample', 'valid_rows', 1, '', n from n union all select 'sample', 'valid_rate', 1, '', 1.0 from n
union all select 'independence', 'results', 1, '', count(*)::double from i
union all select 'independence', 'significant', 1, '', count(*)::double from i where approx_p < 0.05
union all select 'segment_tests', 'results', 1, '', 0.0 union all select 'segment_tests', 'significant', 1, '', 0.0
union all select 'independence', 'strongest', cast(place as int), variable_a || ' vs ' || variable_b, effect_size from top where place <= 3
union all select 'ranking', 'top_brand', place, dimension || ':' || brand, mean_rank from r""")
def report_facts(spark, d):
    lineitem = table(spark, d, "lineitem").drop("l_orderkey", "l_partkey", "l_suppkey")
    stats = profile(lineitem)
    tests = hold(stat_tests.chi_square_tests(lineitem, stat_tests.categorical_pairs(stats), stats=stats))
    rows = stats["l_quantity"].rows
    t = facts.report_facts({"independence_tests": tests, "ranking_summary": describe.ranking_summary(view(spark, d, "ranks"))},
                           rows, rows, lineitem)
    return t.withColumn("value", round6(F.col("value")))


# The tables of the models are those of their own queries, in both engines.
_MODEL_TABLES = ("construct_semantic", "ols_regression", "mediation_bootstrap", "moderation", "psm_summary", "conjoint_importance", "segment_profile", "persona_label")


@query("report_facts_models", "with " + ", ".join(f"{name}_t as ({ORACLES.get(name, 'select 1')})" for name in _MODEL_TABLES) + f""",
sizes as (select segment, any_value(size) as size from segment_profile_t group by segment),
shares as (select persona, size / sum(size) over () as share from sizes join persona_label_t using (segment)),
terms as (select term, standardized_beta as b, row_number() over (order by abs(standardized_beta) desc, term) as place from ols_regression_t where term <> 'intercept'),
pairs as (select predictor || ' x ' || moderator as term, standardized_beta as b from moderation_t),
n as (select count(*)::double as n from customer)
select 'sample' as section, 'raw_rows' as fact, 1 as place, '' as name, n as value from n
union all select 'sample', 'valid_rows', 1, '', n from n union all select 'sample', 'valid_rate', 1, '', 1.0 from n
union all select 'constructs', 'results', 1, '', count(*)::double from construct_semantic_t
union all select 'mediation', 'results', 1, '', count(*)::double from mediation_bootstrap_t
union all select 'moderation', 'results', 1, '', count(*)::double from moderation_t
union all select 'mediation', 'supported', 1, '', cast(count(*) filter (supported) as double) from mediation_bootstrap_t
union all select 'regression', 'strongest', cast(place as int), term, b from terms where place <= 5
union all select 'moderation', 'strongest', cast(place as int), term, b from (select *, row_number() over (order by abs(b) desc, term) as place from pairs) where place <= 5
union all select 'segments', 'largest', cast(place as int), persona, {r6('share')} from (select *, row_number() over (order by share desc, persona) as place from shares) where place <= 2
union all select 'conjoint', 'importance', cast(row_number() over (order by relative_importance desc, attribute) as int), attribute, relative_importance from conjoint_importance_t
union all select 'pricing', 'metric', 1, metric, value from psm_summary_t""" if set(_MODEL_TABLES) <= set(ORACLES) else None)
def report_facts_models(spark, d):
    t = {name: hold(QUERIES[name](spark, d)) for name in _MODEL_TABLES}
    sizes = t["segment_profile"].groupBy("segment").agg(F.first("size").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0]
    shares = sizes.join(t["persona_label"], "segment").select("persona", (F.col("size") / total).alias("share"))
    survey = view(spark, d, "survey")
    rows = survey.count()
    return facts.report_facts({
        "construct_summary": t["construct_semantic"], "regression_coefficients": t["ols_regression"], "mediation": t["mediation_bootstrap"],
        "moderation": t["moderation"].withColumn("term", F.concat_ws(" x ", "predictor", "moderator")), "segment_profiles": shares,
        "conjoint_importance": t["conjoint_importance"], "psm_summary": t["psm_summary"]}, rows, rows, survey).withColumn("value", round6(F.col("value")))
