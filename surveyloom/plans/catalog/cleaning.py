"""Sources, headers and answer cleaning."""

from pyspark.sql import functions as F

from ...functions import fixed_values as fv
from ...functions.scalars import matches_hints, normalized_answer, normalized_number, round6
from ...operators import clean, describe, headers, profile
from ...sources import tables
from ..fixtures import table, view, with_views
from ..holding import hold, shared_folder
from . import query
from .sql import contains_any, r6, union_all


@query("src_csv_roundtrip", "select doc_id, text, lang, source, n_chars from documents")
def src_csv_roundtrip(spark, d):
    path = shared_folder(spark)
    tables.write_csv(table(spark, d, "documents"), path)
    t = tables.read_csv(spark, path)
    return t.select(F.col("doc_id").cast("bigint"), "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"))


@query("sink_tables", with_views("""
select 'cleaned_data' as table_name, count(*) as n_rows from survey
union all select 'categorical_distributions', count(distinct market_segment) from survey""", "survey"))
def sink_tables(spark, d):
    path = shared_folder(spark)
    survey = view(spark, d, "survey")
    results = {
        "cleaned_data": survey,
        "categorical_distributions": describe.categorical_distributions(survey, ["market_segment"]),
        "ranking_summary": describe.ranking_summary(survey),
    }
    written = tables.write_tables(results, path)
    parts = [tables.read_parquet(spark, f"{path}/{name}").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows") for name in written]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SEMANTIC_SQL = "case " + " ".join(
    f"when {contains_any('lower(text)', needles)} then '{name}'" for name, needles in fv.SEMANTIC_PATTERNS) + " end"


@query("header_semantic", f"select doc_id, {_SEMANTIC_SQL} as variable_name from documents")
def header_semantic(spark, d):
    return headers.with_semantic_names(table(spark, d, "documents"), "text", "variable_name").select("doc_id", "variable_name")


# A third of the headers carry a question number.
_NUMBERED = "case when lang = 'en' then text else concat('Q ', cast(doc_id % 200 as varchar(10)), '. ', text) end"


@query("header_slug", f"""
with h as (select doc_id, {_NUMBERED} as header, printf('q%02d', doc_id + 1) as fallback from documents),
s as (select *, regexp_extract(header, '(?i)\\b(q|题|第)\\s*0*(\\d{{1,3}})\\b', 2) as number,
             lower(regexp_replace(strip_accents(header), '[^0-9a-zA-Z]+', '_', 'g')) as raw from h),
t as (select *, regexp_replace(regexp_replace(raw, '_+', '_', 'g'), '^_+|_+$', '', 'g') as slug from s)
select doc_id, case
  when number <> '' then printf('q%02d', cast(number as bigint))
  when length(slug) < 2 or slug like 'unnamed%' then fallback
  else regexp_replace(substr(case when regexp_matches(slug, '^[0-9]') then 'v_' || slug else slug end, 1, 64), '^_+|_+$', '', 'g')
end as variable_name from t""")
def header_slug(spark, d):
    h = table(spark, d, "documents").select("doc_id", F.expr(_NUMBERED).alias("header"), (F.col("doc_id") + 1).alias("position"))
    slugs = headers.with_slugs(h, "header", headers.position_name(F.col("position")), "slug")
    return slugs.select("doc_id", F.coalesce(headers.question_number_name(F.col("header")), "slug").alias("variable_name"))


@query("header_dedupe", f"""
with h as (select doc_id, source, coalesce({_SEMANTIC_SQL}, lang) as base from documents),
r as (select *, row_number() over (partition by source, base order by doc_id) as rn from h)
select doc_id, source, case when rn = 1 then base else base || '_' || cast(rn as varchar) end as variable_name from r""")
def header_dedupe(spark, d):
    h = headers.with_semantic_names(table(spark, d, "documents"), "text", "base").select(
        "doc_id", "source", F.coalesce("base", "lang").alias("base"))
    return headers.dedupe_names(h, ["source"], "base", "doc_id").select("doc_id", "source", "variable_name")


@query("name_resolution", f"""
with m as (select text, min(v) as v from (select text, {_SEMANTIC_SQL} as v from documents) where v is not null group by text),
asked as (select doc_id, case when doc_id % 3 = 0 then source else text end as name from documents)
select doc_id, coalesce(v, name) as resolved from asked left join m on name = text""")
def name_resolution(spark, d):
    """Configured names, questions and others, to variable names."""
    docs = table(spark, d, "documents")
    known = headers.with_semantic_names(docs, "text", "variable_name").select(
        F.col("text").alias("original_question"), "variable_name")
    asked = docs.select("doc_id", F.expr("case when doc_id % 3 = 0 then source else text end").alias("name"))
    return headers.resolve_table(asked, "name", known).select("doc_id", "resolved")


_LIKERT_SQL = "case " + " ".join(f"when compact = '{k}' then {v}.0" for k, v in fv.LIKERT_MAP.items()) + " end"
_MISSING_SQL = "compact in (" + ", ".join(f"'{t}'" for t in fv.MISSING_TOKENS) + ")"


def _number_sql(source: str, column: str, keys: str = "respondent") -> str:
    """Common table expressions ending in ``parsed(keys, text, missing, number)``."""
    return f"""
stripped as (select {keys}, regexp_replace({column}, '^[\\s\\x{{3000}}]+|[\\s\\x{{3000}}]+$', '', 'g') as text from {source}),
compacted as (select *, lower(regexp_replace(text, '[\\s\\x{{3000}}]+', '', 'g')) as compact from stripped),
parsed as (select {keys}, text, {_MISSING_SQL} as missing, case
  when text is null or {_MISSING_SQL} then null
  when {_LIKERT_SQL} is not null then cast({_LIKERT_SQL} as double)
  when regexp_matches(text, '^[-+]?\\d+(\\.\\d+)?%$') then cast(replace(text, '%', '') as double) / 100
  when regexp_matches(text, '^[-+]?\\d+(\\.\\d+)?') and length(text) <= 12
    then cast(regexp_extract(text, '^[-+]?\\d+(\\.\\d+)?') as double)
  when regexp_matches(text, '[-+]?\\d+(\\.\\d+)?$') and regexp_matches(text, '非常|同意|满意|可能|分')
    then cast(regexp_extract(text, '[-+]?\\d+(\\.\\d+)?$') as double)
  else try_cast(text as double) end as number, length(text) > 12 and regexp_matches(text, '^[-+0-9.eE]+$') as long_digits from compacted)"""


@query("normalize_scalar", with_views(
    "with " + _number_sql("messy", "answer") + """
select respondent, number as answer_number,
       case when missing then null when long_digits then text else coalesce(cast(number as varchar), text) end as answer_text from parsed""", "messy"))
def normalize_scalar(spark, d):
    t = view(spark, d, "messy")
    return t.select("respondent", normalized_number(F.col("answer")).alias("answer_number"),
                    normalized_answer(F.col("answer")).alias("answer_text"))


@query("infer_types", with_views(
    "with long as (" + union_all(
        f"select respondent, '{c}' as variable, {c} as v from messy" for c in ("answer", "mostly_numeric", "mixed_text"))
    + ")," + _number_sql("long", "v", "respondent, variable") + """
select variable, round(avg(case when number is null then 0.0 else 1.0 end), 6) + 0.0 as numeric_share,
       case when avg(case when number is null then 0.0 else 1.0 end) >= 0.7 then 'numeric' else 'text' end as inferred_type
from parsed group by variable""", "messy"))
def infer_types(spark, d):
    t = clean.numeric_shares(view(spark, d, "messy"))
    return t.select("variable", round6(F.col("numeric_share")).alias("numeric_share"), "inferred_type")


@query("reverse_code", with_views("""
select respondent,
       cast((select max(product_quality_3) + min(product_quality_3) from survey) - product_quality_3 as double) as product_quality_3,
       (select max(monthly_spend) + min(monthly_spend) from survey) - monthly_spend as monthly_spend
from survey""", "survey"))
def reverse_code(spark, d):
    t = clean.reverse_code(view(spark, d, "survey"), ["product_quality_3", "monthly_spend", "market_segment"])
    return t.select("respondent", "product_quality_3", "monthly_spend")


@query("zscore", with_views("""
with s as (select avg(monthly_spend) m1, stddev_pop(monthly_spend) s1, avg(product_quality_3) m2,
                  stddev_pop(product_quality_3) s2 from survey)
select respondent, round((monthly_spend - m1) / s1, 6) + 0.0 as monthly_spend,
       round((product_quality_3 - m2) / s2, 6) + 0.0 as product_quality_3 from survey, s""", "survey"))
def zscore(spark, d):
    columns = ["monthly_spend", "product_quality_3"]
    t = clean.zscore(view(spark, d, "survey"), columns)
    return t.select("respondent", *[round6(F.col(c)).alias(c) for c in columns])


@query("dummy_encode", with_views("select respondent, " + ", ".join(
    f"case when market_segment = '{s}' then 1.0 else 0.0 end::double as \"market_segment_{s}\""
    for s in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " from survey", "survey"))
def dummy_encode(spark, d):
    return clean.dummy_encode(view(spark, d, "survey"), "market_segment", True, ["respondent"])


@query("impute_zscore", with_views("""
with m as (select median(product_quality_3) as med from survey),
f as (select respondent, coalesce(product_quality_3, med) as a, monthly_spend as b from survey, m),
s as (select avg(a) ma, stddev_pop(a) sa, avg(b) mb, stddev_pop(b) sb from f)
select respondent, round((a - ma) / sa, 6) + 0.0 as product_quality_3, round((b - mb) / sb, 6) + 0.0 as monthly_spend
from f, s""", "survey"))
def impute_zscore(spark, d):
    t, kept = clean.impute_and_standardize(view(spark, d, "survey"), ["product_quality_3", "monthly_spend"], ["respondent"])
    return t.select("respondent", *[round6(F.col(c)).alias(c) for c in kept])


_LINEITEM = {"l_orderkey": 1, "l_partkey": 1, "l_suppkey": 1, "l_linenumber": 1, "l_quantity": 1, "l_extendedprice": 1,
             "l_discount": 1, "l_tax": 1, "l_returnflag": 0, "l_linestatus": 0}


@query("column_profile", union_all(
    f"select '{c}' as variable, count({c}) as count, count(*) - count({c}) as missing, count(distinct {c}) as \"distinct\", "
    + (f"round(cast(min({c}) as double), 6) as min, round(cast(max({c}) as double), 6) as max" if numeric
       else "cast(null as double) as min, cast(null as double) as max") + " from lineitem"
    for c, numeric in _LINEITEM.items()))
def column_profile(spark, d):
    return profile.column_profile(table(spark, d, "lineitem"))


def _class_sql(source: str, columns: dict[str, int]) -> str:
    long = union_all(
        f"select '{c}' as variable, {'true' if numeric else 'false'} as numeric, count(*) as n_rows, count({c}) as n, "
        f"count(distinct {c}) as d, " + (f"cast(min({c}) as double) as lo, cast(max({c}) as double) as hi" if numeric
                                        else "cast(null as double) as lo, cast(null as double) as hi")
        + f" from {source}" for c, numeric in columns.items())
    demographic = " or ".join(f"starts_with(variable, '{h}')" for h in fv.BASIC_HINTS)
    return f"""with p as ({long}),
q as (select *, {contains_any('variable', fv.ID_TOKENS)} or d > greatest(20, n_rows * 0.75) as id_like from p)
select variable, numeric, d as "distinct", id_like,
       coalesce(numeric and not id_like and not ({demographic}) and n >= 8 and d between 2 and 11 and lo >= 0 and hi <= 10, false) as likert_item,
       n > 0 and (not numeric or d between 2 and 12) as categorical from q"""


_SURVEY = {"respondent": 1, "market_segment": 0, "segment": 1, "income": 1, "monthly_spend": 1, "product_quality": 1,
           "product_quality_2": 1, "product_quality_3": 1, "perceived_value": 1, "perceived_value_2": 1, "brand_trust": 1,
           "brand_trust_2": 1, "purchase_intention": 1, "purchase_intention_2": 1}


@query("id_like", f"select variable, id_like from ({_class_sql('lineitem', _LINEITEM)})")
def id_like(spark, d):
    return profile.classification(table(spark, d, "lineitem")).select("variable", "id_like")


@query("likert_items", f"select variable from ({with_views(_class_sql('survey', _SURVEY), 'survey')}) where likert_item")
def likert_items(spark, d):
    return profile.classification(view(spark, d, "survey")).where("likert_item").select("variable")


@query("classify_columns", with_views(_class_sql("survey", _SURVEY), "survey"))
def classify_columns(spark, d):
    return profile.classification(view(spark, d, "survey"), exact=True)


@query("binary_columns", with_views(union_all(
    f"select '{c}' as variable, count(distinct {c}) = 2 and min({c}) = 0 and max({c}) = 1 as is_binary from multi"
    for c in ("outcome_returned", "outcome_accepted", "outcome_none", "respondent")), "multi"))
def binary_columns(spark, d):
    return profile.binary_columns(hold(view(spark, d, "multi")), ["outcome_returned", "outcome_accepted", "outcome_none", "respondent"])


_HINTS = {"basic": fv.BASIC_HINTS, "behavior": fv.BEHAVIOR_HINTS, "cognitive": fv.COGNITIVE_HINTS}


def _hint_sql(hints) -> str:
    parts = []
    for h in hints:
        parts.append(f"list_contains(tokens, '{h}') or list_contains(snake, '{h}') or name = '{h}'")
        if "_" in h:
            parts.append(f"starts_with(name, '{h}_') or ends_with(name, '_{h}') or contains(name, '_{h}_')")
        if len(h) >= 5:
            parts.append(f"contains(name, '{h}')")
    return "(" + " or ".join(parts) + ")"


@query("hint_match", "with n as (select doc_id, lower(text) as name from documents), "
       "t as (select *, regexp_split_to_array(name, '[^a-z0-9]+') as tokens, string_split(name, '_') as snake from n) "
       "select doc_id, " + ", ".join(f"{_hint_sql(h)} as {g}" for g, h in _HINTS.items()) + " from t")
def hint_match(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.lower("text").alias("name"))
    return t.select("doc_id", *[matches_hints(F.col("name"), h).alias(g) for g, h in _HINTS.items()])
