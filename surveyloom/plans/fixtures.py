"""Survey-shaped views over the test tables, in SQL that Spark and DuckDB read alike."""

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_parquet, spread

VIEWS = {
    "survey": """
with b as (
  select c_custkey, c_mktsegment, c_nationkey, c_acctbal,
         cast(floor((c_acctbal + 1000) / 2200) as int) as q,
         cast(c_custkey % 3 as int) - 1 as n1,
         cast(cast((c_custkey - c_custkey % 3) / 3 as bigint) % 3 as int) - 1 as n2,
         cast(cast((c_custkey - c_custkey % 9) / 9 as bigint) % 3 as int) - 1 as n3,
         cast(cast((c_custkey - c_custkey % 27) / 27 as bigint) % 5 as int) as v,
         cast(cast((c_custkey - c_custkey % 135) / 135 as bigint) % 4 as int) as w
  from customer)
select c_custkey as respondent, c_mktsegment as market_segment,
       cast(c_nationkey % 3 as int) + 1 as segment,
       cast(c_nationkey % 5 as int) + 1 as income, c_acctbal as monthly_spend,
       greatest(1, least(5, 1 + q + n1)) as product_quality,
       greatest(1, least(5, 1 + q + n2)) as product_quality_2,
       case when c_custkey % 17 = 0 then null else greatest(1, least(5, 1 + q + n3)) end as product_quality_3,
       greatest(1, least(5, 1 + v + n1)) as perceived_value,
       greatest(1, least(5, 1 + v + n3)) as perceived_value_2,
       greatest(1, least(5, 1 + w + n2)) as brand_trust,
       greatest(1, least(5, 1 + w + n3)) as brand_trust_2,
       greatest(1, least(5, cast(floor((q + v + w) / 3) as int) + 1 + n1)) as purchase_intention,
       greatest(1, least(5, cast(floor((q + v + w) / 3) as int) + 1 + n3)) as purchase_intention_2
from b""",
    "messy": """
select c_custkey as respondent,
       case cast(c_custkey % 14 as int)
         when 0 then '非常同意' when 1 then ' 同意 ' when 2 then '　一般' when 3 then 'N/A'
         when 4 then '45%' when 5 then '18-24岁' when 6 then '4分' when 7 then '--'
         when 8 then '非常满意 5' when 9 then '2024-05-01' when 10 then 'Yes' when 11 then '不 清 楚'
         when 12 then case cast(c_custkey % 3 as int) when 0 then '4006381333931' when 1 then '00123456789012345678' else 'three times a week, mostly' end else cast(c_custkey % 5 + 1 as varchar(10)) end as answer,
       case when c_custkey % 4 = 0 then null else cast(c_custkey % 5 + 1 as varchar(10)) end as mostly_numeric,
       case when c_custkey % 3 = 0 then 'other' else cast(c_custkey % 5 + 1 as varchar(10)) end as mixed_text
from customer""",
    "psm": """
select p_partkey as respondent, cast(p_size % 3 as int) + 1 as segment,
       cast(base / 2 as int) + cast(p_partkey % 7 as int) * 3 as too_cheap,
       case when p_partkey % 10 = 0 then base + 60
            else base - 30 + cast(p_partkey % 5 as int) * 4 end as cheap,
       base + cast(p_partkey % 11 as int) * 3 as expensive,
       case when p_partkey % 23 = 0 then null
            else base + 40 + cast(p_partkey % 13 as int) * 5 end as too_expensive
from (select p_partkey, p_size, 100 + p_size * 10 as base from part) b""",
    "multi": """
select o.o_orderkey as respondent,
       case when o.o_orderkey % 19 = 0 then null else max(case when l_returnflag = 'R' then 1 else 0 end) end as outcome_returned,
       case when o.o_orderkey % 19 = 0 then null else max(case when l_returnflag = 'A' then 1 else 0 end) end as outcome_accepted,
       case when o.o_orderkey % 19 = 0 then null else max(case when l_returnflag = 'N' then 1 else 0 end) end as outcome_none
from orders o join lineitem l on o.o_orderkey = l.l_orderkey
group by o.o_orderkey""",
    "choice": """
select l_orderkey as respondent, l_linenumber as alternative, p_type as product_type,
       cast(p_size % 4 as int) as price_band, cast(l_linenumber % 3 as int) as package,
       case when (cast(p_size % 4 as int) + 2 * cast(l_linenumber % 3 as int) + cast(l_partkey % 3 as int)) % 5 < 2 then 1 else 0 end as chosen,
       1 + (cast(p_size % 4 as int) + cast(l_linenumber % 3 as int) + cast(l_orderkey % 3 as int)) % 7 as rating
from lineitem join part on l_partkey = p_partkey""",
    "ranks": """
select c_custkey as respondent,
       cast((c_custkey * 5 + 1) % 6 as int) + 1 as health_rank_alpha,
       cast(((c_custkey - c_custkey % 2) / 2) as int) % 4 + 1 as health_rank_beta,
       case when c_custkey % 11 = 0 then null else cast((c_custkey * 7) % 5 as int) + 2 end as health_rank_gamma,
       cast((c_custkey * 3 + 2) % 4 as int) + 1 as function_rank_alpha,
       cast(c_custkey % 6 as int) + 1 as function_rank_beta
from customer""",
}

TABLES = {
    "survey": ["customer"], "messy": ["customer"], "psm": ["part"], "multi": ["orders", "lineitem"],
    "choice": ["lineitem", "part"], "ranks": ["customer"],
}


# The widest tables; one file of them may be a single split.
LARGE = ("documents", "lineitem")


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    df = read_parquet(spark, f"{directory.rstrip('/')}/{name}.parquet")
    return spread(df) if name in LARGE else df


def query(spark: SparkSession, directory: str, sql: str, tables: list[str]) -> DataFrame:
    """SQL over test tables; the names in the text become views for this statement."""
    for name in tables:
        table(spark, directory, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def view(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return query(spark, directory, VIEWS[name], TABLES[name])


def with_views(sql: str, *names: str) -> str:
    """DuckDB text: the views as common table expressions in front of ``sql``."""
    ctes = ", ".join(f"{n} as ({VIEWS[n]})" for n in names)
    sql = sql.strip()
    if sql.lower().startswith("with recursive "):
        return f"with recursive {ctes}, {sql[15:]}"
    if sql.lower().startswith("with "):
        return f"with {ctes}, {sql[5:]}"
    return f"with {ctes} {sql}"
