"""Answer cleaning, recoding and standardising. Row-level work is projections only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import answer_or_number, answer_text, is_numeric, text_number
from .profile import ColumnProfile, all_levels, label, number, numeric_frequencies, profile, profiles_of
from .ordered import weighted_quantiles

NUMERIC_SHARE = 0.70
MAX_DUMMY_LEVELS = 8


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def with_answer_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Stripped answers in place of the raw ones: the stage the number rules read from."""
    return df.withColumns({c: answer_text(F.col(f"`{c}`")) for c in columns}) if columns else df


def numeric_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(variable, numeric_share, inferred_type)`` of the text columns: one scan, one row out."""
    columns = columns or text_columns(df)
    # One long column keeps the generated code small however many questions there are.
    long = df.select(*[F.col(f"`{c}`") for c in columns]).unpivot([], columns, "variable", "answer")
    parsed = long.withColumn("answer", answer_text(F.col("answer"))).withColumn("answer", text_number(F.col("answer")))
    shares = parsed.groupBy("variable").agg(F.avg(F.col("answer").isNotNull().cast("double")).alias("numeric_share"))
    kind = F.when(F.col("numeric_share") >= NUMERIC_SHARE, "numeric").otherwise("text")
    return shares.withColumn("inferred_type", kind)


def clean_values(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numbers where at least 70 % of all rows parse, normalised text elsewhere; ``keep`` passes through."""
    texts = [c for c in text_columns(df) if c not in keep]
    kinds = {r["variable"]: r["inferred_type"] for r in numeric_shares(df, texts).collect()} if texts else {}
    out = []
    for name in df.columns:
        col = F.col(f"`{name}`")
        if name in kinds:
            col = text_number(col) if kinds[name] == "numeric" else answer_or_number(col)
        elif name not in keep and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType, T.BooleanType)):
            col = number(df, name)
        out.append(col.alias(name))
    return with_answer_texts(df, list(kinds)).select(*out)


def reverse_code(df: DataFrame, items: list[str]) -> DataFrame:
    """``max + min - x`` with the observed range."""
    items = [i for i in items if i in df.columns and is_numeric(df.schema[i].dataType)]
    if not items:
        return df
    ranges = df.agg(*[F.struct(F.min(number(df, i)), F.max(number(df, i))).alias(i) for i in items]).first()
    coded = {}
    for item in items:
        low, high = ranges[item]
        if low is not None and high > low:
            coded[item] = F.lit(high + low) - number(df, item)
    return df.withColumns(coded) if coded else df


def zscore_column(value: Column, mean: float | None, std_pop: float | None) -> Column:
    if mean is None or not std_pop:
        return F.lit(None).cast("double")
    return (value - F.lit(mean)) / F.lit(std_pop)


def zscore(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace the columns by population z-scores; NULL where there is no spread."""
    stats = df.agg(*[F.struct(F.avg(number(df, c)), F.stddev_pop(number(df, c))).alias(c) for c in columns]).first()
    return df.withColumns({c: zscore_column(number(df, c), *stats[c]) for c in columns})


def dummy_columns(df: DataFrame, name: str, levels: list[str], drop_first: bool) -> dict[str, Column]:
    """One 0/1 column per (sorted) level; a missing answer is 0 everywhere."""
    value = label(df, name)
    kept = levels[1:] if drop_first else levels
    return {f"{name}_{lv}": F.coalesce((value == lv).cast("double"), F.lit(0.0)) for lv in kept}


def sorted_levels(df: DataFrame, name: str, levels: list[str]) -> list[str]:
    if is_numeric(df.schema[name].dataType):
        return sorted(levels, key=lambda lv: (float(lv) if lv not in ("true", "false") else lv == "true"))
    return sorted(levels)


def encode_predictors(df: DataFrame, predictors: list[str], stats: dict[str, ColumnProfile] | None = None) -> dict[str, Column]:
    """Standardised design columns: z-scored numbers and z-scored dummies of 2-8 level texts.

    Standardising uses all rows of the table, whatever rows a model later drops.
    """
    predictors = [p for p in dict.fromkeys(predictors) if p in df.columns]
    stats = profiles_of(df, predictors, stats)
    design: dict[str, Column] = {}
    for name in predictors:
        p = stats[name]
        if p.numeric:
            if p.count >= 8 and p.std_pop:
                design[name] = zscore_column(number(df, name), p.mean, p.std_pop)
        elif 2 <= p.distinct <= MAX_DUMMY_LEVELS:
            counts = dict(p.levels)
            levels = sorted_levels(df, name, list(counts))
            for column, dummy in dummy_columns(df, name, levels, drop_first=True).items():
                share = counts[column[len(name) + 1:]] / p.rows
                design[column] = zscore_column(dummy, share, (share * (1 - share)) ** 0.5)
    return design


def dummy_encode(df: DataFrame, name: str, drop_first: bool, keep: list[str]) -> DataFrame:
    levels = sorted_levels(df, name, all_levels(df, profile(df, [name])[name]))
    dummies = dummy_columns(df, name, levels, drop_first)
    return df.select(*keep, *[c.alias(k) for k, c in dummies.items()])


def imputed_columns(df: DataFrame, features: list[str]) -> dict[str, Column]:
    """Median imputation, then population z-scores, as columns over ``df``; features without spread are dropped."""
    freq = numeric_frequencies(df, features)
    medians = {r["variable"]: r["median"] for r in
               weighted_quantiles(freq, ["variable"], "value", "n", {"median": 0.5}).collect()}
    features = [f for f in features if f in medians]
    if not features:
        return {}
    filled = {f: F.coalesce(number(df, f), F.lit(medians[f])) for f in features}
    stats = df.agg(*[F.struct(F.avg(c), F.stddev_pop(c)).alias(f) for f, c in filled.items()]).first()
    return {f: zscore_column(c, *stats[f]) for f, c in filled.items() if stats[f][1]}


def impute_and_standardize(df: DataFrame, features: list[str], keep: list[str]) -> tuple[DataFrame, list[str]]:
    """The columns of :func:`imputed_columns` beside ``keep``, and their names."""
    columns = imputed_columns(df, features)
    return df.select(*keep, *[c.alias(f) for f, c in columns.items()]), list(columns)
