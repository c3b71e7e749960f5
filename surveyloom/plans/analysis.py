"""The whole analysis of one survey table."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import conjoint, describe, facts, models, moments, pricing, purchase, roles, scales, segments, stat_tests
from ..operators.clean import clean_values, reverse_code
from ..operators.headers import rename_columns, resolve_names
from ..operators.profile import profile, profiled_columns
from ..sources.tables import write_tables
from .holding import hold, owning, release, settle
from .session import ship

ROW_ID, ORDER = "_row", "_order"


@dataclass(frozen=True)
class SurveyConfig:
    """Every entry is optional; names may be question texts or variable names."""

    rename: dict = field(default_factory=dict)
    reverse_items: tuple = ()
    id_columns: tuple = ()
    constructs: dict = field(default_factory=dict)
    outcome: str | None = None
    predictors: tuple = ()
    mediators: tuple = ()
    moderators: tuple = ()
    randomness_variables: tuple = ()
    independence_pairs: tuple = ()
    conjoint: dict = field(default_factory=dict)
    psm: dict = field(default_factory=dict)
    segment_k: int | None = None
    cluster_features: tuple = ()
    segment_names: dict = field(default_factory=dict)
    persona_basic_variables: tuple = ()
    persona_behavior_variables: tuple = ()
    persona_cognitive_variables: tuple = ()
    purchase_question_variables: tuple = ()
    metadata: dict = field(default_factory=dict)
    #: Cuts of what is chosen automatically; what is named here is never cut, and without an entry nothing is:
    #: randomness_variables, pairs, pair_columns, segment_columns, correlation_columns, correlation_pairs, conjoint_attributes,
    #: predictors, mediators, moderators, persona_variables, purchase_questions.
    limits: dict = field(default_factory=dict)

    @classmethod
    def from_dict(cls, config: dict) -> "SurveyConfig":
        """From a parsed JSON document; unknown keys are ignored."""
        known = {k: v for k, v in config.items() if k in cls.__dataclass_fields__}
        for alias in ("n_segments", "cluster_k"):
            if alias in config:
                known.setdefault("segment_k", config[alias])
        return cls(**known)


def with_row_id(df: DataFrame, row_id: str | None) -> DataFrame:
    """Add a 64-bit row key: the caller's respondent id, else consecutive numbers in file order.

    The numbers are the position inside the partition plus the rows of the partitions before it.
    """
    if row_id:
        return df.withColumn(ROW_ID, F.col(f"`{row_id}`"))
    placed = hold(df.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    sizes = placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    before, starts = 0, []
    for r in sizes:
        starts.append((r["p"], before))
        before += r["n"]
    table = df.sparkSession.createDataFrame(starts, "_p bigint, _b bigint")  # one row per partition
    offset = F.col("_m") - F.shiftleft(part, 33)
    return placed.withColumn("_p", part).join(F.broadcast(table), "_p").withColumn(
        ROW_ID, F.col("_b") + offset + 1).select(*[F.col(f"`{c}`") for c in df.columns], ROW_ID)


class Analysis(dict):
    """Result tables by name. The frames that they read are held until :meth:`release`; after that they are computed anew."""

    def __init__(self):
        super().__init__()
        self.held: list[DataFrame] = []

    def release(self) -> None:
        release(self.held)


def analyze(raw: DataFrame, config: SurveyConfig | None = None, row_id: str | None = None, draws: int = 300,
            restarts: int = 10, order_by: str | None = None) -> Analysis:
    """Result tables by name. Give ``row_id`` (a unique respondent column) for large tables.

    Tests of the sequence follow ``order_by`` (a raw column, such as a time), else the order of the file.
    """
    ship(raw.sparkSession)
    tables = Analysis()
    with owning(tables.held):
        _analyze(tables, raw, config or SurveyConfig(), row_id, draws, restarts, order_by)
    return tables


def _analyze(tables: Analysis, raw: DataFrame, cfg: SurveyConfig, row_id: str | None, draws: int, restarts: int, order_by: str | None) -> None:
    sequence = F.col(f"`{order_by}`") if order_by else F.monotonically_increasing_id()
    placed = with_row_id(raw.withColumn(ORDER, sequence), row_id)
    names = [c for c in placed.columns if c not in (ROW_ID, ORDER)]
    key = row_id or "row_number"
    renamed, variable_map, mapping = rename_columns(raw, dict(cfg.rename))
    keyed = placed.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(names, renamed.columns)], ROW_ID, ORDER)
    limit = dict(cfg.limits).get

    def resolve(names):
        return resolve_names(names, mapping)

    # The one table that is written; scores, segments and all else are projections of it.
    cleaned = settle(reverse_code(clean_values(keyed, (ROW_ID, ORDER)), resolve(cfg.reverse_items)))
    ids = set(resolve(cfg.id_columns))
    base_stats = profile(cleaned, [c for c in profiled_columns(cleaned) if c not in (ROW_ID, ORDER)])

    scored, summary, constructs = scales.detect_constructs(cleaned, dict(cfg.constructs), cfg.id_columns, mapping, base_stats)
    columns = [c for c in scored.columns if c not in (ROW_ID, ORDER)]
    survey = scored.drop(ROW_ID, ORDER)
    stats = base_stats | profile(scored, list(constructs))
    stats = {c: stats[c] for c in columns if c in stats}
    numbers = [c for c in columns if c in stats and stats[c].numeric]

    outcome = roles.choose_outcome(columns, resolve([cfg.outcome])[0] if cfg.outcome else None)
    outcome = outcome if outcome in stats and stats[outcome].numeric else None
    predictors = roles.choose_predictors(survey, outcome, constructs, stats, resolve(cfg.predictors))
    tables |= {"variable_map": variable_map, "cleaned_data": survey}
    if constructs:
        tables["construct_scores"] = scored.select(*constructs)
    tables["construct_summary"] = summary
    tables["descriptives"] = describe.descriptives(survey, numbers)
    tables["categorical_distributions"] = describe.categorical_distributions(survey, list(stats), id_columns=ids, stats=stats)
    if len(numbers) >= 2:
        tables["correlations"] = moments.correlation_square(moments.correlations(survey, numbers), numbers)
    choice = dict(cfg.conjoint)
    checked = resolve([*cfg.randomness_variables, *choice.get("attributes", ())])
    tables["randomness_tests"] = stat_tests.run_randomness_tests(scored, [ORDER, ROW_ID], checked, ids, limit("randomness_variables"), stats)

    regression, fit = models.run_regression(survey, outcome, predictors, stats)
    tables["regression_coefficients"] = regression
    if fit["n"]:
        tables["regression_fit"] = raw.sparkSession.createDataFrame(
            [(outcome, int(fit["n"]), fit["r2"], fit["adj_r2"])], "outcome string, n bigint, r2 double, adj_r2 double")
    if outcome:
        mediators = models.named_or_scored(resolve(cfg.mediators), columns) or [
            c for c in constructs if c != outcome and any(h in c.lower() for h in models.fv.MEDIATOR_HINTS)]
        paths = models.mediation_paths(survey, outcome, predictors, mediators, limit("predictors"), limit("mediators"), stats)
        tables["mediation"] = models.run_mediation(scored, paths, ROW_ID, draws, stats=stats)
        moderators = models.choose_moderators(survey, outcome, resolve(cfg.moderators), list(constructs))
        tables["moderation"] = models.run_moderation(survey, outcome, predictors, moderators, limit("predictors"), limit("moderators"), stats)

    def one(key):
        return resolve([choice[key]])[0] if choice.get(key) else None

    utilities, importance, _ = conjoint.run_conjoint(
        survey, one("chosen"), one("rating"), resolve(choice.get("attributes", ())),
        (outcome, one("respondent"), one("task"), one("alternative")), ids, stats, max_attributes=limit("conjoint_attributes"))
    tables["conjoint_utilities"], tables["conjoint_importance"] = utilities, importance

    psm = {k: resolve([v])[0] for k, v in dict(cfg.psm).items()}
    for name, t in pricing.run_pricing(scored.drop(ORDER), psm, ROW_ID).items():
        tables[f"psm_{name}"] = t.withColumnRenamed(ROW_ID, key)

    groups = segments.profile_groups(
        stats, {"basic": resolve(cfg.persona_basic_variables), "behavior": resolve(cfg.persona_behavior_variables),
                "cognitive": resolve(cfg.persona_cognitive_variables)}, constructs, predictors, outcome, ids, limit("persona_variables"))
    behaviour = [c for c in groups["behavior"] if stats[c].numeric and stats[c].distinct > 2]
    candidates = [c for c in resolve(cfg.cluster_features) if c in stats] or [
        *constructs, *predictors, *behaviour, *([outcome] if outcome else [])]
    features = segments.cluster_features(stats, candidates)
    found = segments.run_segmentation(scored.drop(ORDER), ROW_ID, features, groups, stats,
                                      [*constructs, *predictors, *([outcome] if outcome else [])],
                                      cfg.segment_k, {str(k): v for k, v in dict(cfg.segment_names).items()}, restarts)
    tested = survey
    if found:
        tables["segment_assignments"] = found["assignments"].withColumnRenamed(ROW_ID, key)
        tables["segment_profiles"] = found["profiles"]
        tables["persona_profile_details"] = found["details"]
        tables["consumer_persona_summary"] = found["summary"]
        for name, t in pricing.run_pricing(found["joined"], psm, ROW_ID, "segment", found["profiles"]).items():
            tables[f"psm_segment_{name}"] = t.withColumnRenamed(ROW_ID, key)
        tested = found["joined"].drop(ROW_ID)
        stats = stats | profile(tested, ["segment"])
    priority = [c for c in [outcome, *resolve([*cfg.predictors, *cfg.mediators, *cfg.moderators])] if c]
    tables["independence_tests"] = stat_tests.run_independence_tests(
        tested, [tuple(p) for p in cfg.independence_pairs], priority, id_columns=ids, mapping=mapping, limits=dict(cfg.limits),
        stats=stats)
    asked = purchase.purchase_questions(variable_map, stats, cfg.purchase_question_variables, outcome, mapping, ids, limit("purchase_questions"))
    tables["purchase_question_distributions"] = purchase.question_distributions(survey, variable_map, asked, stats)
    tables["ranking_summary"] = describe.ranking_summary(survey)
    # The results are small; the facts and the sinks read them again.
    whole = {"cleaned_data", "construct_scores", "psm_monotonicity", "psm_segment_monotonicity", "segment_assignments"}
    for name in set(tables) - whole:
        tables[name] = hold(tables[name])
    rows = next(iter(stats.values())).rows if stats else 0
    meta = dict(cfg.metadata)
    tables["report_facts"] = facts.report_facts(
        tables, int(meta.get("raw_sample", rows)), int(meta.get("valid_sample", rows)), survey)


def run(raw: DataFrame, output: str, config: SurveyConfig | None = None, row_id: str | None = None,
        format: str = "parquet", order_by: str | None = None) -> list[str]:
    """Analyse and write every non-empty table below ``output``."""
    tables = analyze(raw, config, row_id, order_by=order_by)
    try:
        return write_tables(tables, output, format)
    finally:
        tables.release()
