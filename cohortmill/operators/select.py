"""Feature selection, top lists and feature-set algebra.  Results are DataFrames of features."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.measures import missing_rate, pearson, zero_rate
from ..functions.nulls import holds, number
from ..functions.relate import attach, attach_checked, first_per_key


def feature_stats(df: DataFrame, layout, target: str | None = None) -> DataFrame:
    """All selection statistics per feature, from one aggregation over the data."""
    aggs = {"missing_rate": missing_rate, "zero_rate": zero_rate, "variance": F.var_samp, "std": F.stddev_samp}
    if target:
        aggs["corr"] = lambda x: pearson(x, target)
    stats = layout.summarise(df, aggs=aggs)
    return layout.as_rows(stats) if hasattr(layout, "as_rows") else stats


def keep_by_missing(stats: DataFrame, threshold: float = 0.1) -> DataFrame:
    return stats.where(F.col("missing_rate") <= threshold)


def keep_by_variance(stats: DataFrame, threshold: float = 0.0) -> DataFrame:
    return stats.where(F.col("variance") > threshold)


def keep_by_correlation(stats: DataFrame, threshold: float = 0.1) -> DataFrame:
    """|r| > threshold; an undefined r counts as 0."""
    return stats.withColumn("corr", F.coalesce("corr", F.lit(0.0))).where(F.abs("corr") > threshold)


def keep_by_significance(stats: DataFrame, results: DataFrame, threshold: float = 0.05,
                         p_value: str = "p_value_corrected", feature: str = "feature_id", result_feature: str = "unique_feature_label") -> DataFrame:
    """Features with any result strictly below the threshold."""
    hits = results.where(number(p_value) < threshold).select(F.col(result_feature).alias(feature))
    return stats.join(hits, feature, "left_semi")


def drop_low_quality(df: DataFrame, layout, missing: float = 0.5, zero: float = 0.3):
    """(rows, kept features, removed features); a feature goes if missing > or zero > its limit.

    For a wide table the kept columns must be known to plan the projection: one aggregated row is
    fetched, two numbers per column.
    """
    stats = feature_stats(df, layout)
    bad = holds(F.col("missing_rate") > missing) | holds(F.col("zero_rate") > zero)
    kept, removed = stats.where(~bad), stats.where(bad)
    if hasattr(layout, "as_rows"):
        gone = {r["feature_id"] for r in removed.select("feature_id").collect()}
        names = [c for c in layout.columns if c not in gone]
        return df.drop(*gone), type(layout)(names), sorted(gone)
    flag = kept.select(layout.feature, F.lit(True).alias("__kept"))
    rows = attach_checked(df, flag, [layout.feature], "inner").drop("__kept")
    return rows, kept.select(layout.feature), removed.select(layout.feature)


def drop_features_with_nulls(df: DataFrame, layout):
    """Only features without any missing value; same result triple as ``drop_low_quality``."""
    return drop_low_quality(df, layout, missing=0.0, zero=1.0)


def top_features(stats: DataFrame, n: int, criterion: str = "variance", ascending: bool = False, feature: str = "feature_id") -> DataFrame:
    """The ``n`` best by variance, std or |correlation|; ties by feature id."""
    score = F.abs("corr") if criterion == "correlation" else F.col(criterion)
    scored = stats.withColumn("score", score).where(F.col("score").isNotNull())
    return scored.orderBy(F.col("score").asc() if ascending else F.col("score").desc(), F.col(feature)).limit(n)


@dataclass(frozen=True)
class Criteria:
    """Thresholds of the stepwise selection; ``None`` skips a step."""

    missing: float | None = 0.1
    variance: float | None = 0.01
    correlation: float | None = 0.05
    p_value: float | None = 0.05
    max_features: int | None = None
    ranking: str = "variance"


def select_comprehensive(df: DataFrame, layout, criteria: Criteria = Criteria(), target: str | None = None,
                         results: DataFrame | None = None, feature: str = "feature_id", result_feature: str = "unique_feature_label"):
    """(selected features with statistics, counts per step).

    Statistics of a feature do not depend on which others remain, so all are computed at once and
    the steps are filters.
    """
    stats = feature_stats(df, layout, target)
    feature = "feature_id" if hasattr(layout, "as_rows") else layout.feature
    steps = {"original": F.lit(True)}
    if criteria.missing is not None:
        steps["missing"] = holds(F.col("missing_rate") <= criteria.missing)
    if criteria.variance is not None:
        steps["variance"] = holds(F.col("variance") > criteria.variance)
    if target and criteria.correlation is not None:
        steps["correlation"] = holds(F.abs("corr") > criteria.correlation)
    if results is not None and criteria.p_value is not None:
        hits = results.where(number("p_value_corrected") < criteria.p_value) \
            .select(F.col(result_feature).alias(feature)).distinct().withColumn("__hit", F.lit(True))
        stats = attach(stats, hits, [feature])
        steps["significance"] = holds(F.col("__hit"))
    depth = F.lit(len(steps))
    for i, passes in reversed(list(enumerate(steps.values()))):
        depth = F.when(~passes, F.lit(i)).otherwise(depth)
    marked = stats.withColumn("__depth", depth)
    selected = marked.where(F.col("__depth") == len(steps)).drop("__depth", "__hit")
    if criteria.max_features:
        selected = top_features(selected, criteria.max_features, criteria.ranking, feature=feature).drop("score")
    made = [F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.count_if(F.col("__depth") > i).alias("n_features"))
            for i, n in enumerate(steps)]
    last = F.count_if(F.col("__depth") == len(steps))
    final = F.least(last, F.lit(criteria.max_features)) if criteria.max_features else last
    made.append(F.struct(F.lit(len(steps)).alias("step_no"), F.lit("final").alias("step"), final.cast("long").alias("n_features")))
    counts = marked.agg(F.array(*made).alias("s"), F.count(F.lit(1)).alias("all")).select(F.explode("s").alias("s"), "all") \
        .select("s.*", F.try_divide(F.col("s.n_features").cast("double"), F.col("all")).alias("ratio"))
    return selected, counts


def filter_significant(results: DataFrame, cutoff: float = 0.05, p_value: str = "p_value_corrected", feature: str = "unique_feature_label") -> DataFrame:
    """Results at or below the cutoff, sorted by corrected p-value."""
    return results.where(number(p_value) <= cutoff).orderBy(p_value, feature)


def top_significant(results: DataFrame, n: int = 100, sort_by: str = "p_value_corrected", significant_only: bool = True,
                    feature: str = "unique_feature_label") -> DataFrame:
    """First ``n`` distinct features by their best value; ascending iff the name has ``p_value``."""
    if significant_only and "significant" in results.columns:
        results = results.where(holds(F.col("significant")))
    if sort_by not in results.columns:
        sort_by = "p_value" if "p_value" in results.columns else results.columns[0]
    ascending = "p_value" in sort_by.lower()
    best = results.groupBy(feature).agg((F.min if ascending else F.max)(sort_by).alias(sort_by))
    order = F.col(sort_by).asc_nulls_last() if ascending else F.col(sort_by).desc_nulls_last()
    return best.orderBy(order, feature).limit(n)


def select_by_criteria(results: DataFrame, fdr: float = 0.05, min_effect: float | None = None, annotated_only: bool = False,
                       min_observations: int | None = None, feature: str = "unique_feature_label") -> DataFrame:
    """Distinct features with corrected p <= fdr and the optional further conditions."""
    kept = results.where(number("p_value_corrected") <= fdr)
    if min_effect is not None:
        kept = kept.where(F.abs("estimate") >= min_effect)
    if annotated_only:
        kept = kept.where(F.col("compound_id").isNotNull())
    if min_observations is not None:
        kept = kept.where(F.col("n_observations") >= min_observations)
    return kept.select(feature).distinct()


def select_user_list(available: DataFrame, names, feature: str = "feature_id") -> DataFrame:
    """The caller's features that exist.  ``names`` is a DataFrame or a short list."""
    if not isinstance(names, DataFrame):
        names = available.sparkSession.createDataFrame([(n,) for n in names], available.select(feature).schema)
    return names.select(feature).distinct().join(available, feature, "left_semi")


def select_auto(results: DataFrame, user_list=None, n: int = 100, feature: str = "unique_feature_label") -> DataFrame:
    """The user's list if one is given, else the top ``n``."""
    if user_list:
        return select_user_list(results.select(feature).distinct(), user_list, feature)
    return top_significant(results, n, feature=feature).select(feature)


def select_auto_balanced(results: DataFrame, max_features: int = 100, p_value: float = 0.05,
                         feature: str = "unique_feature_label", compound_class: str = "compound_class") -> DataFrame:
    """Best result per feature, dealt round-robin over compound classes, annotated and low p first."""
    hits = results.where(number("p_value_corrected") <= p_value)
    best = first_per_key(hits.select(feature, compound_class, "compound_id", "p_value_corrected"), [feature],
                         [F.col("p_value_corrected"), F.col("compound_id"), F.col(compound_class)])
    plain = F.col("compound_id").isNull().cast("int")
    ranked = _top_per_class(best.withColumn("__plain", plain), compound_class, ["__plain", "p_value_corrected", feature], max_features)
    return ranked.orderBy("__rn", "__plain", "p_value_corrected", feature).limit(max_features).select(feature, compound_class, "p_value_corrected")


def _top_per_class(df, by, order, n):
    """The ``n`` first rows per class with their number, reduced in 256 slices before ranking."""
    sliced = df.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(256)))
    local = Window.partitionBy(by, "__slice").orderBy(*order)
    few = sliced.withColumn("__rn", F.row_number().over(local)).where(F.col("__rn") <= n)
    return few.withColumn("__rn", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("__rn") <= n)


# Text that marks an interesting annotation for an outcome.
NOTABLE_PATTERNS = {"sb": "preg", "eope": "lipid", "lope": "amino", "ptb": "fatty", "sga": "glucose"}


def notable_features(compared: DataFrame, outcome: str, n: int = 10, patterns: dict[str, str] = NOTABLE_PATTERNS) -> DataFrame:
    """Annotated features significant in both runs whose id matches the outcome's pattern.

    If none matches, the ``n`` with the smallest new corrected p-value.
    """
    both = compared.where(F.col("sig_in_both") & F.col("compound_id").isNotNull())
    pattern = patterns.get(outcome)
    matched = both.where(F.col("compound_id").rlike(f"(?i){pattern}")) if pattern else both.where(F.lit(False))
    found = matched.agg(F.count(F.lit(1)).alias("n")).scalar()
    smallest = both.orderBy("p_value_corrected_new", "unique_feature_label", "group").limit(n).where(found == 0)
    return matched.unionByName(smallest)


def feature_set_intersect(*sets: DataFrame) -> DataFrame:
    out = sets[0]
    for s in sets[1:]:
        out = out.intersect(s)
    return out


def feature_set_union(*sets: DataFrame) -> DataFrame:
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s)
    return out.distinct()


def feature_set_except(requested: DataFrame, available: DataFrame) -> DataFrame:
    return requested.subtract(available)


def load_all_results(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Union of result tables keyed by (strata, group_type), tagged with both; absent ones are left out."""
    out = None
    for (strata, group_type), df in tables.items():
        tagged = df.withColumns({"strata": F.lit(strata), "group_type": F.lit(group_type)})
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def load_new_results(results: DataFrame) -> DataFrame:
    """Significant rows in the shape used by the comparison."""
    return results.where(holds(F.col("significant"))).select(
        "unique_feature_label", "group", "compound_id", "compound_class",
        F.col("estimate").alias("estimate_new"), F.col("p_value").alias("p_value_new"),
        F.col("p_value_corrected").alias("p_value_corrected_new"))


def load_previous_results(previous: DataFrame) -> DataFrame:
    """Pooled rows of an earlier run; the group keeps the tokens after its second underscore."""
    tokens = F.split("group", "_")
    return previous.where(F.col("analysis") == "pooled").select(
        "unique_feature_label", F.lower(F.array_join(F.slice(tokens, 3, F.greatest(F.size(tokens), F.lit(1))), "_")).alias("group"),
        F.col("Coefficient_Intensity").alias("estimate_old"), F.col("p_value").alias("p_value_old"),
        F.col("FDR").alias("p_value_corrected_old"))
