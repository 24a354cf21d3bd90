"""Aggregations: feature quality, counts, summaries and report data."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.measures import missing_rate, pearson, share, zero_rate
from ..functions.nulls import holds, number
from ..functions.relate import SALTS, attach
from .ranking import chunked, exact_quantiles, running


def missing_zero_rates(df: DataFrame, layout, by=()) -> DataFrame:
    """Share of missing and of zero values per feature, over all rows, in one aggregation."""
    return layout.summarise(df, by, {"missing_rate": missing_rate, "zero_rate": zero_rate})


def feature_moments(df: DataFrame, layout, by=()) -> DataFrame:
    """Sample ``variance`` and ``std`` per feature; null for a single value."""
    return layout.summarise(df, by, {"variance": F.var_samp, "std": F.stddev_samp})


def feature_target_corr(df: DataFrame, layout, target: str) -> DataFrame:
    """Pearson ``corr`` of every feature with a numeric column; null where undefined."""
    return layout.summarise(df, aggs={"corr": lambda x: pearson(x, target)})


def spearman_ranks(df: DataFrame, by, value: str, name: str) -> DataFrame:
    """Average ranks per group, through distinct values and running counts."""
    known = df.withColumn(value, number(value)).where(F.col(value).isNotNull())
    counts = known.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__c"))
    cum = running(chunked(counts, by, value), by, value, "__cum", "sum", F.col("__c"))
    ranks = cum.select(*by, value, (F.col("__cum") - (F.col("__c") - 1) / 2.0).alias(name))
    return attach(known, ranks, [*by, value], salts=SALTS)


def spearman_target_corr(df: DataFrame, feature: str, value: str, target: str) -> DataFrame:
    """Rank correlation of every feature (long table) with a numeric column, over complete pairs."""
    pairs = df.withColumns({value: number(value), target: number(target)}).dropna(subset=[value, target])
    ranked = spearman_ranks(spearman_ranks(pairs, [feature], value, "__rx"), [feature], target, "__ry")
    return ranked.groupBy(feature).agg(pearson("__rx", "__ry").alias("corr"))


def feature_quantiles(df: DataFrame, layout, probs: dict[str, float] | None = None, by=(), accuracy: int | None = None) -> DataFrame:
    probs = probs or {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return layout.summarise(df, by, probs=probs, accuracy=accuracy)


def count_subjects(df: DataFrame, subject=("site", "orig_id")) -> DataFrame:
    return df.select(*subject).distinct().agg(F.count(F.lit(1)).alias("n_subjects"))


def attrition_counts(df: DataFrame, steps: dict[str, Column], subject=("site", "orig_id")) -> DataFrame:
    """Distinct subjects left after each ordered filter: ``step_no``, ``step``, ``n_subjects``.

    A row's depth is the number of leading steps it passes, a subject's is its deepest row, so one
    aggregation per subject and one small count serve all steps.
    """
    passed = [holds(c) for c in steps.values()]
    chain = F.lit(len(passed))
    for i, c in reversed(list(enumerate(passed))):
        chain = F.when(~c, F.lit(i)).otherwise(chain)
    deepest = df.groupBy(*subject).agg(F.max(chain).alias("depth"))
    names = F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step")) for i, n in enumerate(["all", *steps])])
    reached = deepest.groupBy("depth").agg(F.count(F.lit(1)).alias("n"))
    return reached.select("n", "depth", F.explode(names).alias("s")).select("n", "depth", "s.*").groupBy("step_no", "step").agg(
        F.sum(F.when(F.col("depth") >= F.col("step_no"), F.col("n")).otherwise(0)).alias("n_subjects"))


def duplicate_ids_per_group(df: DataFrame, group: str = "group", key: str = "sample_id") -> DataFrame:
    """Surplus rows per group: rows with a repeated id."""
    per_id = df.groupBy(group, key).agg(F.count(F.lit(1)).alias("__c"))
    return per_id.groupBy(group).agg(F.sum(F.col("__c") - 1).alias("n_duplicates"))


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def split_summary(df: DataFrame, outcome: str, split: str = "dataset_assignment", subject: str = "subject_id", site: str = "site") -> DataFrame:
    """Per split and site, and per split (site null): samples, subjects, cases, cases per 100 subjects."""
    per_subject = df.groupBy(split, site, subject).agg(
        F.count(F.lit(1)).alias("__s"), F.sum(F.col(outcome).cast("long")).alias("__o"))

    def totals(frame, *keys):
        return frame.groupBy(*keys).agg(
            F.sum("__s").alias("n_samples"), F.count(F.lit(1)).alias("n_subjects"), F.sum("__o").alias("n_outcome"))

    whole = per_subject.groupBy(split, subject).agg(F.sum("__s").alias("__s"), F.sum("__o").alias("__o"))
    both = totals(whole, split).withColumn(site, F.lit(None).cast(df.schema[site].dataType)).unionByName(totals(per_subject, split, site))
    return both.withColumn("outcome_pct", F.try_divide(F.col("n_outcome") * 100.0, F.col("n_subjects")))


def dataset_characteristics(long: DataFrame, metadata: DataFrame, outcome: str, flags=(), feature: str = "feature_id",
                            value: str = "value", subject: str = "subject_id") -> DataFrame:
    """One row on a dataset: sizes, prevalence, population counts and shares, intensity statistics.

    ``missing_values`` counts the cells a wide table would lack.
    """
    x = number(value)
    per_feature = long.groupBy(feature).agg(
        F.avg(x).alias("m"), F.stddev_samp(x).alias("s"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("c"))
    features = per_feature.agg(
        F.count(F.lit(1)).alias("n_features"), F.avg("m").alias("mean_intensity"), F.avg("s").alias("std_intensity"),
        F.min("lo").alias("min_intensity"), F.max("hi").alias("max_intensity"), F.sum("c").alias("__cells"))
    per_subject = metadata.groupBy(subject).agg(
        F.count(F.lit(1)).alias("s"), F.sum(F.col(outcome).cast("long")).alias("o"),
        *[F.count_if(F.col(f)).alias(f) for f in flags])
    samples = per_subject.agg(
        F.sum("s").alias("n_samples"), F.count(F.lit(1)).alias("n_subjects"),
        F.try_divide(F.sum("o").cast("double"), F.sum("s")).alias("outcome_prevalence"),
        *[F.sum(f).alias(f"{f}_count") for f in flags],
        *[F.try_divide(F.sum(f).cast("double"), F.sum("s")).alias(f"{f}_proportion") for f in flags])
    return attach(samples, features, []).withColumn(
        "missing_values", F.col("n_samples") * F.col("n_features") - F.col("__cells")).drop("__cells")


def site_statistics(long: DataFrame, site: str = "site", feature: str = "feature_id", sample: str = "sample_id", value: str = "value") -> DataFrame:
    """Per site: samples, mean of feature means, mean of feature standard deviations."""
    x = number(value)
    per_feature = long.groupBy(site, feature).agg(F.avg(x).alias("m"), F.stddev_samp(x).alias("s"))
    levels = per_feature.groupBy(site).agg(F.avg("m").alias("mean_intensity"), F.avg("s").alias("std_intensity"))
    sizes = long.select(site, sample).distinct().groupBy(site).agg(F.count(F.lit(1)).alias("n_samples"))
    return attach(sizes, levels, [site])


def subject_any_all(df: DataFrame, subject: str = "subject_id") -> DataFrame:
    """Per subject: healthy at every sample, at risk at any sample."""
    return df.groupBy(subject).agg(
        F.bool_and("healthy_control").alias("healthy_control"),
        F.bool_or("high_risk").alias("high_risk"), F.bool_or("high_risk_broad").alias("high_risk_broad"))


def subject_flags_join(df: DataFrame, subject: str = "subject_id") -> DataFrame:
    """Replace the sample-level population flags by the subject's."""
    flags = ["healthy_control", "high_risk", "high_risk_broad"]
    return attach(df.drop(*flags), subject_any_all(df, subject), [subject], salts=SALTS)


def fit_metrics(results: DataFrame, by=()) -> DataFrame:
    """Percentages of converged, valid and singular fits in one aggregation."""
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_fits"),
        (share(holds(F.col("is_converged"))) * 100.0).alias("convergence_rate"),
        (share(number("p_value").isNotNull()) * 100.0).alias("valid_p_rate"),
        (share(holds(F.col("singular_matrix_error"))) * 100.0).alias("singular_rate"))


def comparison_summary(compared: DataFrame, by_group: bool = False) -> DataFrame:
    keys = ["sig_only_in_new", "sig_only_in_old", "sig_in_both"]
    return group_counts(compared, *(["group"] if by_group else []), *keys)


def cv_metric_summary(folds: DataFrame, metric: str = "metric", value: str = "value", fold: str = "fold") -> DataFrame:
    """Mean and population sd of each metric over all folds; a fold lacking a metric counts as 0."""
    n = folds.select(fold).distinct().agg(F.count(F.lit(1)).alias("__n"))
    sums = folds.groupBy(metric).agg(
        F.count(F.lit(1)).alias("__k"), F.avg(F.coalesce(value, F.lit(0.0))).alias("__m"),
        F.var_pop(F.coalesce(value, F.lit(0.0))).alias("__v"))
    k, total = F.col("__k"), F.col("__n")
    mean = F.col("__m") * k / total
    spread = (F.col("__v") * k + F.col("__m") * F.col("__m") * k * (total - k) / total) / total
    return attach(sums, n, []).select(metric, mean.alias("mean"), F.sqrt(spread).alias("std"))


def validate_quality(df: DataFrame, layout, min_samples: int = 10, min_features: int = 5, max_missing: float = 0.1,
                     sample: str | None = None) -> DataFrame:
    """One row per issue: ``check``, ``subject``, ``observed``, ``required``; none means valid.

    A long table names its ``sample`` column, so that samples are counted once.
    """
    rates = layout.summarise(df, aggs={"missing_rate": missing_rate})
    if hasattr(layout, "as_rows"):
        per_feature, n_samples = layout.as_rows(rates, feature="subject"), df.agg(F.count(F.lit(1)).alias("n"))
        n_features = [c for c in layout.values() if c in df.columns]
        features = df.sparkSession.range(1).select(F.lit(len(n_features)).cast("long").alias("n"))
    else:
        per_feature = rates.withColumnRenamed(layout.feature, "subject")
        n_samples = df.select(sample).distinct().agg(F.count(F.lit(1)).alias("n"))
        features = per_feature.agg(F.count(F.lit(1)).alias("n"))

    def issue(frame, check, subject, observed, required):
        return frame.select(F.lit(check).alias("check"), subject.cast("string").alias("subject"),
                            observed.cast("double").alias("observed"), F.lit(float(required)).alias("required"))

    return issue(n_samples.where(F.col("n") < min_samples), "samples", F.lit("all"), F.col("n"), min_samples) \
        .unionByName(issue(features.where(F.col("n") < min_features), "features", F.lit("all"), F.col("n"), min_features)) \
        .unionByName(issue(per_feature.where(F.col("missing_rate") > max_missing), "missing", F.col("subject"), F.col("missing_rate"), max_missing))


def five_number_summary(df: DataFrame, by, value: str) -> DataFrame:
    """Minimum, quartiles, maximum and count per group (exact, linear interpolation)."""
    names = ["min", "q1", "median", "q3", "max"]
    q = exact_quantiles(df, by, value, [0.0, 0.25, 0.5, 0.75, 1.0])
    counts = df.groupBy(*by).agg(F.count(number(value)).alias("n"))
    return attach(q.select(*by, *[F.col("q")[i].alias(n) for i, n in enumerate(names)]), counts, by)


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins between minimum and maximum; the last bin includes the maximum."""
    known = df.select(number(value).alias("x")).where(F.col("x").isNotNull())
    span = known.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.coalesce(F.floor(F.try_divide(F.col("x") - F.col("lo"), width)), F.lit(0))
    binned = attach(known, span, []).withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
    counted = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    edges = attach(counted, span, [])
    return edges.select("bin", (F.col("lo") + F.col("bin") * width).alias("left_edge"),
                        (F.col("lo") + (F.col("bin") + 1) * width).alias("right_edge"), "count")
