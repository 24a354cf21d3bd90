"""Aggregations, corrections, top lists and feature selection."""

from pyspark.sql import functions as F

from cohortmill.operators import explore, impute, multitest, select, stats
from cohortmill.operators.derive import population_flags
from cohortmill.operators.layout import Long
from cohortmill.operators.normalize import normalization_stats

from .derivation import FLAGGED
from .registry import query

LONG = Long()
RATES = """SELECT feature_id, count(*) FILTER (value IS NULL) / count(*) AS missing_rate, count(*) FILTER (value = 0) / count(*) AS zero_rate,
    var_samp(value) AS variance, stddev_samp(value) AS std FROM {long_missing} GROUP BY feature_id"""
TARGET = """(SELECT l.*, CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS target
    FROM {long_missing} l JOIN {orders} ON sample_id = o_orderkey)"""
CORR = f"""SELECT feature_id, corr(value, target) AS corr FROM {TARGET} GROUP BY feature_id"""


def with_target(t):
    target = t["orders"].select(F.col("o_orderkey").alias("sample_id"), (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("target"))
    return t["long_missing"].join(target, "sample_id")


@query("missing_zero_rates", f"SELECT feature_id, missing_rate, zero_rate FROM ({RATES})", "missing_rate zero_rate")
def _(t):
    return stats.missing_zero_rates(t["long_missing"], LONG)


@query("drop_low_quality_features", f"""
    SELECT l.sample_id, l.feature_id, l.value FROM {{long_missing}} l JOIN ({RATES}) r ON l.feature_id = r.feature_id
    WHERE NOT (missing_rate > 0.5 OR zero_rate > 0.3)""", "value")
def _(t):
    return select.drop_low_quality(t["long_missing"], LONG)[0].select("sample_id", "feature_id", "value")


@query("feature_variance", f"SELECT feature_id, variance FROM ({RATES})", "variance", 2)
def _(t):
    return stats.feature_moments(t["long_missing"], LONG).select("feature_id", "variance")


@query("feature_std", f"SELECT feature_id, std FROM ({RATES})", "std")
def _(t):
    return stats.feature_moments(t["long_missing"], LONG).select("feature_id", "std")


@query("feature_target_corr", CORR, "corr")
def _(t):
    return stats.feature_target_corr(with_target(t), LONG, "target")


@query("feature_target_corr_spearman", f"""
    SELECT feature_id, corr(rx, ry) AS corr FROM (
        SELECT feature_id, rank() OVER (PARTITION BY feature_id ORDER BY value) + (count(*) OVER (PARTITION BY feature_id, value) - 1) / 2 AS rx,
               rank() OVER (PARTITION BY feature_id ORDER BY target) + (count(*) OVER (PARTITION BY feature_id, target) - 1) / 2 AS ry
        FROM {TARGET} WHERE value IS NOT NULL) GROUP BY feature_id""", "corr")
def _(t):
    return stats.spearman_target_corr(with_target(t), "feature_id", "value", "target")


@query("feature_quantiles", """
    SELECT feature_id, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.5) AS median, quantile_disc(value, 0.75) AS q3
    FROM {long_missing} GROUP BY feature_id""", "q1 median q3")
def _(t):
    return stats.feature_quantiles(t["long_missing"], LONG)


@query("normalization_stats", """
    SELECT feature_id, avg(v) AS mean, stddev_samp(v) AS std, quantile_disc(v, 0.5) AS median
    FROM (SELECT feature_id, log2(value + 1) AS v FROM {long_missing}) GROUP BY feature_id""", "mean std median")
def _(t):
    return normalization_stats(t["long_missing"], LONG)


@query("count_subjects", "SELECT count(DISTINCT (site, orig_id)) AS n_subjects FROM {metadata}")
def _(t):
    return stats.count_subjects(t["metadata"])


FLAGS = impute.BINARY_COLUMNS
AGREED = "CASE WHEN count(DISTINCT {0}) = 1 AND min({0}) IN (0, 1) THEN min({0}) END AS {0}"


@query("subject_fill_value", f"SELECT site, orig_id, {', '.join(AGREED.format(c) for c in FLAGS)} FROM {{metadata}} GROUP BY site, orig_id")
def _(t):
    return impute.subject_fill(t["metadata"])


@query("duplicate_ids_per_group", """
    SELECT site AS "group", CAST(count(*) - count(DISTINCT subject_id) AS BIGINT) AS n_duplicates FROM {metadata} GROUP BY site""")
def _(t):
    return stats.duplicate_ids_per_group(t["metadata"].withColumnRenamed("site", "group"), "group", "subject_id")


@query("group_counts", "SELECT site, pe_cat, count(*) AS count FROM {metadata} GROUP BY site, pe_cat")
def _(t):
    return stats.group_counts(t["metadata"], "site", "pe_cat")


@query("split_summary", """
    SELECT pe_cat AS dataset_assignment, site, count(*) AS n_samples, count(DISTINCT subject_id) AS n_subjects,
           CAST(sum(sb_new) AS BIGINT) AS n_outcome, sum(sb_new) * 100.0::DOUBLE / count(DISTINCT subject_id) AS outcome_pct
    FROM {metadata} GROUP BY GROUPING SETS ((pe_cat), (pe_cat, site))""", "outcome_pct")
def _(t):
    return stats.split_summary(t["metadata"].withColumnRenamed("pe_cat", "dataset_assignment"), "sb_new")


@query("dataset_characteristics", f"""
    SELECT s.*, f.*, CAST(s.n_samples * f.n_features - (SELECT count(value) FROM {{long_missing}}) AS BIGINT) AS missing_values FROM (
        SELECT count(*) AS n_samples, count(DISTINCT subject_id) AS n_subjects, avg(sb) AS outcome_prevalence,
               count(*) FILTER (healthy_control) AS healthy_control_count, count(*) FILTER (high_risk) AS high_risk_count,
               count(*) FILTER (healthy_control) / count(*) AS healthy_control_proportion, count(*) FILTER (high_risk) / count(*) AS high_risk_proportion
        FROM {FLAGGED}) s, (
        SELECT count(*) AS n_features, avg(m) AS mean_intensity, avg(s) AS std_intensity, min(lo) AS min_intensity, max(hi) AS max_intensity
        FROM (SELECT avg(value) AS m, stddev_samp(value) AS s, min(value) AS lo, max(value) AS hi FROM {{long_missing}} GROUP BY feature_id)) f""",
       "outcome_prevalence healthy_control_proportion high_risk_proportion mean_intensity std_intensity min_intensity max_intensity")
def _(t):
    return stats.dataset_characteristics(t["long_missing"], population_flags(t["curated"], "sb"), "sb", ["healthy_control", "high_risk"])


@query("site_statistics", """
    SELECT a.site, n_samples, mean_intensity, std_intensity FROM (
        SELECT site, avg(m) AS mean_intensity, avg(s) AS std_intensity FROM (
            SELECT site, feature_id, avg(value) AS m, stddev_samp(value) AS s FROM {long} GROUP BY site, feature_id) GROUP BY site) a
    JOIN (SELECT site, count(DISTINCT sample_id) AS n_samples FROM {long} GROUP BY site) b ON a.site = b.site""", "mean_intensity std_intensity")
def _(t):
    return stats.site_statistics(t["long"])


ANY_ALL = f"""SELECT subject_id, bool_and(healthy_control) AS healthy_control, bool_or(high_risk) AS high_risk, bool_or(high_risk_broad) AS high_risk_broad
    FROM {FLAGGED} GROUP BY subject_id"""


@query("subject_any_all", ANY_ALL)
def _(t):
    return stats.subject_any_all(population_flags(t["curated"], "sb"))


@query("subject_flags_join", f"SELECT sample_id, a.* FROM {{curated}} c JOIN ({ANY_ALL}) a ON c.subject_id = a.subject_id")
def _(t):
    flagged = population_flags(t["curated"], "sb")
    return stats.subject_flags_join(flagged).select("sample_id", "subject_id", "healthy_control", "high_risk", "high_risk_broad")


@query("fit_metrics", """
    SELECT group_ AS "group", count(*) AS n_fits, avg(CASE WHEN is_converged THEN 100 ELSE 0 END) AS convergence_rate,
           avg(CASE WHEN p_value IS NOT NULL THEN 100 ELSE 0 END) AS valid_p_rate, avg(CASE WHEN singular_matrix_error THEN 100 ELSE 0 END) AS singular_rate
    FROM {results} GROUP BY group_""", "convergence_rate valid_p_rate singular_rate")
def _(t):
    return stats.fit_metrics(t["results"].withColumnRenamed("group_", "group"), ["group"])


@query("cv_metric_summary", """
    SELECT metric, sum(value) / n AS mean, sqrt(greatest(sum(value * value) / n - (sum(value) / n) * (sum(value) / n), 0)) AS std FROM (
        SELECT event_type AS metric, user_id AS fold, avg(value) AS value FROM {events} GROUP BY event_type, user_id),
        (SELECT count(DISTINCT user_id) AS n FROM {events}) GROUP BY metric, n""", "mean std", 5)
def _(t):
    folds = t["events"].groupBy(F.col("event_type").alias("metric"), F.col("user_id").alias("fold")).agg(F.avg("value").alias("value"))
    return stats.cv_metric_summary(folds)


@query("validate_quality", """
    SELECT 'missing' AS "check", CAST(feature_id AS STRING) AS subject, count(*) FILTER (value IS NULL) / count(*) AS observed, CAST(0.1 AS DOUBLE) AS required
    FROM {long_missing} GROUP BY feature_id HAVING count(*) FILTER (value IS NULL) / count(*) > 0.1
    UNION ALL SELECT 'features', 'all', CAST(count(DISTINCT feature_id) AS DOUBLE), CAST(60 AS DOUBLE) FROM {long_missing} HAVING count(DISTINCT feature_id) < 60""",
       "observed required")
def _(t):
    return stats.validate_quality(t["long_missing"], LONG, min_features=60, sample="sample_id")


@query("five_number_summary", """
    SELECT event_type, min(value) AS min, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
           quantile_cont(value, 0.75) AS q3, max(value) AS max, count(value) AS n FROM {events} GROUP BY event_type""", "min q1 median q3 max")
def _(t):
    return stats.five_number_summary(t["events"], ["event_type"], "value")


@query("histogram", """
    SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) AS INT) AS bin, count(*) AS count,
           min(lo) + least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) * ((min(hi) - min(lo)) / 30) AS left_edge,
           min(lo) + (least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) + 1) * ((min(hi) - min(lo)) / 30) AS right_edge
    FROM {orders}, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM {orders}) GROUP BY least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29)""",
       "left_edge right_edge")
def _(t):
    return stats.histogram(t["orders"], "o_totalprice")


# corrections

def tested(families: str) -> str:
    part = f"PARTITION BY {families}" if families else ""
    return f"""(SELECT *, row_number() OVER ({part} ORDER BY p_value, unique_feature_label) AS rn, count(*) OVER ({part}) AS n
        FROM {{results}} WHERE p_value IS NOT NULL)"""


def bh(families: str) -> str:
    part = f"PARTITION BY {families}" if families else ""
    return f"""(SELECT *, least(min(p_value * n / rn) OVER ({part} ORDER BY rn DESC ROWS UNBOUNDED PRECEDING), 1) AS p_value_corrected
        FROM {tested(families)})"""


PICK = "unique_feature_label, p_value, p_value_corrected, p_value_corrected <= 0.05 AS significant"
PICKED = ["unique_feature_label", "p_value", "p_value_corrected", "significant"]


@query("bh_adjust", f"SELECT {PICK} FROM {bh('')}", "p_value p_value_corrected", 9)
def _(t):
    return multitest.false_discovery(t["results"]).select(*PICKED)


@query("holm_adjust", f"""
    SELECT {PICK} FROM (SELECT *, least(max(p_value * (n - rn + 1)) OVER (ORDER BY rn ROWS UNBOUNDED PRECEDING), 1) AS p_value_corrected
    FROM {tested('')})""", "p_value p_value_corrected", 9)
def _(t):
    return multitest.adjust(t["results"], "holm").select(*PICKED)


@query("bonferroni_adjust", f"SELECT {PICK} FROM (SELECT *, least(p_value * n, 1) AS p_value_corrected FROM {tested('')})", "p_value p_value_corrected", 9)
def _(t):
    return multitest.bonferroni(t["results"]).select(*PICKED)


@query("multitest_by_class", f"SELECT compound_class, {PICK} FROM {bh('compound_class')}", "p_value p_value_corrected", 9)
def _(t):
    return multitest.adjust_by_class(t["results"]).select("compound_class", *PICKED)


@query("multitest_by_group_annotation", f"""
    SELECT group_ AS "group", compound_id IS NOT NULL AS has_id, {PICK} FROM {bh('group_, compound_id IS NOT NULL')}""", "p_value p_value_corrected", 9)
def _(t):
    return multitest.adjust_by_group_annotation(t["results"].withColumnRenamed("group_", "group")).select("group", "has_id", *PICKED)


# top lists and selection

@query("top_n_features", f"SELECT feature_id, variance AS score FROM ({RATES}) ORDER BY variance DESC, feature_id LIMIT 10", "score", 2)
def _(t):
    return select.top_features(select.feature_stats(t["long_missing"], LONG), 10).select("feature_id", "score")


@query("top_variance_subset", f"SELECT feature_id, std AS score FROM ({RATES}) ORDER BY variance DESC, feature_id LIMIT 20", "score")
def _(t):
    wide, names = explore.top_variance_subset(t["long_missing"], select.feature_stats(t["long_missing"], LONG), 20)
    return wide.agg(*[F.stddev(n).alias(n) for n in names]).select(F.explode(F.array(*[
        F.struct(F.lit(int(n[1:])).alias("feature_id"), F.col(n).alias("score")) for n in names])).alias("s")).select("s.*")


@query("top_n_significant", """
    SELECT unique_feature_label, min(p_value_corrected) AS p_value_corrected FROM {corrected} WHERE significant
    GROUP BY unique_feature_label ORDER BY p_value_corrected, unique_feature_label LIMIT 100""", "p_value_corrected", 9)
def _(t):
    return select.top_significant(t["corrected"])


@query("select_by_variance", f"SELECT feature_id, std FROM ({RATES}) WHERE std > 28000", "std")
def _(t):
    return select.keep_by_variance(select.feature_stats(t["long_missing"], LONG), 28000.0 ** 2).select("feature_id", "std")


@query("select_by_correlation", f"SELECT feature_id, corr FROM ({CORR}) WHERE abs(coalesce(corr, 0)) > 0.02", "corr")
def _(t):
    return select.keep_by_correlation(select.feature_stats(with_target(t), LONG, "target"), 0.02).select("feature_id", "corr")


@query("select_by_missing", f"SELECT feature_id, missing_rate FROM ({RATES}) WHERE missing_rate <= 0.1", "missing_rate")
def _(t):
    return select.keep_by_missing(select.feature_stats(t["long_missing"], LONG)).select("feature_id", "missing_rate")


@query("select_by_significance", """
    SELECT unique_feature_label FROM {annotation} WHERE unique_feature_label IN (SELECT unique_feature_label FROM {corrected} WHERE p_value_corrected < 0.05)""")
def _(t):
    return select.keep_by_significance(t["annotation"].select("unique_feature_label"), t["corrected"], feature="unique_feature_label")


@query("filter_significant", "SELECT unique_feature_label, p_value_corrected FROM {corrected} WHERE p_value_corrected <= 0.05", "p_value_corrected", 9)
def _(t):
    return select.filter_significant(t["corrected"]).select("unique_feature_label", "p_value_corrected")


STEPS = f"""SELECT r.feature_id, missing_rate <= 0.1 AS a, variance > 780000000 AS b, abs(coalesce(corr, 0)) > 0.01 AS c,
    EXISTS (SELECT 1 FROM {{corrected}} x WHERE x.unique_feature_label = concat('F', CAST(r.feature_id AS STRING)) AND x.p_value_corrected < 0.9) AS d, variance
    FROM ({RATES}) r JOIN ({CORR}) k ON r.feature_id = k.feature_id"""


def comprehensive(t):
    criteria = select.Criteria(variance=780000000.0, correlation=0.01, p_value=0.9, max_features=5)
    results = t["corrected"].withColumn("feature_id", F.substring("unique_feature_label", 2, 18).cast("long"))
    return select.select_comprehensive(with_target(t), LONG, criteria, "target", results, result_feature="feature_id")


@query("select_comprehensive", f"SELECT feature_id FROM ({STEPS}) WHERE a AND b AND c AND d ORDER BY variance DESC, feature_id LIMIT 5")
def _(t):
    return comprehensive(t)[0].select("feature_id")


@query("select_comprehensive_counts", f"""
    SELECT i AS step_no, step, n AS n_features, n / total AS ratio FROM (
        SELECT unnest([0, 1, 2, 3, 4, 5]) AS i, unnest(['original', 'missing', 'variance', 'correlation', 'significance', 'final']) AS step,
               unnest([count(*), count(*) FILTER (a), count(*) FILTER (a AND b), count(*) FILTER (a AND b AND c), count(*) FILTER (a AND b AND c AND d),
                       least(count(*) FILTER (a AND b AND c AND d), 5)]) AS n, count(*) AS total FROM ({STEPS}))""", "ratio")
def _(t):
    return comprehensive(t)[1]


@query("select_by_criteria", """
    SELECT DISTINCT unique_feature_label FROM {corrected}
    WHERE p_value_corrected <= 0.05 AND abs(estimate) >= 0.1 AND compound_id IS NOT NULL AND n_observations >= 50""")
def _(t):
    return select.select_by_criteria(t["corrected"], 0.05, 0.1, True, 50)


@query("select_user_list", "SELECT DISTINCT unique_feature_label FROM {annotation} WHERE unique_feature_label IN (SELECT unique_feature_label FROM {results})")
def _(t):
    return select.select_user_list(t["results"], t["annotation"], "unique_feature_label")


@query("select_auto", """
    SELECT unique_feature_label FROM {corrected} WHERE significant
    GROUP BY unique_feature_label ORDER BY min(p_value_corrected), unique_feature_label LIMIT 100""")
def _(t):
    return select.select_auto(t["corrected"])


@query("select_auto_balanced", """
    SELECT unique_feature_label, compound_class, p_value_corrected FROM (
        SELECT *, compound_id IS NULL AS plain, row_number() OVER (PARTITION BY compound_class ORDER BY compound_id IS NULL, p_value_corrected, unique_feature_label) AS rn
        FROM {corrected} WHERE p_value_corrected <= 0.05) ORDER BY rn, plain, p_value_corrected, unique_feature_label LIMIT 40""", "p_value_corrected", 9)
def _(t):
    return select.select_auto_balanced(t["corrected"], 40)


@query("load_new_results", """
    SELECT unique_feature_label, "group", compound_id, compound_class, estimate AS estimate_new, p_value AS p_value_new,
           p_value_corrected AS p_value_corrected_new FROM {corrected} WHERE significant""", "estimate_new p_value_new p_value_corrected_new")
def _(t):
    return select.load_new_results(t["corrected"])
