"""Regressions per feature, the discovery scan and its report data."""

from pyspark.sql import functions as F

from cohortmill.operators import assoc, cohort, joins, normalize, select
from cohortmill.operators.layout import Long
from cohortmill.operators.multitest import adjust

from .cohorts import grouped
from .registry import query
from .relations import aligned


def modelled(t):
    """Long table with 0/1 outcome and covariates per sample."""
    per_sample = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("sample_id"), (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("outcome"),
        (F.col("c_acctbal") / 1000).alias("balance"), (F.col("o_totalprice") / 100000).alias("total"))
    return t["long"].join(per_sample, "sample_id")


@query("association_scan")
def _(t):
    """The flagship: logs centred per site, a model per feature, corrected, best features first."""
    centred = normalize.center_median(modelled(t), Long(), ["site"])
    fits = assoc.logit_by_feature(centred, "outcome", "log2_value", ["balance", "total"], ["site"], ["feature_id"])
    corrected = adjust(assoc.valid_results(fits))
    return select.top_significant(corrected, 20, significant_only=False, feature="feature_id")


@query("logit_by_feature")
def _(t):
    return assoc.logit_by_feature(modelled(t).withColumn("x", F.ln("value")), "outcome", "x", ["balance", "total"], ["site"], ["feature_id"])


@query("logit_by_feature_sums")
def _(t):
    """The same models with every key in many units, whose sums meet in each step."""
    return assoc.logit_by_feature(modelled(t).withColumn("x", F.ln("value")), "outcome", "x", ["balance", "total"], ["site"], ["feature_id"], unit_rows=200)


TABLE2X2 = """(SELECT feature_id, CAST(count(*) FILTER (x AND y) AS DOUBLE) AS a, CAST(count(*) FILTER (x AND NOT y) AS DOUBLE) AS b,
    CAST(count(*) FILTER (NOT x AND y) AS DOUBLE) AS c, CAST(count(*) FILTER (NOT x AND NOT y) AS DOUBLE) AS d, count(*) AS n FROM (
        SELECT feature_id, value > 50000 AS x, o_orderpriority = '1-URGENT' AS y FROM {long} JOIN {orders} ON sample_id = o_orderkey) GROUP BY feature_id)"""
CLOSED = f"""SELECT feature_id, ln((a * d) / (b * c)) AS estimate, sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS std_error,
    ln((a * d) / (b * c)) - 1.96 * sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS ci_lower, ln((a * d) / (b * c)) + 1.96 * sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS ci_upper,
    a * ln(a / (a + b)) + b * ln(b / (a + b)) + c * ln(c / (c + d)) + d * ln(d / (c + d)) AS log_likelihood,
    (a + c) * ln((a + c) / n) + (b + d) * ln((b + d) / n) AS null_log_likelihood, n AS n_observations, true AS is_converged FROM {TABLE2X2}"""
CLOSED_COLUMNS = ["feature_id", "estimate", "std_error", "ci_lower", "ci_upper", "log_likelihood", "null_log_likelihood", "n_observations", "is_converged"]
CLOSED_DOUBLES = " ".join(CLOSED_COLUMNS[1:7])


def binary(t, unit_rows=65_536):
    rows = modelled(t).withColumn("x", (F.col("value") > 50000).cast("int"))
    return assoc.logit_by_feature(rows, "outcome", "x", keys=["feature_id"], unit_rows=unit_rows).select(*CLOSED_COLUMNS)


@query("logit_by_feature_binary", CLOSED, CLOSED_DOUBLES)
def _(t):
    return binary(t)


@query("logit_by_feature_binary_sums", CLOSED, CLOSED_DOUBLES)
def _(t):
    return binary(t, 200)


@query("logit_global", """
    SELECT 'x' AS term, ln((a * d) / (b * c)) AS estimate, sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS std_error FROM (
        SELECT CAST(count(*) FILTER (x AND y) AS DOUBLE) AS a, CAST(count(*) FILTER (x AND NOT y) AS DOUBLE) AS b,
               CAST(count(*) FILTER (NOT x AND y) AS DOUBLE) AS c, CAST(count(*) FILTER (NOT x AND NOT y) AS DOUBLE) AS d FROM (
            SELECT value > 50000 AS x, o_orderpriority = '1-URGENT' AS y FROM {long} JOIN {orders} ON sample_id = o_orderkey))""", "estimate std_error")
def _(t):
    rows = modelled(t).withColumn("x", (F.col("value") > 50000).cast("int"))
    return assoc.logit_global(rows, "outcome", ["x"]).where("term = 'x'").drop("p_value")


@query("discovery_scan")
def _(t):
    labelled = cohort.analyses(grouped(t), "sb")
    rows = joins.with_cohort(labelled.select("sample_id", "analysis", F.col("sb_new").alias("sb"), "pw_age", "ga_weeks", "site"),
                             aligned(t).select("sample_id", "unique_feature_label", "intensity_fill_log_scaled"))
    return assoc.discovery_scan(rows, t["annotation"], "sb")


@query("volcano_points", """
    SELECT unique_feature_label, estimate, -log10(greatest(p_value, 1e-300)) AS neg_log10_p, p_value < 0.05 AND abs(estimate) > 0.5 AS significant
    FROM {results} WHERE p_value IS NOT NULL AND estimate IS NOT NULL""", "estimate neg_log10_p")
def _(t):
    return assoc.volcano_points(t["results"]).select("unique_feature_label", "estimate", "neg_log10_p", "significant")
