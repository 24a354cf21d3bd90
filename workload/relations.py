"""Joins and feature-set algebra."""

from pyspark.sql import functions as F

from cohortmill.operators import derive, impute, joins, select
from cohortmill.operators.stats import comparison_summary

from .registry import query

PLASMA = "sample_type = 'Maternal Plasma' AND note IS DISTINCT FROM 'Duplicate-remove'"


def manifest(t):
    kept = t["manifest"].where(F.col("sample_type") == "Maternal Plasma")
    return derive.exclude_value(kept, "note", "Duplicate-remove")


@query("join_manifest_inner", f"""
    SELECT m.site, m.orig_id, m.visitdt, m.pe_cat, n.sample_id
    FROM {{metadata}} m JOIN (SELECT * FROM {{manifest}} WHERE {PLASMA}) n
      ON m.site = n.site AND m.orig_id = n.orig_id AND m.visitdt = n.visitdt""")
def _(t):
    return joins.with_manifest(t["metadata"].select("site", "orig_id", "visitdt", "pe_cat"), manifest(t))


FLAGS = impute.BINARY_COLUMNS
AGREED = "CASE WHEN count(DISTINCT {0}) = 1 AND min({0}) IN (0, 1) THEN min({0}) END AS {0}_fill"


@query("join_fill_values", f"""
    SELECT m.sample_id, {', '.join(f'm.{c}, f.{c}_fill' for c in FLAGS)} FROM {{metadata}} m JOIN (
        SELECT site, orig_id, {', '.join(AGREED.format(c) for c in FLAGS)}
        FROM {{metadata}} GROUP BY site, orig_id) f ON m.site = f.site AND m.orig_id = f.orig_id""")
def _(t):
    fills = impute.subject_fill(t["metadata"]).withColumnsRenamed({c: f"{c}_fill" for c in FLAGS})
    return t["metadata"].select("sample_id", "site", "orig_id", *FLAGS).join(fills, ["site", "orig_id"]).select("sample_id", *[x for c in FLAGS for x in (c, f"{c}_fill")])


CLEAN_ALIGNMENT = """(SELECT site, CASE WHEN site = 3 THEN regexp_replace(feature_label, '^.*_', '') ELSE feature_label END AS feature_label,
    unique_feature_label FROM {alignment})"""


def aligned(t):
    cleaned = t["alignment"].withColumn("feature_label", derive.split_suffix_where("feature_label", F.col("site") == 3))
    return joins.with_alignment(t["intensity"], cleaned)


@query("join_alignment", f"""
    SELECT i.sample_id, i.site, a.unique_feature_label, i.intensity_fill_log_scaled
    FROM {{intensity}} i JOIN {CLEAN_ALIGNMENT} a ON i.site = a.site AND i.feature_label = a.feature_label""", "intensity_fill_log_scaled")
def _(t):
    return aligned(t).select("sample_id", "site", "unique_feature_label", "intensity_fill_log_scaled")


@query("join_cohort_intensity", """
    SELECT c.sample_id, c."group", l.feature_id, l.value FROM (
        SELECT sample_id, 'all' AS "group" FROM {metadata} UNION ALL
        SELECT sample_id, 'affected' FROM {metadata} WHERE sb_new = 1) c JOIN {long} l ON c.sample_id = l.sample_id""", "value")
def _(t):
    everyone = t["metadata"].select("sample_id", F.lit("all").alias("group"))
    affected = t["metadata"].where("sb_new = 1").select("sample_id", F.lit("affected").alias("group"))
    return joins.with_cohort(everyone.unionByName(affected), t["long"]).select("sample_id", "group", "feature_id", "value")


@query("join_annotation_left", """
    SELECT r.feature_label AS unique_feature_label, r.n, a.compound_id, a.compound_class
    FROM (SELECT concat('F', substr(feature_label, 2)) AS feature_label, count(*) AS n FROM {intensity} GROUP BY feature_label) r
    LEFT JOIN {annotation} a ON r.feature_label = a.unique_feature_label""")
def _(t):
    counted = t["intensity"].groupBy(F.concat(F.lit("F"), F.substring("feature_label", 2, 9)).alias("unique_feature_label")).agg(F.count(F.lit(1)).alias("n"))
    return joins.with_annotation(counted, t["annotation"])


NEW = """(SELECT unique_feature_label, "group", compound_id, compound_class, estimate AS estimate_new, p_value AS p_value_new,
    p_value_corrected AS p_value_corrected_new FROM {corrected} WHERE significant)"""
OLD = """(SELECT unique_feature_label, lower(array_to_string((string_split("group", '_'))[3:], '_')) AS "group",
    Coefficient_Intensity AS estimate_old, p_value AS p_value_old, FDR AS p_value_corrected_old FROM {previous} WHERE analysis = 'pooled')"""
COMPARED = f"""(SELECT coalesce(n.unique_feature_label, o.unique_feature_label) AS unique_feature_label, coalesce(n."group", o."group") AS "group",
    n.compound_id, n.compound_class, n.estimate_new, n.p_value_new, n.p_value_corrected_new, o.estimate_old, o.p_value_old, o.p_value_corrected_old,
    o.unique_feature_label IS NULL AS sig_only_in_new, n.unique_feature_label IS NULL AS sig_only_in_old,
    n.unique_feature_label IS NOT NULL AND o.unique_feature_label IS NOT NULL AS sig_in_both
    FROM {NEW} n FULL OUTER JOIN {OLD} o ON n.unique_feature_label = o.unique_feature_label AND n."group" = o."group")"""
ESTIMATES = "estimate_new p_value_new p_value_corrected_new estimate_old p_value_old p_value_corrected_old"


def compared(t):
    return joins.compare_results(select.load_new_results(t["corrected"]), select.load_previous_results(t["previous"]))


@query("compare_full_outer", f"SELECT * FROM {COMPARED}", ESTIMATES)
def _(t):
    return compared(t)


@query("load_previous_results", f"SELECT * FROM {OLD}", "estimate_old p_value_old p_value_corrected_old")
def _(t):
    return select.load_previous_results(t["previous"])


@query("comparison_summary", f"SELECT sig_only_in_new, sig_only_in_old, sig_in_both, count(*) AS count FROM {COMPARED} GROUP BY ALL")
def _(t):
    return comparison_summary(compared(t))


@query("comparison_summary_by_group", f"""
    SELECT "group", sig_only_in_new, sig_only_in_old, sig_in_both, count(*) AS count FROM {COMPARED} GROUP BY ALL""")
def _(t):
    return comparison_summary(compared(t), by_group=True)


@query("notable_features", f"""
    SELECT unique_feature_label, "group", compound_id, p_value_corrected_new FROM {COMPARED} WHERE sig_in_both AND compound_id IS NOT NULL
    ORDER BY p_value_corrected_new, unique_feature_label, "group" LIMIT 10""", "p_value_corrected_new")
def _(t):
    return select.notable_features(compared(t), "sb").select("unique_feature_label", "group", "compound_id", "p_value_corrected_new")


@query("notable_features_by_pattern", f"""
    SELECT unique_feature_label, "group", compound_id, p_value_corrected_new FROM {COMPARED}
    WHERE sig_in_both AND compound_id IS NOT NULL AND lower(compound_id) LIKE '%ring%'""", "p_value_corrected_new")
def _(t):
    return select.notable_features(compared(t), "sb", patterns={"sb": "RING"}).select("unique_feature_label", "group", "compound_id", "p_value_corrected_new")


@query("semi_join_samples", """
    SELECT 'metadata' AS side, count(*) AS n, sum(sample_id)::BIGINT AS checksum FROM {metadata} WHERE sample_id IN (SELECT sample_id FROM {long})
    UNION ALL SELECT 'intensity', count(*), sum(sample_id)::BIGINT FROM {long} WHERE sample_id IN (SELECT sample_id FROM {metadata} )""")
def _(t):
    left, right = joins.keep_matching(t["metadata"], t["long"])
    return left.select(F.lit("metadata").alias("side"), "sample_id").unionByName(right.select(F.lit("intensity").alias("side"), "sample_id")) \
        .groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("sample_id").alias("checksum"))


@query("validate_ids", """
    SELECT r.unique_feature_label, a.unique_feature_label IS NOT NULL AS valid FROM (SELECT unique_feature_label FROM {results}) r
    LEFT JOIN (SELECT DISTINCT unique_feature_label FROM {annotation}) a ON r.unique_feature_label = a.unique_feature_label""")
def _(t):
    return joins.validate_ids(t["results"].select("unique_feature_label"), t["annotation"], "unique_feature_label")


def set_of(t, group):
    return t["corrected"].where((F.col("group") == group) & (F.col("p_value") < 0.5)).select("compound_class")


SET_A = """SELECT compound_class FROM {corrected} WHERE "group" = 'sb_control_lt20' AND p_value < 0.5"""
SET_B = """SELECT compound_class FROM {corrected} WHERE "group" = 'sb_noncase_gte20' AND p_value < 0.5"""


@query("feature_set_intersect", f"{SET_A} INTERSECT {SET_B}")
def _(t):
    return select.feature_set_intersect(set_of(t, "sb_control_lt20"), set_of(t, "sb_noncase_gte20"))


@query("feature_set_union", f"{SET_A} UNION {SET_B}")
def _(t):
    return select.feature_set_union(set_of(t, "sb_control_lt20"), set_of(t, "sb_noncase_gte20"))


@query("feature_set_except", "SELECT unique_feature_label FROM {results} EXCEPT SELECT unique_feature_label FROM {annotation}")
def _(t):
    return select.feature_set_except(t["results"].select("unique_feature_label"), t["annotation"].select("unique_feature_label"))


@query("load_all_results", """
    SELECT unique_feature_label, p_value, split_part("group", '_', 3) AS strata, split_part("group", '_', 2) AS group_type FROM {corrected}""", "p_value")
def _(t):
    parts = {(s, k): t["corrected"].where(F.col("group") == f"sb_{k}_{s}").select("unique_feature_label", "p_value")
             for s in ("lt20", "gte20") for k in ("control", "noncase")}
    return select.load_all_results(parts)
