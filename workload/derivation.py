"""Sources, sinks, projections, derived columns and predicates."""

import hashlib
import os

from pyspark.sql import functions as F

from cohortmill.functions.relate import shared_folder
from cohortmill.operators import derive as d
from cohortmill.sources import inventory, tables

from .registry import query


def scratch(t, name: str) -> str:
    """A folder for written tables: beside the session's checkpoints, else in its warehouse."""
    base = shared_folder(t.spark)
    tag = hashlib.md5(t.folder.encode()).hexdigest()[:8]
    return f"{base}/written-{t.spark.sparkContext.applicationId}-{os.getpid()}/{tag}-{name}"


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {customer}", "c_acctbal")
def _(t):
    path = tables.write_table(t["customer"], scratch(t, "scan_csv"), "csv")
    return tables.read_table(t.spark, path, "csv", t["customer"].schema)


@query("scan_columnar", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM {lineitem}
    WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""", "quantity")
def _(t):
    rows = tables.read_table(t.spark, f"{t.folder}/lineitem.parquet")
    return rows.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz")) \
        .groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("multi_site_union_scan", """
    SELECT o_orderkey AS sample_id, o_custkey AS subject_id, o_totalprice AS intensity, NULL AS note, 'orders' AS site FROM {orders}
    UNION ALL SELECT l_orderkey, NULL, l_extendedprice, l_returnflag, 'lineitem' FROM {lineitem}""", "intensity")
def _(t):
    orders = t["orders"].select(F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("subject_id"), F.col("o_totalprice").alias("intensity"))
    lines = t["lineitem"].select(F.col("l_extendedprice").alias("intensity"), F.col("l_returnflag").alias("note"), F.col("l_orderkey").alias("sample_id"))
    return tables.union_sites({"orders": orders, "lineitem": lines})


@query("sink_overwrite", "SELECT sample_id, feature_id, site, value FROM {long}", "value")
def _(t):
    path = scratch(t, "sink_overwrite")
    tables.write_table(t["nation"], path)
    tables.write_table(t["long"].select("sample_id", "feature_id", "site", "value"), path, partition_by=["site"])
    return tables.read_table(t.spark, path)


@query("sink_csv", "SELECT sample_id, pe_cat, birth_weight FROM {metadata}", "birth_weight")
def _(t):
    kept = t["metadata"].select("sample_id", "pe_cat", "birth_weight")
    return tables.read_table(t.spark, tables.write_table(kept, scratch(t, "sink_csv"), "csv"), "csv", kept.schema)


@query("sink_text_list", "SELECT DISTINCT unique_feature_label FROM {results}")
def _(t):
    names = t["results"].select("unique_feature_label").distinct()
    return tables.read_list(t.spark, tables.write_list(names, scratch(t, "sink_text_list"), "unique_feature_label"), "unique_feature_label")


URL_RULES = [((".com/",), "commercial"), ((".org/", ".net/"), "network"), (("example",), "example")]


@query("path_inventory", """
    SELECT page_id, CASE WHEN lower(url) LIKE '%.com/%' THEN 'commercial'
                         WHEN lower(url) LIKE '%.org/%' OR lower(url) LIKE '%.net/%' THEN 'network'
                         WHEN lower(url) LIKE '%example%' THEN 'example' ELSE 'other' END AS kind,
           CASE WHEN lower(text_) LIKE '%meta_data%' OR lower(text_) LIKE '%metadata%' OR lower(text_) LIKE '%manifest%' THEN 'metadata'
                WHEN lower(text_) LIKE '%preprocessed_maternal_data%' OR lower(text_) LIKE '%intensities%' OR lower(text_) LIKE '%intensity_data%' THEN 'intensity_data'
                WHEN lower(text_) LIKE '%regression_analysis%' OR lower(text_) LIKE '%analysis_results%' THEN 'analysis_result'
                WHEN lower(text_) LIKE '%deliverables%' THEN 'deliverable'
                WHEN lower(text_) LIKE '%alignment%' THEN 'alignment_data' ELSE 'other' END AS data_type,
           CASE WHEN url LIKE 's3://%' THEN 's3' ELSE 'local' END AS data_source
    FROM (SELECT *, concat(CASE page_id % 5 WHEN 0 THEN 'Sites.Intensities.' WHEN 1 THEN 'paths.METADATA.' WHEN 2 THEN 'deliverables.'
                                            WHEN 3 THEN 'alignment.' ELSE 'x.' END, url) AS text_ FROM {pages}) x""")
def _(t):
    heads = F.array(*[F.lit(h) for h in ("Sites.Intensities.", "paths.METADATA.", "deliverables.", "alignment.", "x.")])
    described = t["pages"].withColumn("text", F.concat(heads[(F.col("page_id") % 5).cast("int")], "url"))
    kinds = inventory.path_inventory(described, {"kind": (URL_RULES, "other")}, description="url", path="url")
    return inventory.path_inventory(kinds, {"data_type": (inventory.DATA_TYPES, "other")}, description="text", path="url").select(
        "page_id", "kind", "data_type", "data_source")


@query("normalize_column_names", """
    SELECT o_orderkey AS orig_id, o_orderdate AS visitdt, o_orderstatus AS sample_type FROM {orders}""")
def _(t):
    raw = t["orders"].select(F.col("o_orderkey").alias("Orig_ID"), F.col("o_orderdate").alias("VISIT_DT"),
                             F.col("o_orderstatus").alias("SAMPLE_TYPE"), F.col("o_totalprice").alias("Unnamed: 3"))
    return d.normalize_column_names(raw, {"VISIT_DT": "VISITDT"})


@query("trim_cast_key", "SELECT c_custkey, trim(concat('  ', CAST(c_custkey AS STRING), ' ')) AS orig_id FROM {customer}")
def _(t):
    padded = t["customer"].select("c_custkey", F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("orig_id"))
    return d.trim_key(padded, "orig_id")


@query("parse_day_month_year", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS visitdt FROM {orders}")
def _(t):
    text = F.upper(F.date_format("o_orderdate", "ddMMMyyyy"))
    return t["orders"].select("o_orderkey", d.parse_date(text).alias("visitdt"))


@query("split_prefix", "SELECT c_custkey, split_part(concat(c_mktsegment, '-', CAST(c_custkey AS STRING)), '-', 1) AS site FROM {customer}")
def _(t):
    return t["customer"].select("c_custkey", d.split_prefix(F.concat("c_mktsegment", F.lit("-"), "c_custkey")).alias("site"))


@query("split_suffix_conditional", """
    SELECT site, CASE WHEN site = 3 THEN regexp_replace(feature_label, '^.*_', '') ELSE feature_label END AS feature_label,
           unique_feature_label FROM {alignment}""")
def _(t):
    return t["alignment"].withColumn("feature_label", d.split_suffix_where("feature_label", F.col("site") == 3))


@query("derive_flags", """
    SELECT sample_id, coalesce(very_ptb = 1, false) OR coalesce(ext_ptb = 1, false) AS severe_ptb,
           pe_cat = 'EOPE' AS eope, pe_cat = 'LOPE' AS lope FROM {metadata}""")
def _(t):
    return d.derive_flags(t["metadata"]).select("sample_id", "severe_ptb", "eope", "lope")


@query("outcome_columns", """
    SELECT sample_id, CASE WHEN pe_new = 1 AND pe_cat = 'EOPE' THEN 1 ELSE 0 END AS eope,
           CASE WHEN pe_priority IN (1, 2) AND pe_cat = 'LOPE' THEN 1 ELSE 0 END AS lope FROM {metadata}""")
def _(t):
    return d.outcome_column(d.outcome_column(t["metadata"], "eope"), "lope", by_priority=True).select("sample_id", "eope", "lope")


@query("exclude_value", "SELECT sample_id, sb_priority FROM {metadata} WHERE sb_priority IS DISTINCT FROM 3")
def _(t):
    return d.exclude_value(t["metadata"], "sb_priority", 3).select("sample_id", "sb_priority")


@query("negative_to_null", """
    SELECT sample_id, site, CASE WHEN pw_age >= 0 THEN pw_age END AS pw_age, CASE WHEN birth_weight >= 0 THEN birth_weight END AS birth_weight,
           CASE WHEN birth_outcome >= 0 THEN birth_outcome END AS birth_outcome FROM {metadata}""", "pw_age birth_weight")
def _(t):
    return d.negative_to_null(t["metadata"].select("sample_id", "site", "pw_age", "birth_weight", "birth_outcome"))


@query("derived_fields", """
    SELECT sample_id, CAST(floor((ga_hdlk_new + 6) / 7) AS BIGINT) AS ga_weeks, CAST(floor((gagebrth_new + 6) / 7) AS BIGINT) AS gagebrth_weeks,
           mat_weight / nullif((mat_height / 100) * (mat_height / 100), 0) AS bmi FROM {metadata}""", "bmi")
def _(t):
    return d.derived_fields(t["metadata"]).select("sample_id", "ga_weeks", "gagebrth_weeks", "bmi")


@query("rename_map", """
    SELECT sample_id, ga_hdlk_new AS ga_sample_days, gagebrth_new AS ga_birth_days, pw_age AS maternal_age, chron_htn AS chronic_hypertension,
           cong_anomalies AS congenital_anomalies, smoke_hist AS smoking_history, parity AS n_previous_pregnancies, passive_smok AS smoking_exposure,
           prev_sb AS n_previous_stillbirth, prev_mis AS n_previous_miscarriage, alcohol AS alcohol_history, sniff_toba AS tobacco_history,
           tb AS tuberculosis, wealth_index FROM {metadata}""")
def _(t):
    raw = ["sample_id", *d.CURATED_NAMES, "wealth_index"]
    return d.rename_map(t["metadata"].select(*raw))


@query("select_available", "SELECT sample_id, site, pw_age FROM {metadata}")
def _(t):
    return d.select_available(t["metadata"], ["sample_id", "absent_column", "site", "pw_age"])


@query("compose_label", """
    SELECT unique_feature_label, CASE WHEN compound_id IS NOT NULL THEN concat(unique_feature_label, chr(10), compound_id)
                                      ELSE unique_feature_label END AS unique_feature_name FROM {results}""")
def _(t):
    return t["results"].select("unique_feature_label", d.compose_label("unique_feature_label", "compound_id").alias("unique_feature_name"))


@query("eligibility_filter", """
    SELECT sample_id FROM {metadata} WHERE single_twin = 1 AND gagebrth_new IS NOT NULL AND ga_hdlk_new IS NOT NULL AND pw_age IS NOT NULL""")
def _(t):
    return d.eligible(t["metadata"]).select("sample_id")


HEALTHY = """coalesce(sb = 0 AND ga_birth_days >= 273 AND ga_birth_days < 287 AND birth_weight >= 2500
    AND chronic_hypertension IS DISTINCT FROM 1 AND diabetes IS DISTINCT FROM 1 AND fetal_anomalies IS DISTINCT FROM 1
    AND congenital_anomalies IS DISTINCT FROM 1 AND syphilis IS DISTINCT FROM 1 AND syphilis IS DISTINCT FROM 2
    AND hiv IS DISTINCT FROM 1 AND malaria IS DISTINCT FROM 1 AND tuberculosis IS DISTINCT FROM 1, false)"""
RISK = """coalesce(maternal_age >= 35, false) OR smoking_history IN (2, 3, 4) OR alcohol_history IN (2, 3, 4)
    OR coalesce(chronic_hypertension = 1, false) OR coalesce(diabetes = 1, false) OR coalesce(syphilis IN (1, 2), false)
    OR coalesce(hiv = 1, false) OR coalesce(malaria = 1, false) OR coalesce(tuberculosis = 1, false) OR coalesce(bmi >= 30, false)"""
BROAD = f"""{RISK} OR n_previous_pregnancies = 0 OR smoking_exposure = 1 OR n_previous_miscarriage > 0
    OR n_previous_stillbirth > 0 OR wealth_index IN (1, 2)"""
FLAGGED = f"(SELECT *, {HEALTHY} AS healthy_control, {RISK} AS high_risk, {BROAD} AS high_risk_broad FROM {{curated}})"


@query("healthy_control_flag", f"SELECT sample_id, {HEALTHY} AS healthy_control FROM {{curated}}")
def _(t):
    return t["curated"].select("sample_id", d.healthy_control("sb").alias("healthy_control"))


@query("high_risk_flag", f"SELECT sample_id, {RISK} AS high_risk FROM {{curated}}")
def _(t):
    return t["curated"].select("sample_id", d.high_risk().alias("high_risk"))


@query("high_risk_broad_flag", f"SELECT sample_id, {BROAD} AS high_risk_broad FROM {{curated}}")
def _(t):
    return t["curated"].select("sample_id", d.high_risk_broad().alias("high_risk_broad"))


@query("close_to_event_exclusion", """
    SELECT sample_id, ga_sample_days FROM {curated} WHERE NOT coalesce(ga_sample_days >= ga_birth_days - 14, false)""")
def _(t):
    return d.drop_close_to_event(t["curated"]).select("sample_id", "ga_sample_days")


@query("time_window_filter", "SELECT sample_id, ga_sample_days FROM {curated} WHERE ga_sample_days BETWEEN 63 AND 183")
def _(t):
    return d.time_window(t["curated"]).select("sample_id", "ga_sample_days")


@query("population_filter", f"SELECT sample_id FROM {FLAGGED} x WHERE high_risk_broad")
def _(t):
    return d.population(d.population_flags(t["curated"], "sb"), "high_risk_broad").select("sample_id")


@query("holdout_filter", "SELECT o_orderkey, o_orderpriority AS dataset_assignment FROM {orders} WHERE o_orderpriority <> '5-LOW'")
def _(t):
    labelled = t["orders"].select("o_orderkey", F.col("o_orderpriority").alias("dataset_assignment"))
    return d.holdout(labelled, name="5-LOW")


@query("query_string_filter", "SELECT sample_id FROM {metadata} WHERE pe_new = 1 AND pe_cat = 'EOPE' AND pe_priority IN (1, 2)")
def _(t):
    rule = d.OUTCOMES["eope"]
    return d.where_text(d.where_text(t["metadata"], rule["case"]), rule["priority"]).select("sample_id")
