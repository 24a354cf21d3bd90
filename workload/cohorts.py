"""Cohorts, strata, splits, shapes and datasets."""

from pyspark.sql import functions as F

from cohortmill.functions.relate import first_per_key
from cohortmill.operators import cohort, derive, joins, shapes, stats

from .registry import query
from .relations import CLEAN_ALIGNMENT, aligned

STEPS = ["single_twin = 1", "ga_hdlk_new IS NOT NULL", "pw_age IS NOT NULL AND pw_age NOT IN (-77, -88, -99)",
         "birth_outcome IS NOT NULL AND birth_outcome NOT IN (-77, -88)", "sb_priority IS DISTINCT FROM 3"]
CONTROL = ["gagebrth_new > 273 AND gagebrth_new <= 287", "birth_weight >= 2500", "chron_htn IS DISTINCT FROM 1", "diabetes IS DISTINCT FROM 1",
           "fetal_anomalies IS DISTINCT FROM 1 AND cong_anomalies IS DISTINCT FROM 1",
           "syphilis IS DISTINCT FROM 1 AND hiv IS DISTINCT FROM 1 AND malaria IS DISTINCT FROM 1 AND tb IS DISTINCT FROM 1"]
NAMES = ["single birth", "known gestational age", "known maternal age", "known birth outcome", "outcome priority below 3"]
CONTROL_NAMES = ["term birth", "normal birth weight", "no chronic hypertension", "no diabetes", "no anomalies", "no infection"]


def steps_sql(source: str, names, conditions, extra: str = "") -> str:
    parts = []
    for i, name in enumerate(["all", *names]):
        where = " AND ".join(["true", *conditions[:i]])
        parts.append(f"SELECT {i} AS step_no, '{name}' AS step, count(DISTINCT (site, orig_id)) AS n_subjects{extra} FROM {source} WHERE {where}")
    return " UNION ALL ".join(parts)


@query("attrition_counts", steps_sql("{metadata}", NAMES, STEPS))
def _(t):
    return stats.attrition_counts(t["metadata"], cohort.base_steps("sb"))


ELIGIBLE = f"(SELECT * FROM {{metadata}} WHERE {' AND '.join(STEPS)})"
NONCASE = f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY site, orig_id, visitdt ORDER BY sample_id) AS rn
    FROM {ELIGIBLE} WHERE birth_outcome = 1 AND sb_new = 0) WHERE rn = 1)"""
CASE = f"(SELECT * FROM {ELIGIBLE} WHERE sb_new = 1 AND sb_priority IN (1, 2))"
CONTROLS = f"(SELECT * FROM {NONCASE} WHERE {' AND '.join(CONTROL)})"
ROLES = f"""(SELECT 'case' AS role, * FROM {CASE} UNION ALL SELECT 'noncase', * FROM {NONCASE} UNION ALL SELECT 'control', * FROM {CONTROLS})"""


def parts(t, outcome="sb"):
    return cohort.cohorts(t["metadata"], outcome, ["sample_id"])


def roles(frames, *columns):
    out = None
    for role, df in frames.items():
        named = df.select(F.lit(role).alias("role"), *columns)
        out = named if out is None else out.unionByName(named)
    return out


@query("cohort_flowchart", f"SELECT role, sample_id FROM {ROLES}")
def _(t):
    return roles(parts(t), "sample_id")


@query("cohort_flowchart_counts", " UNION ALL ".join([
    steps_sql("{metadata}", NAMES, STEPS, ", 'eligible' AS stage"),
    steps_sql(NONCASE, CONTROL_NAMES, CONTROL, ", 'control' AS stage"), steps_sql(CASE, [], [], ", 'case' AS stage")]))
def _(t):
    return cohort.cohort_attrition(t["metadata"], "sb", ["sample_id"])


OUTCOME_SQL = {
    "eope": ("pe_new = 1 AND pe_cat = 'EOPE' AND pe_priority IN (1, 2)", "pe_new = 0", 3),
    "lope": ("pe_new = 1 AND pe_cat = 'LOPE' AND pe_priority IN (1, 2)", "pe_new = 0", 3),
    "sb": ("sb_new = 1 AND sb_priority IN (1, 2)", "sb_new = 0 AND birth_outcome = 1", 5),
    "ptb": ("ptb_new = 1", "ptb_new = 0", 3), "sga": ("sga_10 = 1", "sga_10 = 0", 3),
}


def roles_sql(outcome: str, case: str, free: str, steps: int) -> str:
    rows = f"(SELECT * FROM {{metadata}} WHERE {' AND '.join(STEPS[:steps])})"
    first = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site, orig_id, visitdt ORDER BY sample_id) AS rn FROM {rows} WHERE {free}) WHERE rn = 1)"
    return f"""SELECT '{outcome}' AS outcome, 'case' AS role, sample_id FROM {rows} WHERE {case} UNION ALL SELECT '{outcome}', 'noncase', sample_id FROM {first}
        UNION ALL SELECT '{outcome}', 'control', sample_id FROM {first} WHERE {' AND '.join(CONTROL)}"""


@query("cohort_from_config", " UNION ALL ".join(roles_sql(o, *rules) for o, rules in OUTCOME_SQL.items()))
def _(t):
    """The rows of all cohorts of all outcomes."""
    out = None
    for outcome in derive.OUTCOMES:
        named = roles(parts(t, outcome), "sample_id").select(F.lit(outcome).alias("outcome"), "role", "sample_id")
        out = named if out is None else out.unionByName(named)
    return out


@query("dedup_keep_first", """
    SELECT site, orig_id, visitdt, min(sample_id) AS sample_id FROM {metadata} GROUP BY site, orig_id, visitdt""")
def _(t):
    return first_per_key(t["metadata"].select("site", "orig_id", "visitdt", "sample_id"), ["site", "orig_id", "visitdt"], [F.col("sample_id")])


WEEKS = "floor((ga_hdlk_new + 6) / 7)"


@query("stratify", f"SELECT sample_id, CASE WHEN {WEEKS} < 20 THEN 'lt20' ELSE 'gte20' END AS stratum FROM {{metadata}} WHERE ga_hdlk_new IS NOT NULL")
def _(t):
    return cohort.stratify(derive.derived_fields(t["metadata"])).select("sample_id", "stratum")


GROUPED = f"""(SELECT concat('sb', CASE role WHEN 'case' THEN '' WHEN 'noncase' THEN '_noncase' ELSE '_control' END,
    CASE WHEN {WEEKS} < 20 THEN '_lt20' ELSE '_gte20' END) AS "group", sample_id, pw_age, sb_new, CAST({WEEKS} AS BIGINT) AS ga_weeks, site FROM {ROLES})"""


def grouped(t):
    return cohort.strata_concat({k: derive.derived_fields(v) for k, v in parts(t).items()}, "sb")


@query("strata_concat", f"""SELECT "group", sample_id, pw_age, ga_weeks FROM {GROUPED}""", "pw_age")
def _(t):
    return grouped(t).select("group", "sample_id", "pw_age", "ga_weeks")


@query("regression_input", f"""
    SELECT g."group", g.sample_id, g.ga_weeks, a.unique_feature_label, i.intensity_fill_log_scaled FROM {GROUPED} g
    JOIN {{intensity}} i ON g.sample_id = i.sample_id JOIN {CLEAN_ALIGNMENT} a ON i.site = a.site AND i.feature_label = a.feature_label""",
       "intensity_fill_log_scaled")
def _(t):
    return joins.with_cohort(grouped(t), aligned(t)).select("group", "sample_id", "ga_weeks", "unique_feature_label", "intensity_fill_log_scaled")


@query("group_pair_filter", " UNION ALL ".join(f"""
    SELECT 'sb_{kind}_{s}' AS analysis, sample_id, CASE WHEN "group" = 'sb_{s}' THEN 1 ELSE 0 END AS is_case FROM {GROUPED}
    WHERE "group" IN ('sb_{s}', 'sb_{kind}_{s}')""" for s in ("lt20", "gte20") for kind in ("control", "noncase")))
def _(t):
    return cohort.analyses(grouped(t), "sb").select("analysis", "sample_id", "is_case")


@query("pivot_wide", f"""SELECT sample_id, {', '.join(f'avg(value) FILTER (feature_id = {i}) AS f{i}' for i in range(50))}
    FROM {{long}} GROUP BY sample_id""", " ".join(f"f{i}" for i in range(50)))
def _(t):
    return shapes.pivot_wide(t["long"], range(50), prefix="f")


@query("melt", "SELECT vec_id, concat('e', CAST(i AS STRING)) AS feature_id, v AS value FROM (SELECT vec_id, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM {embeddings})", "value")
def _(t):
    e = F.col("embedding")
    wide = t["embeddings"].select("vec_id", *[e[i].cast("double").alias(f"e{i}") for i in range(64)])
    return shapes.melt(wide, ["vec_id"], [f"e{i}" for i in range(64)])


@query("subject_auc", """
    WITH p AS (SELECT *, lag(value) OVER w AS v0, lag(t) OVER w AS t0, first_value(value) OVER w AS base, t AS t1 FROM {series}
               WINDOW w AS (PARTITION BY user_id, event_type ORDER BY t, event_id))
    SELECT user_id, event_type, count(*) AS n_points, min(base) AS baseline,
           sum((v0 + value - 2 * base) / 2 * (t1 - t0)) / nullif(max(t1) - min(t1), 0) AS auc FROM p GROUP BY user_id, event_type""", "baseline auc")
def _(t):
    return shapes.series_auc(t["series"], "user_id", "event_type", "t", "value", "event_id").select("user_id", "event_type", "n_points", "baseline", "auc")


SPANS = """(SELECT subject_id, count(*) AS n_timepoints, min(ga_sample_days) AS first_timepoint, max(ga_sample_days) AS last_timepoint,
    max(ga_sample_days) - min(ga_sample_days) AS time_delta, string_agg(CAST(sample_id AS STRING), ';' ORDER BY ga_sample_days NULLS FIRST, sample_id) AS sample_ids,
    arg_min(sb, struct_pack(a := coalesce(ga_sample_days, -1), b := sample_id)) AS sb FROM {curated} GROUP BY subject_id)"""


@query("subject_baseline", f"SELECT * FROM {SPANS}")
def _(t):
    return shapes.subject_baseline(t["curated"], ["sb"])


@query("subject_samples", """
    SELECT subject_id, sample_id, ga_sample_days, row_number() OVER (PARTITION BY subject_id ORDER BY ga_sample_days NULLS FIRST, md5(concat('0:', CAST(sample_id AS STRING)))) AS visit_no
    FROM {curated}""")
def _(t):
    """Every visit; those without a time come first."""
    return shapes.subject_samples(t["curated"])


FEATURES = list(range(50))


@query("dataset_biosample", f"""SELECT c.sample_id, c.sb, {', '.join(f'f."{i}"' for i in FEATURES)} FROM {{curated}} c JOIN (
    SELECT sample_id, {', '.join(f'avg(value) FILTER (feature_id = {i}) AS "{i}"' for i in FEATURES)} FROM {{long}} GROUP BY sample_id) f
    ON c.sample_id = f.sample_id WHERE NOT coalesce(ga_sample_days >= ga_birth_days - 14, false)""", " ".join(map(str, FEATURES)))
def _(t):
    return shapes.dataset_biosample(t["curated"], t["long"], FEATURES).select("sample_id", "sb", *map(str, FEATURES))


@query("dataset_window", f"""SELECT c.sample_id, c.sb, {', '.join(f'f."{i}"' for i in FEATURES)} FROM {{curated}} c JOIN (
    SELECT sample_id, {', '.join(f'avg(value) FILTER (feature_id = {i}) AS "{i}"' for i in FEATURES)} FROM {{long}} GROUP BY sample_id) f
    ON c.sample_id = f.sample_id WHERE ga_sample_days BETWEEN 63 AND 183""", " ".join(map(str, FEATURES)))
def _(t):
    return shapes.dataset_window(t["curated"], t["long"], FEATURES).select("sample_id", "sb", *map(str, FEATURES))


KINDS = ["signup", "error", "click", "purchase", "view"]


def daily(t):
    """Events as visits: one sample per user and day, one feature per event type."""
    day = F.floor("t")
    rows = t["series"].select((F.col("user_id") * 100000 + day).alias("sample_id"), F.col("user_id").alias("subject_id"),
                              day.cast("double").alias("ga_sample_days"), "event_type", "value")
    visits = rows.groupBy("subject_id", "sample_id", "ga_sample_days").agg((F.max("value") > 40).cast("int").alias("sb"))
    return visits, rows.withColumnRenamed("event_type", "feature_id")


DAILY = """(SELECT user_id * 100000 + floor(t) AS sample_id, user_id AS subject_id, floor(t) AS d, event_type, value FROM {series})"""


@query("dataset_subject", f"""
    WITH cells AS (SELECT subject_id, sample_id, d, event_type, avg(value) AS v FROM {DAILY} GROUP BY ALL),
    base AS (SELECT subject_id, count(*) AS n, min(d) AS d0, max(d) AS d1 FROM (SELECT DISTINCT subject_id, d FROM {DAILY}) GROUP BY subject_id
             HAVING count(*) >= 2 AND max(d) - min(d) >= 28),
    pts AS (SELECT c.*, n, d0, d1, lag(v) OVER w AS v0, lag(d) OVER w AS dp, first_value(v) OVER w AS b FROM cells c JOIN base USING (subject_id)
            WINDOW w AS (PARTITION BY subject_id, event_type ORDER BY d)),
    f AS (SELECT subject_id, event_type, min(CASE WHEN d = d0 THEN v END) AS first,
                 CASE WHEN count(*) = min(n) THEN sum((v0 + v - 2 * b) / 2 * (d - dp)) / (max(d) - min(d)) END AS auc FROM pts GROUP BY subject_id, event_type)
    SELECT base.subject_id, base.n AS n_timepoints, CAST(d0 AS DOUBLE) AS first_timepoint, CAST(d1 - d0 AS DOUBLE) AS time_delta,
           {', '.join(f"min(first) FILTER (event_type = '{k}') AS {k}, min(auc) FILTER (event_type = '{k}') AS {k}_auc" for k in KINDS)}
    FROM base LEFT JOIN f USING (subject_id) GROUP BY base.subject_id, base.n, d0, d1""", "first_timepoint time_delta " + " ".join(f"{k} {k}_auc" for k in KINDS))
def _(t):
    visits, rows = daily(t)
    made = shapes.dataset_subject(visits, rows, KINDS, "sb")
    return made.select("subject_id", "n_timepoints", "first_timepoint", "time_delta", *[c for k in KINDS for c in (k, f"{k}_auc")])


SPLIT = """(SELECT subject_id, CASE (rn - 1) % 6 WHEN 5 THEN 'lockbox' ELSE concat('fold_', CAST((rn - 1) % 6 AS STRING)) END AS dataset_assignment FROM (
    SELECT subject_id, row_number() OVER (PARTITION BY o, s, n ORDER BY md5(concat('1500:', CAST(subject_id AS STRING))), subject_id) AS rn FROM (
        SELECT subject_id, max(sb) AS o, min(site) AS s, count(*) AS n FROM {curated} GROUP BY subject_id)))"""


@query("stratified_splits", f"SELECT c.sample_id, c.subject_id, s.dataset_assignment FROM {{curated}} c JOIN {SPLIT} s USING (subject_id)")
def _(t):
    return cohort.stratified_splits(t["curated"], "sb").select("sample_id", "subject_id", "dataset_assignment")


@query("cv_folds", f"""
    SELECT c.sample_id, concat('fold_', CAST(k AS STRING)) AS fold, s.dataset_assignment = concat('fold_', CAST(k AS STRING)) AS is_validation
    FROM {{curated}} c JOIN {SPLIT} s USING (subject_id), (SELECT unnest(range(5)) AS k) WHERE s.dataset_assignment <> 'lockbox'""")
def _(t):
    return cohort.cv_folds(cohort.stratified_splits(t["curated"], "sb")).select("sample_id", "fold", "is_validation")
