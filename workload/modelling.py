"""Exploration, metrics, sampling, boosted trees and the jobs."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cohortmill.functions.relate import stored
from cohortmill.operators import boosting, cohort, explore, sampling, scoring, shapes
from cohortmill.plans import jobs

from .derivation import scratch
from .registry import query
from .relations import manifest
from .transforms import MELTED, WIDE, embedded


def labelled(t):
    """Embeddings with a 0/1 outcome and split labels."""
    rows = embedded(t).withColumn("outcome", (F.col("label") >= 7).cast("int"))
    return cohort.stratified_splits(rows, "outcome", subject="vec_id")


@query("pca_scores")
def _(t):
    return explore.pca_scores(explore.fit_pca(embedded(t), WIDE, 10, "site"), ["vec_id", "site"])


@query("pca_variance")
def _(t):
    return explore.pca_variance(t.spark, explore.fit_pca(embedded(t), WIDE, 10))


@query("cumulative_variance")
def _(t):
    return explore.pca_variance(t.spark, explore.fit_pca(embedded(t), WIDE, 64)).select("component", "cumulative_variance")


@query("pca_loadings")
def _(t):
    return explore.pca_loadings(t.spark, explore.fit_pca(embedded(t), WIDE, 10), WIDE)


@query("pca_metadata_join")
def _(t):
    scores = explore.pca_scores(explore.fit_pca(embedded(t), WIDE, 3), ["vec_id"])
    return explore.pca_metadata_join(scores, embedded(t).select("vec_id", "site", "label"), "vec_id")


@query("batch_effect_report")
def _(t):
    return explore.batch_effect_report(embedded(t), WIDE, "site", "vec_id")


PAIRS = f"""(SELECT concat('e', CAST(a.i AS STRING)) AS feature_1, concat('e', CAST(b.i AS STRING)) AS feature_2, corr(a.v, b.v) AS corr
    FROM {MELTED} a JOIN {MELTED} b ON a.vec_id = b.vec_id GROUP BY a.i, b.i)"""


@query("feature_corr_matrix", f"SELECT * FROM {PAIRS}", "corr")
def _(t):
    return explore.feature_corr_matrix(embedded(t), WIDE.columns)


@query("high_corr_pairs", f"SELECT * FROM {PAIRS} WHERE feature_1 < feature_2 AND abs(corr) > 0.1", "corr")
def _(t):
    return explore.high_corr_pairs(explore.feature_corr_matrix(embedded(t), WIDE.columns), 0.1)


@query("correlation_summary", f"""
    SELECT avg(abs(corr)) AS mean_abs_correlation, max(abs(corr)) AS max_correlation, count(*) FILTER (abs(corr) > 0.1) AS n_high_corr_pairs
    FROM {PAIRS} WHERE feature_1 < feature_2""", "mean_abs_correlation max_correlation")
def _(t):
    return explore.correlation_summary(explore.feature_corr_matrix(embedded(t), WIDE.columns), 0.1)


@query("feature_covariate_corr", f"""
    SELECT concat('e', CAST(i AS STRING)) AS feature_id, 'label' AS covariate, corr(v, label) AS corr FROM {MELTED} GROUP BY i""", "corr")
def _(t):
    return explore.feature_covariate_corr(embedded(t), WIDE.columns, ["label", "absent"])


CONFUSION = """SELECT fold, count(*) FILTER (label = 0 AND score < 25) AS tn, count(*) FILTER (label = 0 AND score >= 25) AS fp,
    count(*) FILTER (label = 1 AND score < 25) AS fn, count(*) FILTER (label = 1 AND score >= 25) AS tp FROM {scored} GROUP BY fold"""


@query("classification_metrics", f"""
    SELECT fold, tn AS "TN_val", fp AS "FP_val", fn AS "FN_val", tp AS "TP_val", 2 * tp / nullif(2 * tp + fp + fn, 0) AS "F1 Score_val", tp / nullif(tp + fp, 0) AS "PPV_val",
           tn / nullif(tn + fn, 0) AS "NPV_val", tp / nullif(tp + fn, 0) AS "Sensitivity_val", tn / nullif(tn + fp, 0) AS "Specificity_val",
           (tp::DOUBLE * tn - fp::DOUBLE * fn) / nullif(sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 0) AS "MCC_val" FROM ({CONFUSION})""",
       "PPV_val NPV_val Sensitivity_val Specificity_val MCC_val")
def _(t):
    return scoring.classification_metrics(t["scored"], "label", "score", 25.0, ["fold"], "_val").withColumn("F1 Score_val", F.round("F1 Score_val", 12))


@query("auroc", """
    SELECT sum(CASE WHEN label = 1 THEN r END) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2 AS u_,
           (sum(CASE WHEN label = 1 THEN r END) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
           / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS "AUROC"
    FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM {scored})""", "AUROC")
def _(t):
    area = scoring.auroc(t["scored"], "label", "score")
    sizes = t["scored"].agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("q"))
    return area.select(F.round(F.col("AUROC") * sizes.select("p").scalar() * sizes.select("q").scalar(), 1).alias("u_"), "AUROC")


@query("auprc", """
    SELECT fold, sum(p * tp / n) / max(total) AS "AUPRC" FROM (
        SELECT fold, p, sum(p) OVER (PARTITION BY fold ORDER BY score DESC) AS tp, sum(c) OVER (PARTITION BY fold ORDER BY score DESC) AS n, sum(p) OVER (PARTITION BY fold) AS total
        FROM (SELECT fold, score, count(*) FILTER (label = 1) AS p, count(*) AS c FROM {scored} GROUP BY fold, score)) GROUP BY fold""", "AUPRC")
def _(t):
    return scoring.auprc(t["scored"], "label", "score", ["fold"])


@query("random_undersample", """
    SELECT event_id, label FROM (SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat('1500:', CAST(event_id AS STRING))), event_id) AS rn,
        count(*) FILTER (label = 1) OVER () AS ones FROM {scored}) WHERE label = 1 OR rn <= floor(ones / 0.5)""")
def _(t):
    return sampling.random_undersample(t["scored"], "label", "event_id", 0.5).select("event_id", "label")


DIST = """(SELECT a.vec_id AS maj, b.vec_id AS mino, sqrt(list_sum(list_transform(range(1, 65), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2))) AS d
    FROM {embeddings} a, {embeddings} b WHERE a.label < 7 AND b.label >= 7)"""


def near_miss_sql(order: str) -> str:
    return f"""SELECT vec_id FROM {{embeddings}} WHERE label >= 7 UNION ALL SELECT maj FROM (
        SELECT maj, row_number() OVER (ORDER BY score) AS rn FROM (
            SELECT maj, avg(d) AS score FROM (SELECT *, row_number() OVER (PARTITION BY maj ORDER BY d {order}) AS k FROM {DIST}) WHERE k <= 3 GROUP BY maj))
        WHERE rn <= (SELECT count(*) FROM {{embeddings}} WHERE label >= 7)"""


def near_miss(t, version):
    return sampling.near_miss_undersample(labelled(t), "outcome", "vec_id", WIDE.columns, version).select("vec_id")


@query("near_miss_undersample", near_miss_sql("ASC"))
def _(t):
    return near_miss(t, 1)


@query("near_miss_undersample_farthest", near_miss_sql("DESC"))
def _(t):
    return near_miss(t, 2)


@query("near_miss_undersample_two_step", f"""
    WITH d AS {DIST}, close AS (SELECT DISTINCT maj FROM (SELECT *, row_number() OVER (PARTITION BY mino ORDER BY d) AS k FROM d) WHERE k <= 3)
    SELECT vec_id FROM {{embeddings}} WHERE label >= 7 UNION ALL SELECT maj FROM (
        SELECT maj, row_number() OVER (ORDER BY score DESC) AS rn FROM (
            SELECT maj, avg(d) AS score FROM (SELECT *, row_number() OVER (PARTITION BY maj ORDER BY d) AS k FROM d WHERE maj IN (SELECT maj FROM close)) WHERE k <= 3 GROUP BY maj))
        WHERE rn <= (SELECT count(*) FROM {{embeddings}} WHERE label >= 7)""")
def _(t):
    return near_miss(t, 3)


@query("tomek_links", """
    WITH d AS (SELECT a.vec_id AS x, b.vec_id AS y, a.label >= 7 AS mx, b.label >= 7 AS my,
                      list_sum(list_transform(range(1, 65), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2)) AS d
               FROM {embeddings} a, {embeddings} b WHERE a.vec_id <> b.vec_id),
    nn AS (SELECT x, min(d) AS m FROM d GROUP BY x)
    SELECT vec_id FROM {embeddings} WHERE vec_id NOT IN (
        SELECT d.x FROM d JOIN nn p ON d.x = p.x AND d.d = p.m JOIN nn q ON d.y = q.x AND d.d = q.m WHERE NOT mx AND my)""")
def _(t):
    return sampling.tomek_links(labelled(t), "outcome", "vec_id", WIDE.columns).select("vec_id")


PARAMS = boosting.TreeParams(max_depth=3, n_estimators=8, min_child_weight=5, sampling_ratio=0.5)
FEATURES = list(WIDE.columns)


def narrow(t):
    """The labelled table as a user would keep it: computed once, whatever reads it."""
    return stored(labelled(t).select("vec_id", "site", "outcome", "dataset_assignment", *FEATURES))


def trained(t):
    rows = narrow(t)
    return rows, boosting.final_model(rows, FEATURES, [], "outcome", "vec_id", PARAMS)


@query("gbt_classifier")
def _(t):
    rows = narrow(t)
    vectors = rows.select("vec_id", "outcome", F.array(*FEATURES).alias("features"))
    return boosting.scored(boosting.fit_gbt(vectors, "outcome", PARAMS), vectors, ["vec_id", "outcome"])


@query("tune_random_search")
def _(t):
    return boosting.tune_random_search(narrow(t), FEATURES, [], "outcome", "vec_id")[1]


@query("final_model")
def _(t):
    return trained(t)[1][1]


@query("lockbox_evaluate")
def _(t):
    rows, (model, _) = trained(t)
    return boosting.lockbox_evaluate(model, rows, "outcome")


@query("model_save_load")
def _(t):
    rows, (model, _) = trained(t)
    loaded = boosting.RiskModel.load(t.spark, model.save(scratch(t, "model_save_load")))
    return loaded.score(rows, ["vec_id", "outcome"])


@query("add_covariates")
def _(t):
    rows = narrow(t).withColumn("maternal_age", F.col("site") * 1.5 + 18)
    model = boosting.train(rows, FEATURES, boosting.covariates_for("biosample", rows), "outcome", "vec_id", PARAMS)
    return model.prepare(rows, ["vec_id"]).select("vec_id", "features")


@query("permutation_importance")
def _(t):
    rows, (model, _) = trained(t)
    return boosting.permutation_importance(model, rows, "outcome", "vec_id")


@query("tree_importance")
def _(t):
    return boosting.tree_importance(trained(t)[1][0])


def discovery_inputs(t):
    alignment = t["alignment"].select("site", F.concat(F.lit("m"), F.regexp_extract("feature_label", "([0-9]+)$", 1)).alias("feature_label"), "unique_feature_label")
    return jobs.DiscoveryInputs(t["metadata"], manifest(t), t["intensity"], alignment, t["annotation"], t["previous"])


@query("job_discovery")
def _(t):
    return jobs.discover(discovery_inputs(t), "ptb")["results"]


@query("job_discovery_comparison")
def _(t):
    return jobs.discover(discovery_inputs(t), "ptb")["comparison_summary"]


def dense(t):
    """Four measures of every order, complete for each sample, as intensities."""
    per_order = t["lineitem"].groupBy(F.col("l_orderkey").alias("sample_id")).agg(
        F.avg("l_quantity").alias("quantity"), F.avg(F.ln("l_extendedprice")).alias("price"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"))
    rows = shapes.melt(per_order, ["sample_id"], ["quantity", "price", "discount", "tax"], "feature_label", "intensity_fill_log_scaled")
    sites = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("sample_id"), F.col("c_mktsegment").alias("site"))
    return rows.join(sites, "sample_id")


def dense_inputs(t):
    rows = dense(t)
    alignment = rows.select("site", "feature_label", F.concat(F.lit("F_"), "feature_label").alias("unique_feature_label")).distinct()
    annotation = t["annotation"].select("unique_feature_label", "compound_id", "compound_class")
    return jobs.DiscoveryInputs(t["metadata"], manifest(t), rows, alignment, annotation, t["previous"])


@query("job_risk_model")
def _(t):
    inputs = discovery_inputs(t)
    curated = jobs.curate(jobs.prepare_metadata(inputs.metadata, inputs.manifest), "ptb")
    visits = curated.select("sample_id", "subject_id", "site", "ptb", "dataset_assignment", "maternal_age", "ga_sample_days", "ga_birth_days", "high_risk", "bmi")
    intensity = dense(t).select("sample_id", F.col("feature_label").alias("feature_id"), F.col("intensity_fill_log_scaled").alias("value"))
    return jobs.predict(visits, intensity, ["quantity", "price", "discount", "tax"], "ptb")["lockbox_metrics"]


@query("job_full")
def _(t):
    return jobs.run_summary(t.spark, jobs.full(dense_inputs(t), "ptb"))


@query("run_summary")
def _(t):
    return jobs.run_summary(t.spark, jobs.full(discovery_inputs(t), "ptb", run="discovery"))


@query("job_eda")
def _(t):
    rows = narrow(t).withColumn("subject_id", F.col("vec_id"))
    reports = jobs.explore_dataset(rows, FEATURES, "outcome", "vec_id")
    parts = [df.select(F.lit(name).alias("report"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("row")) for name, df in reports.items()]
    return reduce(DataFrame.unionAll, parts)
