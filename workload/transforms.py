"""Imputation, outliers, normalisation, batch correction and scaling."""

from pyspark.sql import functions as F

from cohortmill.operators import clean, impute, normalize, outlier, select, shapes
from cohortmill.operators.layout import Long, Wide

from .registry import query

LONG = Long()
LOGGED = "(SELECT *, log2(value + 1) AS log2_value FROM {long_missing})"


def picked(df, *columns):
    return df.select("sample_id", "feature_id", *columns)


def embedded(t):
    """Embeddings as a wide table: vec_id, site, label, e0..e63."""
    return t["embeddings"].selectExpr("vec_id", "label % 5 AS site", "label", *[f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(64)])


WIDE = Wide([f"e{i}" for i in range(64)])
MELTED = "(SELECT vec_id, label % 5 AS site, label, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM {embeddings})"


def melted(df):
    """The wide table as rows (vec_id, i, v), to compare with SQL."""
    return df.unpivot(["vec_id"], WIDE.values(), "c", "v").select("vec_id", F.substring("c", 2, 9).cast("long").alias("i"), "v")


# Means are compared on logs: averages of money amounts with two decimals often end exactly on a
# rounding tie, which the two engines' summation orders then break differently.

@query("group_impute_mean", f"""
    SELECT sample_id, feature_id, coalesce(log2_value, avg(log2_value) OVER (PARTITION BY site, feature_id)) AS log2_value FROM {LOGGED}""", "log2_value")
def _(t):
    logs = normalize.log_transform(t["long_missing"], LONG)
    return picked(impute.impute(logs, normalize.logged(LONG), "mean", ["site"]), "log2_value")


@query("group_impute_median", """
    SELECT sample_id, feature_id, coalesce(value, m) AS value FROM {long_missing} l JOIN (
        SELECT site, feature_id, quantile_disc(value, 0.5) AS m FROM {long_missing} GROUP BY site, feature_id) s
    USING (site, feature_id)""", "value")
def _(t):
    return picked(impute.impute(t["long_missing"], LONG, "median", ["site"]), "value")


FLAGS = impute.BINARY_COLUMNS
AGREED = "CASE WHEN count(DISTINCT {0}) = 1 AND min({0}) IN (0, 1) THEN min({0}) END"


@query("subject_binary_impute", f"""
    SELECT m.sample_id, {', '.join(f'coalesce(m.{c}, f.{c}) AS {c}' for c in FLAGS)}
    FROM {{metadata}} m JOIN (SELECT site, orig_id, {', '.join(f'{AGREED.format(c)} AS {c}' for c in FLAGS)}
        FROM {{metadata}} GROUP BY site, orig_id) f ON m.site = f.site AND m.orig_id = f.orig_id""")
def _(t):
    return impute.subject_binary_impute(t["metadata"]).select("sample_id", *FLAGS)


@query("impute_drop", "SELECT sample_id, feature_id, value FROM {long_missing} WHERE value IS NOT NULL", "value")
def _(t):
    return picked(impute.impute_drop(t["long_missing"], LONG), "value")


@query("impute_zero", "SELECT sample_id, feature_id, coalesce(value, 0) AS value FROM {long_missing}", "value")
def _(t):
    return picked(impute.impute_zero(t["long_missing"], LONG), "value")


@query("impute_mean", f"""
    SELECT sample_id, feature_id, coalesce(log2_value, avg(log2_value) OVER (PARTITION BY feature_id)) AS log2_value FROM {LOGGED}""", "log2_value")
def _(t):
    logs = normalize.log_transform(t["long_missing"], LONG)
    return picked(impute.impute(logs, normalize.logged(LONG), "mean"), "log2_value")


@query("impute_median", """
    SELECT sample_id, feature_id, coalesce(value, m) AS value FROM {long_missing} JOIN (
        SELECT feature_id, quantile_disc(value, 0.5) AS m FROM {long_missing} GROUP BY feature_id) USING (feature_id)""", "value")
def _(t):
    return picked(impute.impute(t["long_missing"], LONG), "value")


@query("impute_median_wide", f"""
    SELECT vec_id, i, coalesce(w, m) AS v FROM (SELECT *, CASE WHEN v > 0.2 THEN NULL ELSE v END AS w FROM {MELTED})
    JOIN (SELECT i, quantile_disc(CASE WHEN v > 0.2 THEN NULL ELSE v END, 0.5) AS m FROM {MELTED} GROUP BY i) USING (i)""", "v")
def _(t):
    holed = WIDE.project(embedded(t), lambda x: F.when(x <= 0.2, x))
    return melted(impute.impute(holed, WIDE))


BOUNDS = {
    "iqr": """(SELECT feature_id, q1 - 0.4 * (q3 - q1) AS lo, q3 + 0.4 * (q3 - q1) AS hi FROM (
        SELECT feature_id, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM {long_missing} GROUP BY feature_id))""",
    "zscore": "(SELECT feature_id, avg(value) - 1.5 * stddev_samp(value) AS lo, avg(value) + 1.5 * stddev_samp(value) AS hi FROM {long_missing} GROUP BY feature_id)",
}
LIMITS = {"iqr": 0.4, "zscore": 1.5}
for method, limit in LIMITS.items():
    source = f"{{long_missing}} JOIN {BOUNDS[method]} USING (feature_id)"

    @query(f"outlier_{method}_remove", f"SELECT sample_id, feature_id, value FROM {source} WHERE value BETWEEN lo AND hi", "value")
    def _(t, method=method, limit=limit):
        return picked(outlier.handle_outliers(t["long_missing"], LONG, method, limit, "remove"), "value")

    @query(f"outlier_{method}_cap", f"SELECT sample_id, feature_id, CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END AS value FROM {source}", "value", 4)
    def _(t, method=method, limit=limit):
        return picked(outlier.handle_outliers(t["long_missing"], LONG, method, limit, "cap"), "value")

    @query(f"outlier_{method}_flag", f"SELECT sample_id, feature_id, coalesce(value < lo OR value > hi, false) AS value_outlier FROM {source}")
    def _(t, method=method, limit=limit):
        return picked(outlier.handle_outliers(t["long_missing"], LONG, method, limit, "flag"), "value_outlier")


@query("outlier_zscore_cap_wide", f"""
    SELECT vec_id, i, CASE WHEN v < lo THEN lo WHEN v > hi THEN hi ELSE v END AS v FROM {MELTED} JOIN (
        SELECT i, avg(v) - 2 * stddev_samp(v) AS lo, avg(v) + 2 * stddev_samp(v) AS hi FROM {MELTED} GROUP BY i) USING (i)""", "v")
def _(t):
    return melted(outlier.handle_outliers(embedded(t), WIDE, "zscore", 2.0))


@query("clean_intensity", """
    WITH kept AS (SELECT * FROM {long_missing} WHERE feature_id IN (SELECT feature_id FROM {long_missing} GROUP BY feature_id
                  HAVING count(*) FILTER (value IS NULL) / count(*) <= 0.5 AND count(*) FILTER (value = 0) / count(*) <= 0.3)),
    filled AS (SELECT sample_id, feature_id, coalesce(value, m) AS value FROM kept JOIN (
        SELECT feature_id, quantile_disc(value, 0.5) AS m FROM kept GROUP BY feature_id) USING (feature_id)),
    bounds AS (SELECT feature_id, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM filled GROUP BY feature_id)
    SELECT sample_id, feature_id, CASE WHEN value < q1 - 0.5 * (q3 - q1) THEN q1 - 0.5 * (q3 - q1) WHEN value > q3 + 0.5 * (q3 - q1) THEN q3 + 0.5 * (q3 - q1) ELSE value END AS value
    FROM filled JOIN bounds USING (feature_id)""", "value", 4)
def _(t):
    return picked(clean.clean_intensity(t["long_missing"], LONG, threshold=0.5)[0], "value")


@query("log_transform", "SELECT sample_id, feature_id, log2(value + 1) AS log2_value, log10(value + 1) AS log10_value, ln(value + 1) AS ln_value FROM {long_missing}",
       "log2_value log10_value ln_value")
def _(t):
    out = t["long_missing"]
    for base in ("log2", "log10", "ln"):
        out = normalize.log_transform(out, LONG, base)
    return picked(out, "log2_value", "log10_value", "ln_value")


@query("center_median", f"""
    SELECT sample_id, feature_id, log2_value - m AS log2_value FROM {LOGGED} JOIN (
        SELECT feature_id, quantile_disc(log2_value, 0.5) AS m FROM {LOGGED} GROUP BY feature_id) USING (feature_id)""", "log2_value")
def _(t):
    return picked(normalize.center_median(t["long_missing"], LONG), "log2_value")


@query("center_mean", f"""
    SELECT sample_id, feature_id, log2_value - avg(log2_value) OVER (PARTITION BY feature_id) AS log2_value FROM {LOGGED}""", "log2_value")
def _(t):
    return picked(normalize.center_mean(t["long_missing"], LONG), "log2_value")


@query("center_median_reference", f"""
    SELECT sample_id, feature_id, log2_value - m + 5 AS log2_value FROM {LOGGED} JOIN (
        SELECT feature_id, quantile_disc(log2_value, 0.5) AS m FROM {LOGGED} WHERE site < 3 GROUP BY feature_id) USING (feature_id)""", "log2_value")
def _(t):
    reference = normalize.normalization_stats(t["long_missing"].where("site < 3"), LONG)
    return picked(normalize.center_median(t["long_missing"], LONG, reference=reference, anchor=5.0), "log2_value")


@query("group_center_median", f"""
    SELECT sample_id, feature_id, log2_value - m + g AS log2_value FROM {LOGGED} JOIN (
        SELECT site, feature_id, quantile_disc(log2_value, 0.5) AS m FROM {LOGGED} GROUP BY site, feature_id) USING (site, feature_id) JOIN (
        SELECT feature_id, quantile_disc(log2_value, 0.5) AS g FROM {LOGGED} GROUP BY feature_id) USING (feature_id)""", "log2_value")
def _(t):
    return picked(normalize.center_median(t["long_missing"], LONG, ["site"]), "log2_value")


@query("group_center_mean", f"""
    SELECT sample_id, feature_id, log2_value - avg(log2_value) OVER (PARTITION BY site, feature_id) + avg(log2_value) OVER (PARTITION BY feature_id) AS log2_value
    FROM {LOGGED}""", "log2_value")
def _(t):
    return picked(normalize.center_mean(t["long_missing"], LONG, ["site"]), "log2_value")


@query("group_center_median_wide", f"""
    SELECT vec_id, i, log2(v + 1) - m + g AS v FROM {MELTED} JOIN (
        SELECT site, i, quantile_disc(log2(v + 1), 0.5) AS m FROM {MELTED} GROUP BY site, i) USING (site, i) JOIN (
        SELECT i, quantile_disc(log2(v + 1), 0.5) AS g FROM {MELTED} GROUP BY i) USING (i)""", "v")
def _(t):
    made = normalize.center_median(embedded(t), WIDE, ["site"])
    return melted(made.select("vec_id", *[F.col(f"log2_{c}").alias(c) for c in WIDE.columns]))


@query("zscore_normalize", f"""
    SELECT sample_id, feature_id, (log2_value - avg(log2_value) OVER (PARTITION BY feature_id)) / stddev_samp(log2_value) OVER (PARTITION BY feature_id) AS log2_value
    FROM {LOGGED}""", "log2_value")
def _(t):
    return picked(normalize.zscore_normalize(t["long_missing"], LONG), "log2_value")


@query("robust_scale", f"""
    SELECT sample_id, feature_id, (log2_value - q2) / (q3 - q1) AS log2_value FROM {LOGGED} JOIN (
        SELECT feature_id, quantile_disc(log2_value, 0.25) AS q1, quantile_disc(log2_value, 0.5) AS q2, quantile_disc(log2_value, 0.75) AS q3
        FROM {LOGGED} GROUP BY feature_id) USING (feature_id)""", "log2_value")
def _(t):
    return picked(normalize.robust_scale(t["long_missing"], LONG), "log2_value")


@query("quantile_normalize", """
    WITH ranked AS (SELECT sample_id, feature_id, value, row_number() OVER (PARTITION BY sample_id ORDER BY value, md5(concat('0:', CAST(feature_id AS STRING)))) AS r
                    FROM {long_missing} WHERE value IS NOT NULL)
    SELECT sample_id, feature_id, m AS value FROM ranked JOIN (SELECT r, avg(value) AS m FROM ranked GROUP BY r) USING (r)""", "value", 4)
def _(t):
    return picked(normalize.quantile_normalize(t["long_missing"], LONG, log=False), "value")


@query("normalize_dispatch", f"""
    WITH l AS (SELECT * FROM {LOGGED}), s AS (SELECT feature_id, quantile_disc(log2_value, 0.5) AS med, avg(log2_value) AS mean, stddev_samp(log2_value) AS sd,
        quantile_disc(log2_value, 0.25) AS q1, quantile_disc(log2_value, 0.75) AS q3 FROM l GROUP BY feature_id)
    SELECT 'unheard of' AS method, sample_id, feature_id, log2_value FROM l
    UNION ALL SELECT 'log_median_centering', sample_id, feature_id, log2_value - med FROM l JOIN s USING (feature_id)
    UNION ALL SELECT 'log_mean_centering', sample_id, feature_id, log2_value - mean FROM l JOIN s USING (feature_id)
    UNION ALL SELECT 'zscore', sample_id, feature_id, CASE WHEN sd > 0 THEN (log2_value - mean) / sd ELSE log2_value END FROM l JOIN s USING (feature_id)
    UNION ALL SELECT 'quantile', sample_id, feature_id, CASE WHEN q3 > q1 THEN (log2_value - med) / (q3 - q1) ELSE log2_value END FROM l JOIN s USING (feature_id)""", "log2_value")
def _(t):
    """Every branch by its name, and an unknown name, which only takes logs (``rank_quantile`` is the query ``quantile_normalize``)."""
    out = None
    for method in ("log_median_centering", "log_mean_centering", "zscore", "quantile", "unheard of"):
        made = picked(normalize.normalize(t["long_missing"], LONG, method), "log2_value").select(F.lit(method).alias("method"), "sample_id", "feature_id", "log2_value")
        out = made if out is None else out.unionByName(made)
    return out


@query("batch_correct", """
    SELECT sample_id, feature_id, value - coalesce(m, g) + g AS value FROM {long_missing}
    LEFT JOIN (SELECT site, feature_id, quantile_cont(value, 0.5) AS m FROM {long_missing} WHERE site <> 4 GROUP BY site, feature_id) USING (site, feature_id)
    JOIN (SELECT feature_id, quantile_cont(value, 0.5) AS g FROM {long_missing} WHERE site <> 4 GROUP BY feature_id) USING (feature_id)""", "value", 4)
def _(t):
    rows = t["long_missing"]
    return picked(normalize.batch_correct(rows, LONG, train=rows.where("site <> 4")), "value")


@query("standard_scale", f"""
    SELECT vec_id, i, (v - m) / s AS v FROM {MELTED} JOIN (
        SELECT i, avg(v) AS m, stddev_pop(v) AS s FROM {MELTED} WHERE label < 7 GROUP BY i) USING (i)""", "v")
def _(t):
    rows = embedded(t)
    return melted(normalize.standard_scale(rows, WIDE, train=rows.where("label < 7")))


@query("drop_features_with_nulls", f"""
    SELECT vec_id, i, v FROM {MELTED} WHERE i NOT IN (SELECT i FROM {MELTED} WHERE v > 0.3)""", "v")
def _(t):
    holed = WIDE.project(embedded(t), lambda x: F.when(x <= 0.3, x))
    rows, kept, _ = select.drop_features_with_nulls(holed, WIDE)
    return shapes.melt(rows, ["vec_id"], kept.values(), "c", "v").select("vec_id", F.substring("c", 2, 9).cast("long").alias("i"), "v")
