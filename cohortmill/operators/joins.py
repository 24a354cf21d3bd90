"""Equi-joins of the cohort workflow.

The alignment is looked up by measured size.  Otherwise no side is broadcast by hint: the optimizer
decides by size and splits skewed partitions at run time.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions.relate import attach_checked


def with_manifest(metadata: DataFrame, manifest: DataFrame, keys=("site", "orig_id", "visitdt")) -> DataFrame:
    """Samples listed in the manifest, with its ``sample_id``."""
    return metadata.join(manifest.select(*keys, "sample_id"), on=list(keys), how="inner")


def with_alignment(intensity: DataFrame, alignment: DataFrame, keys=("site", "feature_label")) -> DataFrame:
    """Intensities with the labels of the alignment; few keys hold all rows, so a small alignment is broadcast."""
    return attach_checked(intensity, alignment.dropna(subset=list(keys)), keys, "inner")


def with_cohort(cohort: DataFrame, intensity: DataFrame, key: str = "sample_id") -> DataFrame:
    """Every sample's measurements, once per group the sample belongs to."""
    return cohort.join(intensity.drop("site"), on=key, how="inner")


def with_annotation(results: DataFrame, annotation: DataFrame, key: str = "unique_feature_label") -> DataFrame:
    return results.join(annotation, on=key, how="left")


def compare_results(new: DataFrame, old: DataFrame, keys=("unique_feature_label", "group")) -> DataFrame:
    """Full outer join with flags ``sig_only_in_new``, ``sig_only_in_old`` and ``sig_in_both``."""
    left = new.withColumn("__in_new", F.lit(True))
    right = old.withColumn("__in_old", F.lit(True))
    a, b = F.coalesce("__in_new", F.lit(False)), F.coalesce("__in_old", F.lit(False))
    return left.join(right, on=list(keys), how="full").withColumns({
        "sig_only_in_new": a & ~b, "sig_only_in_old": b & ~a, "sig_in_both": a & b,
    }).drop("__in_new", "__in_old")


def keep_matching(left: DataFrame, right: DataFrame, key: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """Both frames reduced to the keys the other one has."""
    return left.join(right, key, "left_semi"), right.join(left, key, "left_semi")


def validate_ids(requested: DataFrame, available: DataFrame, key: str = "feature_id") -> DataFrame:
    """Requested ids with ``valid`` telling whether they exist."""
    known = available.select(key).distinct().withColumn("__known", F.lit(True))
    return requested.join(known, key, "left").withColumn("valid", F.coalesce("__known", F.lit(False))).drop("__known")


def validation_counts(checked: DataFrame) -> DataFrame:
    """One row: requested, valid, invalid, and whether all are valid."""
    return checked.agg(
        F.count(F.lit(1)).alias("total_requested"), F.count_if("valid").alias("valid_count"),
        F.count_if(~F.col("valid")).alias("invalid_count"),
    ).withColumn("validation_passed", F.col("invalid_count") == 0)
