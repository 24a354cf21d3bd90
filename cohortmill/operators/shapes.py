"""Long and wide shapes, per-subject series and the three modelling datasets."""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.nulls import number
from ..functions.relate import SALTS, attach
from .derive import POPULATIONS, drop_close_to_event, time_window
from .ranking import chunked, spread_row_number


def melt(df: DataFrame, ids, columns, feature: str = "feature_id", value: str = "value") -> DataFrame:
    """One row per row of ``df`` and listed column; of no columns, no rows (with a double as value)."""
    ids, columns = list(ids), list(columns)
    if not columns:
        return df.select(*ids, F.lit(None).cast("string").alias(feature), F.lit(None).cast("double").alias(value)).where(F.lit(False))
    return df.unpivot(ids, columns, feature, value)


def pivot_wide(long: DataFrame, features, sample="sample_id", feature: str = "feature_id", value: str = "value", prefix: str = "") -> DataFrame:
    """One row per sample, one column per listed feature; repeated cells are averaged."""
    keys = [sample] if isinstance(sample, str) else list(sample)
    features = list(features)
    wide = long.where(F.col(feature).isin(features)).groupBy(*keys).pivot(feature, features).agg(F.avg(value))
    return wide.toDF(*keys, *[f"{prefix}{f}" for f in features])


def series_auc(df: DataFrame, subject, feature: str, time: str, value: str, tiebreak: str, chunks: int | None = None) -> DataFrame:
    """Per (subject, feature): ``n_points``, ``first_time``, ``last_time``, ``baseline`` and ``auc``.

    ``auc`` is the trapezoid area of (value - first value) over time, divided by the time span;
    null without a span.  Points at one time are ordered by ``tiebreak`` and collapse to their first
    and last value.  Series are cut into ranges of time; each chunk is summed on its own and the
    trapezoids between chunks are added from the chunks' end points.
    """
    keys = [*([subject] if isinstance(subject, str) else subject), feature]
    known = df.select(*keys, F.col(time).cast("double").alias("t"), number(value).alias("v"), F.col(tiebreak).alias("k")) \
        .where(F.col("v").isNotNull() & F.col("t").isNotNull())
    points = known.groupBy(*keys, "t").agg(
        F.min_by("v", "k").alias("a"), F.max_by("v", "k").alias("b"), F.count(F.lit(1)).alias("c"))
    cut = chunked(points, keys, "t", chunks=chunks)
    step = Window.partitionBy(*keys, "__chunk").orderBy("t")
    area = (F.lag("b").over(step) + F.col("a")) / 2.0 * (F.col("t") - F.lag("t").over(step))
    parts = cut.withColumn("s", area).groupBy(*keys, "__chunk").agg(
        F.sum("s").alias("s"), F.sum("c").alias("c"), F.min("t").alias("t0"), F.max("t").alias("t1"),
        F.min_by("a", "t").alias("a"), F.max_by("b", "t").alias("b"))
    link = Window.partitionBy(*keys).orderBy("__chunk")
    bridge = (F.lag("b").over(link) + F.col("a")) / 2.0 * (F.col("t0") - F.lag("t1").over(link))
    whole = parts.withColumn("g", bridge).groupBy(*keys).agg(
        F.sum("c").alias("n_points"), F.min("t0").alias("first_time"), F.max("t1").alias("last_time"),
        F.min_by("a", "t0").alias("baseline"),
        (F.coalesce(F.sum("s"), F.lit(0.0)) + F.coalesce(F.sum("g"), F.lit(0.0))).alias("area"))
    span = F.col("last_time") - F.col("first_time")
    return whole.withColumn("auc", F.try_divide(F.col("area") - F.col("baseline") * span, span)).drop("area")


def subject_samples(metadata: DataFrame, subject: str = "subject_id", sample: str = "sample_id", time: str = "ga_sample_days") -> DataFrame:
    """Every sample of a subject with its visit number in time order (ties in md5 order)."""
    return spread_row_number(metadata.select(subject, sample, time), [subject], sample, order=time, name="visit_no")


def subject_spans(metadata: DataFrame, subject: str = "subject_id", time: str = "ga_sample_days") -> DataFrame:
    t = F.col(time)
    return metadata.groupBy(subject).agg(
        F.count(F.lit(1)).alias("n_timepoints"), F.min(t).alias("first_timepoint"), F.max(t).alias("last_timepoint"),
    ).withColumn("time_delta", F.col("last_timepoint") - F.col("first_timepoint"))


def subject_baseline(metadata: DataFrame, carry=(), subject: str = "subject_id", sample: str = "sample_id",
                     time: str = "ga_sample_days") -> DataFrame:
    """Per subject: time points, span, the ``carry`` columns at the first visit, and ``sample_ids``.

    ``sample_ids`` joins all ids with ``;`` in time order, in one text cell per subject; for subjects
    with more samples than such a cell should hold, ``subject_samples`` has them as rows.
    """
    spans = subject_spans(metadata, subject, time)
    first = metadata.groupBy(subject).agg(
        F.min_by(F.struct(F.lit(1).alias("__one"), *carry), F.struct(time, sample)).alias("__f")) \
        .select(subject, *[F.col("__f").getField(c).alias(c) for c in carry])
    listed = metadata.groupBy(subject).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(time, sample))),
                                 lambda s: s.getField(sample).cast("string")), ";").alias("sample_ids"))
    return attach(attach(spans, first, [subject]), listed, [subject])


def dataset_biosample(metadata: DataFrame, intensity: DataFrame, features, margin=14, sample: str = "sample_id") -> DataFrame:
    """Samples not close to the event, with one column per feature."""
    wide = pivot_wide(intensity, features, sample)
    return drop_close_to_event(metadata, margin=margin).join(wide, sample, "inner")


def dataset_window(metadata: DataFrame, intensity: DataFrame, features, start=63, size=120, sample: str = "sample_id") -> DataFrame:
    """Samples inside the time window, with one column per feature."""
    wide = pivot_wide(intensity, features, sample)
    return time_window(metadata, start=start, size=size).join(wide, sample, "inner")


def dataset_subject(metadata: DataFrame, intensity: DataFrame, features, outcome: str, min_span=28, min_points: int = 2,
                    subject: str = "subject_id", sample: str = "sample_id", time: str = "ga_sample_days",
                    feature: str = "feature_id", value: str = "value") -> DataFrame:
    """Subjects with enough visits, with first value and ``<feature>_auc`` per feature.

    All samples of a subject must have measurements.  As in a matrix calculation, a feature
    missing at one of the visits has no area, and missing at the first visit no first value.
    """
    features = list(features)
    carried = [c for c in (outcome, "maternal_age", "ga_birth_days", "site", "dataset_assignment", *POPULATIONS) if c in metadata.columns]
    measured = intensity.select(sample).distinct().withColumn("__has", F.lit(1))
    complete = attach(metadata.select(subject, sample), measured, [sample]).groupBy(subject).agg(
        F.count("__has").alias("__h"), F.count(F.lit(1)).alias("__n")).where(F.col("__h") == F.col("__n"))
    base = subject_baseline(metadata, carried, subject, sample, time) \
        .where((F.col("n_timepoints") >= min_points) & (F.col("time_delta") >= min_span)) \
        .join(complete, subject, "left_semi").withColumnRenamed("ga_birth_days", "ga_birth")
    cells = intensity.where(F.col(feature).isin(features)).groupBy(sample, feature).agg(F.avg(number(value)).alias("__v"))
    visits = metadata.join(base.select(subject), subject, "left_semi").select(subject, sample, time)
    series = series_auc(visits.join(cells, sample), subject, feature, time, "__v", sample)
    joined = attach(series, base.select(subject, "n_timepoints", "first_timepoint"), [subject])
    usable = joined.select(
        subject, F.col(feature),
        F.when(F.col("first_time") == F.col("first_timepoint"), F.col("baseline")).alias("first"),
        F.when(F.col("n_points") == F.col("n_timepoints"), F.col("auc")).alias("auc"))
    wide = usable.groupBy(subject).pivot(feature, features).agg(F.first("first", True).alias("first"), F.first("auc", True).alias("auc"))
    named = wide.toDF(subject, *[n for f in features for n in (f"{f}", f"{f}_auc")])
    return attach(base, named, [subject])
