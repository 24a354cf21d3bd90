"""Logarithms, centring, scaling and batch correction."""

from pyspark.sql import DataFrame, functions as F

from ..functions.measures import log_of
from ..functions.nulls import holds, number, quoted
from ..functions.relate import attach, attach_checked
from .layout import Long
from .ranking import exact_quantiles, sorted_row_number


def log_transform(df: DataFrame, layout, base: str = "log2", offset: float = 1.0) -> DataFrame:
    """log(x + offset) in new columns named by base, e.g. ``log2_x``."""
    base = base if base in ("log2", "log10", "ln") else "log2"
    return layout.project(df, lambda x: log_of(x, base, offset), lambda c: f"{base}_{c}")


def logged(layout, base: str = "log2"):
    """The layout of the columns made by ``log_transform``."""
    return layout.renamed(lambda c: f"{base}_{c}")


def normalization_stats(df: DataFrame, layout, by=(), accuracy: int | None = None) -> DataFrame:
    """``mean``, ``std`` and ``median`` of the logs per feature (and group), to keep and reapply."""
    return logged(layout).summarise(
        log_transform(df, layout), by, {"mean": F.avg, "std": F.stddev_samp}, {"median": 0.5}, accuracy)


def _location(df, layout, by, kind, accuracy):
    if kind == "mean":
        return layout.summarise(df, by, {"mean": F.avg})
    return layout.summarise(df, by, probs={"median": 0.5}, accuracy=accuracy)


def center(df: DataFrame, layout, kind: str = "median", by=(), reference: DataFrame | None = None,
           anchor: float = 0.0, accuracy: int | None = None) -> DataFrame:
    """Log, then x - statistic + anchor.

    Without groups the anchor is a constant.  With groups it is the feature's overall statistic,
    so features keep their level while groups are aligned.  ``reference`` supplies statistics
    from ``normalization_stats`` (per group if ``by`` is given; a group it lacks is left as is).
    """
    df, layout = log_transform(df, layout), logged(layout)
    by = list(by)
    stats = reference if reference is not None else _location(df, layout, by, kind, accuracy)
    if not by:
        return layout.apply(df, stats, lambda x, s: F.coalesce(x - s(kind) + anchor, x))
    stats = layout.merge(stats, _location(df, layout, (), kind, accuracy))
    return layout.apply(df, stats, lambda x, s: F.coalesce(x - s(kind) + s(f"all_{kind}"), x), by)


def center_median(df, layout, by=(), reference=None, anchor=0.0, accuracy=None):
    return center(df, layout, "median", by, reference, anchor, accuracy)


def center_mean(df, layout, by=(), reference=None, anchor=0.0):
    return center(df, layout, "mean", by, reference, anchor)


def zscore_normalize(df: DataFrame, layout, by=(), reference: DataFrame | None = None) -> DataFrame:
    """Log, then (x - mean) / sd; a constant or single value is left as its log."""
    df, layout = log_transform(df, layout), logged(layout)
    stats = reference if reference is not None else layout.summarise(df, by, {"mean": F.avg, "std": F.stddev_samp})
    return layout.apply(df, stats, lambda x, s: F.when(holds(s("std") > 0), F.try_divide(x - s("mean"), s("std"))).otherwise(x), by)


def robust_scale(df: DataFrame, layout, by=(), accuracy: int | None = None) -> DataFrame:
    """Log, then (x - median) / IQR where the IQR is positive."""
    df, layout = log_transform(df, layout), logged(layout)
    stats = layout.summarise(df, by, probs={"q1": 0.25, "q2": 0.5, "q3": 0.75}, accuracy=accuracy)

    def scaled(x, s):
        width = s("q3") - s("q1")
        return F.when(holds(width > 0), F.try_divide(x - s("q2"), width)).otherwise(x)

    return layout.apply(df, stats, scaled, by)


def quantile_normalize(df: DataFrame, layout: Long, sample: str = "sample_id", log: bool = True) -> DataFrame:
    """Give every sample the same distribution: the mean over samples at each within-sample rank.

    Equal values of a sample are ranked by md5 of the feature id.  The rows are evaluated and ranked once, and stored:
    means and result read the same ranks.  Runs jobs.
    """
    if log:
        df, layout = log_transform(df, layout), logged(layout)
    known = df.withColumn(layout.value, number(layout.value)).where(F.col(layout.value).isNotNull())
    ranked = sorted_row_number(known, [sample], layout.feature, order=layout.value, name="__rank")
    targets = ranked.groupBy("__rank").agg(F.avg(layout.value).alias("__target"))
    # A rank holds a row of every sample: such keys are looked up by measured size, not dealt by a shuffle.
    return attach_checked(ranked, targets, ["__rank"], "inner").withColumn(layout.value, F.col("__target")).select(*df.columns)


def normalize(df: DataFrame, layout, method: str = "log_median_centering", by=(), reference=None, sample: str = "sample_id",
              accuracy: int | None = None) -> DataFrame:
    """Normalisation by name; an unknown name only takes logs."""
    if method == "log_median_centering":
        return center_median(df, layout, by, reference, accuracy=accuracy)
    if method == "log_mean_centering":
        return center_mean(df, layout, by, reference)
    if method == "zscore":
        return zscore_normalize(df, layout, by, reference)
    if method == "quantile":
        return robust_scale(df, layout, by, accuracy)
    if method == "rank_quantile":
        return quantile_normalize(df, layout, sample)
    return log_transform(df, layout)


def fit_batch(train: DataFrame, layout, site: str = "site", accuracy: int | None = None) -> DataFrame:
    """Feature medians per site, with the overall medians beside them, from training rows."""
    probs = {"median": 0.5}
    return layout.merge(layout.summarise(train, [site], probs=probs, accuracy=accuracy, interpolate=True),
                        layout.summarise(train, probs=probs, accuracy=accuracy, interpolate=True))


def apply_batch(df: DataFrame, layout, fitted: DataFrame, site: str = "site") -> DataFrame:
    """x - site median + overall median; a site unseen in training counts as the overall median."""
    return layout.apply(df, fitted, lambda x, s: F.coalesce(x - s("median") + s("all_median"), x), [site])


def batch_correct(df: DataFrame, layout, site: str = "site", train: DataFrame | None = None, accuracy: int | None = None) -> DataFrame:
    """Median centring per site, with medians of the training rows (all rows by default)."""
    return apply_batch(df, layout, fit_batch(df if train is None else train, layout, site, accuracy), site)


def fit_scale(train: DataFrame, layout) -> DataFrame:
    return layout.summarise(train, aggs={"mean": F.avg, "sd": F.stddev_pop})


def apply_scale(df: DataFrame, layout, stats: DataFrame) -> DataFrame:
    """(x - mean) / population sd; a constant feature is only centred."""
    return layout.apply(df, stats, lambda x, s: (x - s("mean")) / F.when(holds(s("sd") > 0), s("sd")).otherwise(1.0))


def standard_scale(df: DataFrame, layout, train: DataFrame | None = None) -> DataFrame:
    return apply_scale(df, layout, fit_scale(df if train is None else train, layout))


# The same corrections on one array column, for model inputs of many columns: the plan then holds a
# handful of expressions whatever the number of features.

def as_vector(columns):
    """Array of the columns as doubles, NaN as null."""
    return F.expr("array(" + ", ".join(f"nanvl(CAST({quoted(c)} AS DOUBLE), CAST(NULL AS DOUBLE))" for c in columns) + ")")


def constants(values):
    return F.expr("array(" + ", ".join(f"CAST({float(v)!r} AS DOUBLE)" for v in values) + ")")


def fit_shift(train: DataFrame, columns, site: str = "site") -> DataFrame:
    """Per site the amounts (overall median - site median) to add, as array ``shift`` in column order."""
    columns = list(columns)
    casts = [f"nanvl(CAST({quoted(c)} AS DOUBLE), CAST(NULL AS DOUBLE)) AS `{c}`" for c in columns]
    melted = train.selectExpr(f"`{site}`", *casts).unpivot([site], columns, "__f", "__x")
    per_site = exact_quantiles(melted, [site, "__f"], "__x", [0.5]).select(site, "__f", F.col("q")[0].alias("m"))
    overall = exact_quantiles(melted, ["__f"], "__x", [0.5]).select("__f", F.col("q")[0].alias("g"))
    moves = attach(per_site, overall, ["__f"]).groupBy(site).agg(
        F.map_from_entries(F.collect_list(F.struct("__f", F.col("g") - F.col("m")))).alias("__m"))
    names = F.expr("array(" + ", ".join(repr(c) for c in columns) + ")")
    return moves.select(site, F.transform(names, lambda n: F.coalesce(F.col("__m")[n], F.lit(0.0))).alias("shift"))


def apply_shift(df: DataFrame, vector: str, shifts: DataFrame, size: int, site: str = "site") -> DataFrame:
    """Add the site's shift, of ``size`` numbers, to the vector; an unseen site stays as it is."""
    held = attach_checked(df, shifts, [site], cells_per_row=size + 1)
    moved = F.zip_with(vector, F.coalesce("shift", F.array().cast("array<double>")), lambda x, s: x + F.coalesce(s, F.lit(0.0)))
    return held.withColumn(vector, moved).drop("shift")


def fit_vector_scale(df: DataFrame, vector: str, size: int) -> tuple[list[float], list[float]]:
    """Means and population standard deviations (1 for constant positions) of a vector; one row is fetched."""
    row = df.select(vector).selectExpr(*[f"avg(`{vector}`[{i}]) AS m{i}" for i in range(size)],
                                       *[f"stddev_pop(`{vector}`[{i}]) AS s{i}" for i in range(size)]).first()
    return [float(row[f"m{i}"] or 0.0) for i in range(size)], [float(row[f"s{i}"] or 1.0) for i in range(size)]


def apply_vector_scale(vector, means, sds):
    """(x - mean) / sd, with missing values at the mean."""
    centred = F.zip_with(vector, constants(means), lambda x, m: x - m)
    return F.zip_with(centred, constants(sds), lambda x, s: F.coalesce(x / s, F.lit(0.0)))
