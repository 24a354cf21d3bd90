"""Filling or dropping missing values."""

from pyspark.sql import DataFrame, functions as F

from ..functions.nulls import complete
from ..functions.relate import SALTS, attach


def impute_drop(df: DataFrame, layout) -> DataFrame:
    """Drop rows with a missing (null or NaN) value in any feature."""
    return df.where(complete(layout.values()))


def impute_zero(df: DataFrame, layout) -> DataFrame:
    return layout.project(df, lambda x: F.coalesce(x, F.lit(0.0)))


def fill_values(df: DataFrame, layout, method: str = "median", by=(), accuracy: int | None = None) -> DataFrame:
    """The statistic ``fill`` per feature (and group)."""
    if method == "mean":
        return layout.summarise(df, by, {"fill": F.avg})
    return layout.summarise(df, by, probs={"fill": 0.5}, accuracy=accuracy)


def impute(df: DataFrame, layout, method: str = "median", by=(), accuracy: int | None = None) -> DataFrame:
    """``drop``, ``zero``, ``mean`` or ``median`` (also for unknown names), optionally per group.

    Group statistics are aggregated map-side and joined back; no window gathers a whole group.
    """
    if method == "drop":
        return impute_drop(df, layout)
    if method == "zero":
        return impute_zero(df, layout)
    stats = fill_values(df, layout, method, by, accuracy)
    return layout.apply(df, stats, lambda x, s: F.coalesce(x, s("fill")), by)


# Flags completed from the other visits of the same subject.
BINARY_COLUMNS = ("chron_htn", "diabetes", "fetal_anomalies", "cong_anomalies", "syphilis", "hiv", "malaria", "tb")


def subject_fill(df: DataFrame, columns=BINARY_COLUMNS, subject=("site", "orig_id")) -> DataFrame:
    """Per subject, the value of each flag if all known ones agree and it is 0 or 1, else null."""
    agreed = {c: F.when((F.min(c) == F.max(c)) & F.min(c).isin(0, 1), F.min(c)) for c in columns}
    return df.groupBy(*subject).agg(*[e.alias(c) for c, e in agreed.items()])


def subject_binary_impute(df: DataFrame, columns=BINARY_COLUMNS, subject=("site", "orig_id")) -> DataFrame:
    """Missing flags take the subject's fill value; all flags in one pass."""
    columns = [c for c in columns if c in df.columns]
    fills = subject_fill(df, columns, subject).withColumnsRenamed({c: f"{c}_fill" for c in columns})
    filled = attach(df, fills, list(subject), salts=SALTS)
    return filled.withColumns({c: F.coalesce(c, f"{c}_fill") for c in columns}).drop(*[f"{c}_fill" for c in columns])
