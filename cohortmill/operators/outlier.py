"""Outliers by interquartile range or z-score: remove, cap or flag."""

from pyspark.sql import DataFrame, functions as F

from ..functions.nulls import holds


def bounds(df: DataFrame, layout, method: str = "iqr", accuracy: int | None = None) -> DataFrame:
    if method == "iqr":
        return layout.summarise(df, probs={"q1": 0.25, "q3": 0.75}, accuracy=accuracy)
    return layout.summarise(df, aggs={"mean": F.avg, "sd": F.stddev_samp})


def _limits(method, s, threshold):
    """Lower and upper limit, and whether the rule applies at all."""
    if method == "iqr":
        width = (s("q3") - s("q1")) * threshold
        return s("q1") - width, s("q3") + width, F.lit(True)
    width = s("sd") * threshold
    return s("mean") - width, s("mean") + width, holds(s("sd") > 0)


def handle_outliers(df: DataFrame, layout, method: str = "iqr", threshold: float = 3.0, action: str = "cap",
                    accuracy: int | None = None, sequential: bool = False) -> DataFrame:
    """Apply ``action`` (``remove``, ``cap``, ``flag``) outside the limits.

    All limits come from the incoming data in one aggregation.  ``sequential`` (wide tables only)
    treats one column after the other, so that a removal shifts the limits of the next column.
    A constant column has no z-score and stays untouched; an unknown method changes nothing.
    """
    if method not in ("iqr", "zscore") or action not in ("remove", "cap", "flag"):
        return df
    if sequential:
        for c in layout.values():
            df = handle_outliers(df, type(layout)([c]), method, threshold, action, accuracy)
        return df
    stats = bounds(df, layout, method, accuracy)

    def inside(x, s):
        low, high, applies = _limits(method, s, threshold)
        return ~applies | holds((x >= low) & (x <= high))

    def capped(x, s):
        low, high, applies = _limits(method, s, threshold)
        return F.when(applies & (x < low), low).when(applies & (x > high), high).otherwise(x)

    def flagged(x, s):
        low, high, applies = _limits(method, s, threshold)
        return applies & holds((x < low) | (x > high))

    if action == "remove":
        return layout.keep(df, stats, inside)
    if action == "cap":
        return layout.apply(df, stats, capped)
    return layout.apply(df, stats, flagged, name=lambda c: f"{c}_outlier")
