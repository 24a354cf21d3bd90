"""The cleaning sequence: quality filter, imputation, outliers."""

from pyspark.sql import DataFrame

from .impute import impute
from .outlier import handle_outliers
from .select import drop_low_quality


def clean_intensity(df: DataFrame, layout, missing: float = 0.5, zero: float = 0.3, imputation: str = "median",
                    outliers: str | None = "iqr", threshold: float = 3.0, action: str = "cap", accuracy: int | None = None):
    """(cleaned rows, layout of the features that remain)."""
    rows, kept, _ = drop_low_quality(df, layout, missing, zero)
    remaining = kept if hasattr(layout, "as_rows") else layout
    rows = impute(rows, remaining, imputation, accuracy=accuracy)
    if outliers:
        rows = handle_outliers(rows, remaining, outliers, threshold, action, accuracy)
    return rows, remaining
