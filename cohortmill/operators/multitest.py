"""Multiple-testing correction as distributed scans over distinct p-values."""

from enum import Enum

from pyspark.sql import DataFrame, functions as F

from ..functions.nulls import holds, number
from ..functions.relate import SALTS, attach
from .ranking import chunked, running


class Correction(str, Enum):
    FDR_BH = "fdr_bh"
    HOLM = "holm"
    BONFERRONI = "bonferroni"


def adjust(df: DataFrame, method="fdr_bh", alpha: float = 0.05, p_value: str = "p_value", families=()) -> DataFrame:
    """Adds ``p_value_corrected`` and ``significant`` (corrected <= alpha).

    Each distinct combination of ``families`` is corrected on its own; null is a family.  Rows
    without a p-value are left out.  Equal p-values share one adjusted value, so the scans run
    over distinct values and the result is joined back.
    """
    method = Correction(method)
    families = list(families)
    tested = df.withColumn(p_value, number(p_value)).where(F.col(p_value).isNotNull())
    if method is Correction.BONFERRONI:
        sizes = tested.groupBy(*families).agg(F.count(F.lit(1)).alias("__n"))
        adjusted = attach(tested, sizes, families, salts=SALTS).withColumn("__q", F.col(p_value) * F.col("__n")).drop("__n")
    else:
        values = tested.groupBy(*families, p_value).agg(F.count(F.lit(1)).alias("__c"))
        ranked = running(chunked(values, families, p_value, F.col("__c")), families, p_value, "__rank", "sum", F.col("__c"))
        if method is Correction.FDR_BH:
            step = F.col(p_value) * F.col("__n") / F.col("__rank")
            scanned = running(ranked, families, p_value, "__q", "min", step, descending=True)
        else:
            first_rank = F.col("__rank") - F.col("__c")
            step = F.col(p_value) * (F.col("__n") - first_rank)
            scanned = running(ranked, families, p_value, "__q", "max", step)
        adjusted = attach(tested, scanned.select(*families, p_value, "__q"), [*families, p_value], salts=SALTS)
    return adjusted.withColumn("p_value_corrected", F.least(F.col("__q"), F.lit(1.0))).drop("__q") \
        .withColumn("significant", holds(F.col("p_value_corrected") <= alpha))


def adjust_by_class(df: DataFrame, method="fdr_bh", alpha: float = 0.05, p_value: str = "p_value",
                    compound_class: str = "compound_class") -> DataFrame:
    """Correction within each compound class; rows without a class form one family."""
    families = [compound_class] if compound_class in df.columns else []
    return adjust(df, method, alpha, p_value, families)


def adjust_by_group_annotation(df: DataFrame, method="fdr_bh", alpha: float = 0.05, p_value: str = "p_value",
                               group: str = "group", compound_id: str = "compound_id") -> DataFrame:
    """Correction within (group, has an annotation); keeps the flag as ``has_id``."""
    flagged = df.withColumn("has_id", F.col(compound_id).isNotNull())
    return adjust(flagged, method, alpha, p_value, [group, "has_id"])


def false_discovery(df: DataFrame, alpha: float = 0.05, p_value: str = "p_value") -> DataFrame:
    return adjust(df, Correction.FDR_BH, alpha, p_value)


def bonferroni(df: DataFrame, alpha: float = 0.05, p_value: str = "p_value") -> DataFrame:
    return adjust(df, Correction.BONFERRONI, alpha, p_value)
