"""Classifying descriptions by ordered substring rules: the first rule that matches wins."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nulls import col


def label_by_rules(c, rules: list[tuple[tuple[str, ...], str]], default: str) -> Column:
    """Label of the first rule of which any substring occurs in the lower-cased text."""
    text = F.lower(col(c))
    out = None
    for parts, label in rules:
        hit = None
        for part in parts:
            found = text.contains(part)
            hit = found if hit is None else hit | found
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


# Categories of input and result paths.
DATA_TYPES = [
    (("meta_data", "metadata", "manifest"), "metadata"),
    (("preprocessed_maternal_data", "intensities", "intensity_data"), "intensity_data"),
    (("regression_analysis", "analysis_results"), "analysis_result"),
    (("deliverables",), "deliverable"),
    (("alignment",), "alignment_data"),
]


def path_inventory(df: DataFrame, rules: dict[str, tuple[list, str]], constants: dict[str, str] | None = None, description: str = "description",
                   path: str = "file_path", remote: str = "s3") -> DataFrame:
    """The rows of ``df`` with ``constants``, one label column for each entry of ``rules``, and ``data_source``.

    ``rules`` maps a column name to its ordered rules and the label of what none of them matches; the
    caller brings the rules of its own sites.
    """
    fixed = {name: F.lit(value) for name, value in (constants or {}).items()}
    labels = {name: label_by_rules(description, own, default) for name, (own, default) in rules.items()}
    return df.withColumns(fixed | labels | {"data_source": F.when(F.col(path).startswith(f"{remote}://"), remote).otherwise("local")})
