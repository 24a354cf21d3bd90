"""Projections, derived columns and row predicates."""

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nulls import all_of, any_of, col, holds, ne, not_in, numeric_columns


def normalize_column_names(df: DataFrame, aliases: dict[str, str] | None = None, drop_pattern: str = "^unnamed") -> DataFrame:
    """Lower-case the names, rename aliases that are present, drop columns whose name matches."""
    aliases = {k.lower(): v.lower() for k, v in (aliases or {}).items()}
    kept = [c for c in df.columns if not (drop_pattern and re.search(drop_pattern, c, re.IGNORECASE))]
    return df.select(*[F.col(f"`{c}`").alias(aliases.get(c.lower(), c.lower())) for c in kept])


def trim_key(df: DataFrame, *keys: str) -> DataFrame:
    """Identifiers as trimmed strings; null stays null."""
    return df.withColumns({k: F.trim(F.col(k).cast("string")) for k in keys})


def parse_date(c, pattern: str = "ddMMMyyyy") -> Column:
    """Text such as ``05DEC2024`` to a date; text that does not parse gives null."""
    return F.try_to_date(F.initcap(F.lower(col(c))), pattern)


def split_prefix(c, separator: str = "-") -> Column:
    """Text before the first separator."""
    return F.substring_index(col(c), separator, 1)


def split_suffix_where(c, condition: Column, separator: str = "_") -> Column:
    """Text after the last separator where the condition holds, else the text unchanged."""
    return F.when(holds(condition), F.substring_index(col(c), separator, -1)).otherwise(col(c))


def derive_flags(df: DataFrame) -> DataFrame:
    """Boolean ``severe_ptb``, ``eope`` and ``lope``; a missing code counts as false."""
    return df.withColumns({
        "severe_ptb": holds(F.col("very_ptb") == 1) | holds(F.col("ext_ptb") == 1),
        "eope": holds(F.col("pe_cat") == "EOPE"),
        "lope": holds(F.col("pe_cat") == "LOPE"),
    })


# How each outcome is read from the subject codes.
OUTCOMES = {
    "eope": {"column": "pe_new", "case": "pe_new = 1 AND pe_cat = 'EOPE'", "priority": "pe_priority IN (1, 2)"},
    "lope": {"column": "pe_new", "case": "pe_new = 1 AND pe_cat = 'LOPE'", "priority": "pe_priority IN (1, 2)"},
    "sb": {"column": "sb_new", "case": "sb_new = 1", "priority": "sb_priority IN (1, 2)"},
    "ptb": {"column": "ptb_new", "case": "ptb_new = 1", "priority": None},
    "sga": {"column": "sga_10", "case": "sga_10 = 1", "priority": None},
}


def outcome_column(df: DataFrame, outcome: str, by_priority: bool = False) -> DataFrame:
    """0/1 column named after the outcome.

    For eope and lope the code is ``pe_new = 1`` (association analysis) or, with ``by_priority``,
    ``pe_priority in (1, 2)`` (risk model); the category must match in both.
    """
    if outcome in ("eope", "lope"):
        gate = F.col("pe_priority").isin(1, 2) if by_priority else F.col("pe_new") == 1
        hit = gate & (F.col("pe_cat") == outcome.upper())
    else:
        hit = F.expr(OUTCOMES[outcome]["case"])
    return df.withColumn(outcome, holds(hit).cast("int"))


def exclude_value(df: DataFrame, column: str, value) -> DataFrame:
    """Drop one value, keep nulls."""
    return df.where(ne(column, value))


def negative_to_null(df: DataFrame, columns=None) -> DataFrame:
    """Negative codes in numeric columns (all of them by default) become null, in one projection."""
    wanted = set(numeric_columns(df) if columns is None else columns)
    return df.select(*[F.when(F.col(c) >= 0, F.col(c)).alias(c) if c in wanted else F.col(c) for c in df.columns])


def weeks(days) -> Column:
    """Completed weeks, counting a started one: floor((days + 6) / 7)."""
    return F.floor((col(days) + 6) / 7).cast("long")


def body_mass_index(weight, height_cm) -> Column:
    metres = col(height_cm) / 100.0
    return F.try_divide(col(weight).cast("double"), metres * metres)


def derived_fields(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ga_weeks": weeks("ga_hdlk_new"),
        "gagebrth_weeks": weeks("gagebrth_new"),
        "bmi": body_mass_index("mat_weight", "mat_height"),
    })


# Raw code names and the names used by the risk model.
CURATED_NAMES = {
    "ga_hdlk_new": "ga_sample_days",
    "gagebrth_new": "ga_birth_days",
    "pw_age": "maternal_age",
    "chron_htn": "chronic_hypertension",
    "cong_anomalies": "congenital_anomalies",
    "smoke_hist": "smoking_history",
    "parity": "n_previous_pregnancies",
    "passive_smok": "smoking_exposure",
    "prev_sb": "n_previous_stillbirth",
    "prev_mis": "n_previous_miscarriage",
    "alcohol": "alcohol_history",
    "sniff_toba": "tobacco_history",
    "tb": "tuberculosis",
}


def rename_map(df: DataFrame, names: dict[str, str] = CURATED_NAMES) -> DataFrame:
    return df.withColumnsRenamed(names)


def select_available(df: DataFrame, wanted) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def compose_label(label, compound_id, separator: str = "\n") -> Column:
    """``label<newline>id`` for annotated features, else the label."""
    return F.when(col(compound_id).isNotNull(), F.concat_ws(separator, col(label), col(compound_id))).otherwise(col(label))


def eligible(df: DataFrame) -> DataFrame:
    """Single births with known age at sampling, age at birth and maternal age (raw names)."""
    return df.where(F.col("single_twin") == 1).dropna(subset=["gagebrth_new", "ga_hdlk_new", "pw_age"])


def healthy_control(outcome: str) -> Column:
    """Term birth of normal weight without the outcome, chronic disease, anomaly or infection."""
    absent = ["chronic_hypertension", "diabetes", "fetal_anomalies", "congenital_anomalies", "hiv", "malaria", "tuberculosis"]
    return holds(all_of([
        F.col(outcome) == 0,
        F.col("ga_birth_days") >= 273, F.col("ga_birth_days") < 287,
        F.col("birth_weight") >= 2500,
        *[ne(c, 1) for c in absent],
        not_in("syphilis", [1, 2]),
    ]))


def high_risk() -> Column:
    present = ["chronic_hypertension", "diabetes", "hiv", "malaria", "tuberculosis"]
    return any_of([
        holds(F.col("maternal_age") >= 35),
        holds(F.col("smoking_history").isin(2, 3, 4)),
        holds(F.col("alcohol_history").isin(2, 3, 4)),
        holds(F.col("syphilis").isin(1, 2)),
        holds(F.col("bmi") >= 30),
        *[holds(F.col(c) == 1) for c in present],
    ])


def high_risk_broad() -> Column:
    return any_of([
        high_risk(),
        holds(F.col("n_previous_pregnancies") == 0),
        holds(F.col("smoking_exposure") == 1),
        holds(F.col("n_previous_miscarriage") > 0),
        holds(F.col("n_previous_stillbirth") > 0),
        holds(F.col("wealth_index").isin(1, 2)),
    ])


POPULATIONS = ("healthy_control", "high_risk", "high_risk_broad")


def population_flags(df: DataFrame, outcome: str) -> DataFrame:
    """Sample-level flags, before they are made uniform per subject."""
    return df.withColumns({
        "healthy_control": healthy_control(outcome), "high_risk": high_risk(), "high_risk_broad": high_risk_broad()})


def drop_close_to_event(df: DataFrame, time: str = "ga_sample_days", event: str = "ga_birth_days", margin=14) -> DataFrame:
    """Drop samples taken within ``margin`` days before the event; an unknown event keeps the row."""
    return df.where(~holds(F.col(time) >= F.col(event) - margin))


def time_window(df: DataFrame, time: str = "ga_sample_days", start=63, size=120) -> DataFrame:
    """Rows with ``start <= time <= start + size``."""
    return df.where(F.col(time).between(start, start + size))


def population(df: DataFrame, name: str = "all") -> DataFrame:
    """Rows of a named population; an absent flag column or ``all`` keeps every row."""
    return df if name == "all" or name not in df.columns else df.where(holds(F.col(name)))


def holdout(df: DataFrame, keep: bool = False, label: str = "dataset_assignment", name: str = "lockbox") -> DataFrame:
    """Only the held-out rows, or all others."""
    return df.where(F.col(label) == name) if keep else df.where(ne(label, name))


def where_text(df: DataFrame, predicate: str | None) -> DataFrame:
    """Filter by a predicate given as SQL text; none keeps every row."""
    return df.where(F.expr(predicate)) if predicate else df
