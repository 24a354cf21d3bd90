"""Cohorts, strata, analyses, splits and folds."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nulls import all_of, holds, ne
from ..functions.relate import SALTS, attach, first_per_key
from .derive import OUTCOMES, select_available
from .ranking import spread_row_number
from .stats import attrition_counts

VISIT = ("site", "orig_id", "visitdt")

# Codes for unknown.
UNKNOWN_AGE, UNKNOWN_BIRTH = (-77, -88, -99), (-77, -88)


def base_steps(outcome: str) -> dict[str, Column]:
    """Ordered exclusions that apply to every subject."""
    steps = {
        "single birth": F.col("single_twin") == 1,
        "known gestational age": F.col("ga_hdlk_new").isNotNull(),
        "known maternal age": F.col("pw_age").isNotNull() & ~F.col("pw_age").isin(*UNKNOWN_AGE),
    }
    if outcome == "sb":
        steps["known birth outcome"] = F.col("birth_outcome").isNotNull() & ~F.col("birth_outcome").isin(*UNKNOWN_BIRTH)
        steps["outcome priority below 3"] = ne("sb_priority", 3)
    return steps


def control_steps() -> dict[str, Column]:
    """Ordered exclusions that make a control out of a non-case."""
    return {
        "term birth": (F.col("gagebrth_new") > 273) & (F.col("gagebrth_new") <= 287),
        "normal birth weight": F.col("birth_weight") >= 2500,
        "no chronic hypertension": ne("chron_htn", 1),
        "no diabetes": ne("diabetes", 1),
        "no anomalies": ne("fetal_anomalies", 1) & ne("cong_anomalies", 1),
        "no infection": ne("syphilis", 1) & ne("hiv", 1) & ne("malaria", 1) & ne("tb", 1),
    }


def case_rule(outcome: str) -> Column:
    rule = OUTCOMES[outcome]
    hit = F.expr(rule["case"])
    return holds(hit & F.expr(rule["priority"]) if rule["priority"] else hit)


def noncase_rule(outcome: str) -> Column:
    """Not affected; for stillbirth a recorded livebirth as well."""
    clear = F.col(OUTCOMES[outcome]["column"]) == 0
    return holds(clear & (F.col("birth_outcome") == 1) if outcome == "sb" else clear)


def cohorts(metadata: DataFrame, outcome: str, tiebreak, visit=VISIT) -> dict[str, DataFrame]:
    """``case``, ``noncase`` and ``control`` frames.

    Non-cases keep one row per visit, the one with the smallest ``tiebreak``; controls are the
    non-cases that pass ``control_steps``.
    """
    eligible = metadata.where(all_of(holds(c) for c in base_steps(outcome).values()))
    noncase = first_per_key(eligible.where(noncase_rule(outcome)), list(visit), [F.col(c) for c in tiebreak])
    return {
        "case": eligible.where(case_rule(outcome)),
        "noncase": noncase,
        "control": noncase.where(all_of(holds(c) for c in control_steps().values())),
    }


def cohort_attrition(metadata: DataFrame, outcome: str, tiebreak, subject=("site", "orig_id")) -> DataFrame:
    """Subjects after each step: the common exclusions, then the control exclusions."""
    common = attrition_counts(metadata, base_steps(outcome), subject).withColumn("stage", F.lit("eligible"))
    parts = cohorts(metadata, outcome, tiebreak)
    controls = attrition_counts(parts["noncase"], control_steps(), subject).withColumn("stage", F.lit("control"))
    cases = attrition_counts(parts["case"], {}, subject).withColumn("stage", F.lit("case"))
    return common.unionByName(controls).unionByName(cases)


# Fixed value: stratum boundary in weeks.
STRATUM_WEEKS = 20


def stratum(weeks: str = "ga_weeks", boundary=STRATUM_WEEKS) -> Column:
    """``lt20`` / ``gte20``; null when the week is unknown."""
    return F.when(F.col(weeks) < boundary, f"lt{boundary}").when(F.col(weeks) >= boundary, f"gte{boundary}")


def stratify(df: DataFrame, weeks: str = "ga_weeks") -> DataFrame:
    return df.withColumn("stratum", stratum(weeks)).where(F.col("stratum").isNotNull())


# Metadata carried into the association analysis (ga_weeks and severe flags included).
REGRESSION_COLUMNS = (
    "sample_id", "orig_id", "site", "pe_new", "pe_priority", "pe_cat", "sb_new", "ptb_new", "severe_ptb", "sga_3",
    "sga_10", "mat_height", "mat_weight", "bwt_centile_new", "chron_htn", "diabetes", "pw_age", "bmi", "ga_weeks",
)

SUFFIXES = {"case": "", "noncase": "_noncase", "control": "_control"}


def strata_concat(parts: dict[str, DataFrame], outcome: str, weeks: str = "ga_weeks", columns=REGRESSION_COLUMNS) -> DataFrame:
    """All cohorts and strata in one frame, labelled ``<outcome>[_noncase|_control]_<stratum>``.

    A sample may carry several labels.
    """
    out = None
    for role, df in parts.items():
        named = stratify(df, weeks).withColumn("group", F.concat(F.lit(f"{outcome}{SUFFIXES[role]}_"), "stratum"))
        named = select_available(named, ["group", *columns])
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out


def analyses(df: DataFrame, outcome: str, strata=("lt20", "gte20"), comparators=("control", "noncase")) -> DataFrame:
    """Rows of every analysis (case group and one comparator per stratum) in one pass.

    Adds ``analysis`` and ``is_case``; a case row serves all comparators of its stratum.
    """
    options = [
        F.struct(F.lit(f"{outcome}_{kind}_{s}").alias("analysis"), F.lit(label).alias("is_case"), F.lit(group).alias("group"))
        for s in strata for kind in comparators
        for label, group in ((1, f"{outcome}_{s}"), (0, f"{outcome}_{kind}_{s}"))
    ]
    matching = F.filter(F.array(*options), lambda o: o.getField("group") == F.col("group"))
    return df.withColumn("__a", F.explode(matching)).select(
        "*", F.col("__a.analysis").alias("analysis"), F.col("__a.is_case").alias("is_case")).drop("__a")


LOCKBOX = "lockbox"


def split_labels(n_splits: int) -> list[str]:
    return [f"fold_{i}" for i in range(n_splits - 1)] + [LOCKBOX]


def stratified_splits(df: DataFrame, outcome: str, n_splits: int = 6, seed=1500, subject: str = "subject_id", site: str = "site") -> DataFrame:
    """Subject-pure split labels, the last of which is the lockbox, as ``dataset_assignment``.

    Subjects are dealt in md5 order within strata of (any outcome, site, number of samples).
    """
    labels = F.array(*[F.lit(x) for x in split_labels(n_splits)])
    subjects = df.groupBy(subject).agg(
        F.max(F.col(outcome).cast("int")).alias("__o"), F.min(site).alias("__site"), F.count(F.lit(1)).alias("__n"))
    dealt = spread_row_number(subjects, ["__o", "__site", "__n"], subject, seed, name="__rn")
    assigned = dealt.select(subject, labels[((F.col("__rn") - 1) % n_splits).cast("int")].alias("dataset_assignment"))
    return attach(df.drop("dataset_assignment"), assigned, [subject], salts=SALTS)


def cv_folds(df: DataFrame, n_splits: int = 6, label: str = "dataset_assignment") -> DataFrame:
    """Every non-lockbox row once per fold, with ``is_validation``."""
    folds = F.array(*[F.lit(x) for x in split_labels(n_splits)[:-1]])
    return df.where(ne(label, LOCKBOX)).withColumn("fold", F.explode(folds)) \
        .withColumn("is_validation", holds(F.col("fold") == F.col(label)))
