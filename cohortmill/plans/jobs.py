"""The user-facing jobs.  Inputs and outputs are DataFrames; writing them is up to the caller."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.nulls import holds
from ..functions.relate import cut_lineage
from ..operators import assoc, boosting, cohort, derive, explore, impute, joins, select, shapes, stats
from ..operators.layout import Wide

DISCOVERY_STEPS = ("cohorts", "integration", "scan", "comparison")


@dataclass(frozen=True)
class DiscoveryInputs:
    """Cleaned-name metadata, filtered manifest, intensities with site, alignment, annotation, earlier run."""

    metadata: DataFrame
    manifest: DataFrame
    intensity: DataFrame
    alignment: DataFrame
    annotation: DataFrame
    previous: DataFrame | None = None


def prepare_metadata(metadata: DataFrame, manifest: DataFrame) -> DataFrame:
    """Negative codes to null, flags completed per subject, derived fields, samples in the manifest."""
    cleaned = impute.subject_binary_impute(derive.negative_to_null(metadata))
    fields = derive.derived_fields(derive.derive_flags(cleaned))
    return joins.with_manifest(fields.drop("sample_id"), manifest)


def discover(inputs: DiscoveryInputs, outcome: str, steps=DISCOVERY_STEPS, value: str = "intensity_fill_log_scaled",
             covariates=("pw_age", "ga_weeks"), categorical=("site",), alpha: float = 0.05, method: str = "fdr_bh") -> dict[str, DataFrame]:
    """Cohorts, regression input, corrected results and comparison, as far as ``steps`` asks.

    The regression input and the fitted results are checkpointed, since several plans start from them.
    """
    out: dict[str, DataFrame] = {}
    prepared = cut_lineage(prepare_metadata(inputs.metadata, inputs.manifest))
    parts = cohort.cohorts(prepared, outcome, ["sample_id"])
    out |= {f"cohort_{role}": df for role, df in parts.items()}
    out["attrition"] = cohort.cohort_attrition(prepared, outcome, ["sample_id"])
    if "integration" not in steps and "scan" not in steps:
        return out
    labelled = cohort.strata_concat(parts, outcome)
    out["duplicates"] = stats.duplicate_ids_per_group(labelled)
    aligned = joins.with_alignment(inputs.intensity, inputs.alignment).select("sample_id", "unique_feature_label", value)
    rows = derive.outcome_column(cohort.analyses(labelled, outcome), outcome)
    wanted = list(dict.fromkeys(["sample_id", "analysis", outcome, *covariates, *categorical]))
    regression = rows.select(*wanted).join(aligned, "sample_id")
    out["regression_input"] = cut_lineage(regression)
    if "scan" not in steps:
        return out
    out["results"] = cut_lineage(assoc.discovery_scan(
        out["regression_input"], inputs.annotation, outcome, value, covariates, categorical, method, alpha))
    if "comparison" in steps and inputs.previous is not None:
        compared = joins.compare_results(select.load_new_results(out["results"]), select.load_previous_results(inputs.previous))
        out["comparison"] = compared
        out["comparison_summary"] = stats.comparison_summary(compared)
        out["notable"] = select.notable_features(compared, outcome)
    return out


def curate(metadata: DataFrame, outcome: str, n_splits: int = 6, seed=1500) -> DataFrame:
    """Metadata as the risk model needs it: eligible, renamed, outcome, subject populations, splits."""
    named = derive.rename_map(derive.outcome_column(derive.eligible(metadata), outcome, by_priority=True)).withColumns(
        {"ga_weeks": derive.weeks("ga_sample_days"), "ga_birth_weeks": derive.weeks("ga_birth_days")})
    flagged = stats.subject_flags_join(derive.population_flags(named, outcome))
    return cohort.stratified_splits(flagged, outcome, n_splits, seed)


def make_dataset(kind: str, curated: DataFrame, intensity: DataFrame, features, outcome: str) -> DataFrame:
    if kind == "biosample":
        return shapes.dataset_biosample(curated, intensity, features)
    if kind == "window":
        return shapes.dataset_window(curated, intensity, features)
    if kind == "subject":
        return shapes.dataset_subject(curated, intensity, features, outcome)
    raise ValueError(f"unknown dataset type: {kind}")


def explore_dataset(dataset: DataFrame, features, outcome: str, key: str = "sample_id", subject: str = "subject_id",
                    n_components: int = 10, max_features: int | None = None) -> dict[str, DataFrame]:
    """Characteristics, counts, site statistics, components, batch effects and correlations of a dataset.

    Correlations cover all features, or the ``max_features`` most variable ones if asked for.
    """
    features = list(features)
    long = shapes.melt(dataset, list(dict.fromkeys([key, "site"])), features)
    flags = [c for c in derive.POPULATIONS if c in dataset.columns]
    layout = Wide(features)
    feature_stats = select.feature_stats(dataset, layout)
    top = features if max_features is None else [r[0] for r in select.top_features(feature_stats, max_features).select("feature_id").collect()]
    corr = cut_lineage(explore.feature_corr_matrix(dataset, top))
    fitted = explore.fit_pca(dataset, layout, n_components, "site", fill=0.0)
    covariates = boosting.covariates_for("biosample", dataset)
    return {
        "characteristics": stats.dataset_characteristics(long, dataset, outcome, flags, subject=subject),
        "sites": stats.group_counts(dataset, "site"),
        "site_statistics": stats.site_statistics(long, sample=key),
        "pca_scores": explore.pca_scores(fitted, [key, "site"]),
        "pca_variance": explore.pca_variance(dataset.sparkSession, fitted),
        "pca_loadings": explore.pca_loadings(dataset.sparkSession, fitted, layout),
        "batch_effects": explore.batch_effect_report(dataset.fillna(0.0, subset=features), layout, "site", key),
        "correlations": corr,
        "correlation_summary": explore.correlation_summary(corr),
        "high_corr_pairs": explore.high_corr_pairs(corr),
        "covariate_correlations": explore.feature_covariate_corr(dataset, top, covariates),
    }


def predict(curated: DataFrame, intensity: DataFrame, features, outcome: str, kind: str = "biosample", who: str = "all",
            n_trials: int = 150, seed=1500, samplers=("random", "near_miss", "tomek"), n_splits: int = 6) -> dict:
    """Dataset, tuning, final model, lockbox metrics and importance for the given features."""
    features = [str(f) for f in features]
    dataset = cut_lineage(make_dataset(kind, curated, intensity, features, outcome))
    key = "subject_id" if kind == "subject" else "sample_id"
    columns = [*features, *[f"{f}_auc" for f in features]] if kind == "subject" else features
    filled = derive.population(dataset, who)
    # the lockbox takes no part in any choice
    rates = select.feature_stats(filled.where(~holds(F.col("dataset_assignment") == cohort.LOCKBOX)), Wide(columns))
    present = {r[0] for r in select.keep_by_missing(rates, 0.0).select("feature_id").collect()}
    usable = [c for c in columns if c in present]
    if not usable:
        raise ValueError("no feature without missing values; impute the intensities first")
    covariates = boosting.covariates_for(kind, dataset)
    best, trials = boosting.tune_random_search(
        filled, usable, covariates, outcome, key, n_trials, seed=seed, samplers=samplers, n_splits=n_splits)
    model, final = boosting.final_model(filled, usable, covariates, outcome, key, best, seed=seed)
    return {"dataset": dataset, "features": usable, "best": best, "trials": trials, "model": model, "final_metrics": final,
            "lockbox_metrics": boosting.lockbox_evaluate(model, dataset, outcome, who=who),
            "tree_importance": boosting.tree_importance(model)}


def choose_features(results: DataFrame, mode: str = "auto", n: int = 100, user_list=None, **criteria) -> DataFrame:
    """Feature selection by mode: ``auto``, ``balanced``, ``user_specified``, ``top_n`` or ``criteria``."""
    feature = "unique_feature_label"
    if mode == "user_specified":
        return select.select_user_list(results.select(feature).distinct(), user_list or [], feature)
    if mode == "top_n":
        return select.top_significant(results, n).select(feature)
    if mode == "criteria":
        return select.select_by_criteria(results, **criteria)
    if mode == "balanced":
        return select.select_auto_balanced(results, n).select(feature)
    if mode == "auto":
        return select.select_auto(results, user_list, n)
    raise ValueError(f"unknown selection mode: {mode}")


def full(inputs: DiscoveryInputs, outcome: str, run: str = "full", mode: str = "auto", n: int = 100, user_list=None, results: DataFrame | None = None,
         value: str = "intensity_fill_log_scaled", **predict_options) -> dict:
    """``full``, ``discovery`` or ``ml``; the last takes ``results`` of an earlier discovery.

    Where selection finds no feature there is nothing to model: ``selected`` is empty and ``model`` absent.
    """
    out: dict = {"outcome": outcome, "mode": mode}
    if run in ("full", "discovery"):
        out["discovery"] = discover(inputs, outcome, value=value)
        results = out["discovery"]["results"]
    if run in ("full", "ml"):
        if results is None:
            raise ValueError("results of a discovery are needed")
        chosen = [r[0] for r in choose_features(results, mode, n, user_list).collect()]
        out["selected"] = chosen
        if not chosen:
            return out
        curated = curate(prepare_metadata(inputs.metadata, inputs.manifest), outcome)
        intensity = joins.with_alignment(inputs.intensity, inputs.alignment) \
            .select("sample_id", F.col("unique_feature_label").alias("feature_id"), F.col(value).alias("value"))
        out["model"] = predict(cut_lineage(curated), intensity, chosen, outcome, **predict_options)
    return out


def run_summary(spark, out: dict) -> DataFrame:
    """Key figures of a run as (item, value) rows."""
    rows = [("outcome", out["outcome"]), ("selection_mode", out["mode"]), ("selected_features", str(len(out.get("selected", []))))]
    found = out.get("discovery")
    if found:
        rows.append(("cases", str(found["cohort_case"].count())))
        if "results" in found:
            rows.append(("significant_features", str(found["results"].where("significant").select("unique_feature_label").distinct().count())))
    if "model" in out:
        best = out["model"]["best"]
        rows += [("features_used", str(len(out["model"]["features"]))), ("best_model", f"boosted trees, depth {best.max_depth}, {best.n_estimators} trees")]
        metrics = out["model"]["lockbox_metrics"].first().asDict()
        rows += [(k, str(v)) for k, v in metrics.items() if k.startswith(("AUROC", "MCC", "PPV"))]
    return spark.createDataFrame(rows, "item string, value string")
