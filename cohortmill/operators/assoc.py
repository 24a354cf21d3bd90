"""One logistic regression per feature, and the scan built on it.

Rows are packed into units.  Newton steps work on sums over units: over the dense terms, and sparse ones per
categorical level, which are eliminated from the equations.  One path serves any number of rows and levels.
"""

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type as pa_type

from ..functions.nulls import holds, number
from ..functions.relate import attach, attach_checked, deal, discard, shares, stored
from .joins import with_annotation
from .multitest import adjust

RESULT_FIELDS = T.StructType([
    T.StructField("estimate", T.DoubleType()), T.StructField("std_error", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()), T.StructField("ci_lower", T.DoubleType()),
    T.StructField("ci_upper", T.DoubleType()), T.StructField("log_likelihood", T.DoubleType()),
    T.StructField("null_log_likelihood", T.DoubleType()), T.StructField("n_observations", T.LongType()),
    T.StructField("is_converged", T.BooleanType()), T.StructField("singular_matrix_error", T.BooleanType()),
    T.StructField("perfect_separation_warning", T.BooleanType()), T.StructField("unexpected_error", T.StringType()),
    T.StructField("unexpected_warnings", T.StringType()),
])

MAX_STEPS, Z95 = 40, 1.96
DECREMENT = 1e-16            # Newton decrement that counts as converged
PERFECT = 1e-6               # log-likelihood per row closer to 0 than this means separation


def _blank(error: str | None, n: int = 0) -> dict:
    row = {f.name: None for f in RESULT_FIELDS.fields}
    return row | {"n_observations": n, "is_converged": False, "singular_matrix_error": False,
                  "perfect_separation_warning": False, "unexpected_error": error}


TOO_SMALL = "Insufficient sample size"
TOO_SMALL_VALID = "Insufficient valid data after removing missing values"
NO_VARIANCE = "No variance in outcome variable"


def _precheck(n_rows, n_valid, n_positive, min_rows) -> str | None:
    if n_rows < min_rows:
        return TOO_SMALL
    if n_valid < min_rows:
        return TOO_SMALL_VALID
    return NO_VARIANCE if n_positive in (0, n_valid) else None


def _invert(information: np.ndarray) -> np.ndarray | None:
    """Inverse after scaling to unit diagonal, or None when numerically singular."""
    diagonal = np.diag(information)
    if not np.all(np.isfinite(information)) or np.any(diagonal <= 0):
        return None
    scale = np.sqrt(diagonal)
    scaled = information / np.outer(scale, scale)
    if np.linalg.cond(scaled) > 1e12:
        return None
    return np.linalg.inv(scaled) / np.outer(scale, scale)


@dataclass
class Newton:
    """Progress of one fit: coefficients ``beta`` of the dense terms (the value of interest first) and one intercept per level.

    ``advance`` takes the sums at the present point and moves on.
    """

    beta: np.ndarray
    levels: np.ndarray                      # sorted
    intercepts: np.ndarray
    base: np.ndarray | None = None
    base_intercepts: np.ndarray | None = None
    base_loglik: float = -math.inf
    loglik: float | None = None
    variance: float | None = None
    status: str = "running"
    blocks: tuple[tuple[int, ...], ...] = ()   # dense terms that are indicators of one covariate

    def at(self, levels: np.ndarray) -> np.ndarray:
        """Intercepts of the given levels; a level met for the first time starts at 0."""
        if not len(self.levels):
            return np.zeros(len(levels))
        place = np.minimum(np.searchsorted(self.levels, levels), len(self.levels) - 1)
        return np.where(self.levels[place] == levels, self.intercepts[place], 0.0)

    def advance(self, n: int, sums: "Sums") -> None:
        if not len(self.levels):
            self.levels, self.intercepts = sums.levels, np.zeros(len(sums.levels))
        loglik = sums.loglik
        if self.base is not None and loglik < self.base_loglik - 1e-9 * (1.0 + abs(self.base_loglik)):
            self.beta, self.intercepts = (self.beta + self.base) / 2.0, (self.intercepts + self.base_intercepts) / 2.0
            return
        # the levels' block of the information is diagonal: eliminated, it leaves the Schur complement of the dense terms
        keep = self._kept(np.diag(sums.information))
        weight, own = np.where(sums.weight > 0, sums.weight, np.inf), sums.cross[:, keep]
        cross = own / weight[:, None]
        information = sums.information[np.ix_(keep, keep)] - cross.T @ own
        gradient = sums.gradient[keep] - cross.T @ sums.residual
        lost = np.diag(information) <= 1e-12 * np.diag(sums.information)[keep]
        cov = None if lost.any() else _invert(information)
        if cov is None:
            self.status = "singular" if self.base is None else "separated"
            if self.base is not None:
                self.beta, self.intercepts = self.base, self.base_intercepts
            return
        self.loglik, self.variance = float(loglik), float(cov[0, 0])
        if loglik > -PERFECT * n:
            self.status = "separated"
            return
        step = np.zeros(len(self.beta))
        step[keep] = cov @ gradient
        moves = (sums.residual - sums.cross @ step) / weight
        if float(sums.gradient @ step + sums.residual @ moves) < DECREMENT:
            self.status = "converged"
            return
        self.base, self.base_intercepts, self.base_loglik = self.beta, self.intercepts, float(loglik)
        self.beta, self.intercepts = self.beta + step, self.intercepts + moves

    def _kept(self, diagonal: np.ndarray) -> list[int]:
        """Dense terms without the indicators of absent levels and, of every covariate, the first level present."""
        gone: set[int] = set()
        for block in self.blocks:
            present = [i for i in block if diagonal[i] > 0]
            gone |= set(block).difference(present) | set(present[:1])
        return [i for i in range(len(diagonal)) if i not in gone]

    def result(self, n, positives) -> dict:
        row = _blank(None, int(n))
        rate = positives / n
        row["null_log_likelihood"] = float(n * (rate * math.log(rate) + (1 - rate) * math.log(1 - rate)))
        row["is_converged"] = self.status == "converged"
        row["singular_matrix_error"] = self.status == "singular"
        row["perfect_separation_warning"] = self.status == "separated"
        if self.variance is not None:
            beta, se = float(self.beta[0]), math.sqrt(self.variance)
            row |= {"estimate": beta, "std_error": se, "ci_lower": beta - Z95 * se, "ci_upper": beta + Z95 * se,
                    "p_value": math.erfc(abs(beta / se) / math.sqrt(2.0)), "log_likelihood": self.loglik}
        if self.status == "running":
            row["unexpected_warnings"] = "Newton steps did not converge"
        return row


@dataclass
class Sums:
    """What rows add to a step: over the dense terms, and per level (sparse: only levels that occur)."""

    information: np.ndarray
    gradient: np.ndarray
    loglik: float
    levels: np.ndarray
    weight: np.ndarray
    cross: np.ndarray
    residual: np.ndarray

    @staticmethod
    def of(fit: Newton, x: np.ndarray, y: np.ndarray, levels: np.ndarray, code: np.ndarray) -> "Sums":
        eta = x @ fit.beta + fit.at(levels)[code]
        mu = 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
        w, rest = mu * (1 - mu), y - mu
        add = lambda v: np.bincount(code, v, len(levels))
        cross = np.stack([add(w * c) for c in x.T], axis=1)
        return Sums((x * w[:, None]).T @ x, x.T @ rest, float(np.sum(y * eta - np.logaddexp(0.0, eta))), levels, add(w), cross, add(rest))

    @staticmethod
    def together(parts: list["Sums"]) -> "Sums":
        if len(parts) == 1:
            return parts[0]
        levels, place = np.unique(np.concatenate([p.levels for p in parts]), return_inverse=True)

        def by_level(name):
            values = np.concatenate([getattr(p, name) for p in parts])
            out = np.zeros((len(levels), *values.shape[1:]))
            np.add.at(out, place, values)
            return out

        return Sums(sum(p.information for p in parts), sum(p.gradient for p in parts), sum(p.loglik for p in parts),
                    levels, by_level("weight"), by_level("cross"), by_level("residual"))


def _prepared(df, outcome, value, covariates, categorical, keys):
    numeric = ["__x", *[f"__n{i}" for i in range(len(covariates))]]
    classes = [f"__c{i}" for i in range(len(categorical))]
    rows = df.select(
        *keys, number(outcome).alias("__y"), number(value).alias("__x"),
        *[number(c).alias(n) for c, n in zip(covariates, numeric[1:])],
        *[F.col(c).cast("string").alias(n) for c, n in zip(categorical, classes)])
    complete = F.lit(True)
    for c in ["__y", *numeric, *classes]:
        complete = complete & F.col(c).isNotNull()
    return rows.withColumn("__ok", complete), numeric, classes


def _schema(df, keys):
    return T.StructType([*[df.schema[k] for k in keys], *RESULT_FIELDS.fields])


SUMS = "unit int, information binary, gradient binary, loglik double, levels array<string>, weight binary, cross binary, residual binary"
STATE = "beta array<double>, levels array<string>, intercepts array<double>, base array<double>, base_intercepts array<double>, base_loglik double, loglik double, variance double, status string"


def _from_state(row: dict, blank: Newton) -> Newton:
    """The fit as far as it has come; ``blank`` where it has not begun."""
    if not row["status"]:
        return replace(blank)
    get = lambda k: None if row[k] is None else np.array(row[k], float)
    return Newton(get("beta"), np.array(row["levels"], object), get("intercepts"), get("base"), get("base_intercepts"),
                  row["base_loglik"], row["loglik"], row["variance"], row["status"], blank.blocks)


def _to_state(fit: Newton) -> dict:
    get = lambda v: None if v is None else v.tolist()
    return {"beta": fit.beta.tolist(), "levels": fit.levels.tolist(), "intercepts": fit.intercepts.tolist(), "base": get(fit.base),
            "base_intercepts": get(fit.base_intercepts), "base_loglik": fit.base_loglik, "loglik": fit.loglik, "variance": fit.variance, "status": fit.status}


def logit_by_feature(df: DataFrame, outcome: str, value: str, covariates=(), categorical=(), keys=("unique_feature_label",),
                     min_rows: int = 10, unit_rows: int = 65_536) -> DataFrame:
    """Unpenalised logistic regression of a 0/1 outcome per key; one result row per key.  Runs jobs.

    Wald standard error, two-sided p, interval at 1.96 standard errors, true log-likelihoods.
    Categorical covariates enter by level.  Too few rows, no outcome variance, a
    singular information matrix or separation are reported in the row, never raised.

    Every key is fitted by Newton steps on sums of its units of about ``unit_rows`` rows.  A key of one unit
    takes its steps where the rows are; the sums of other keys meet by key, once per step.  The levels of the
    categorical covariate with the most of them are eliminated from the equations, so they may be any
    number; the levels of further ones are indicators.
    """
    keys = list(keys)
    spark = df.sparkSession
    rows, numeric, classes = _prepared(df, outcome, value, list(covariates), list(categorical), keys)
    many, others = (None, [])
    if len(classes) > 1:
        spread = rows.agg(*[F.approx_count_distinct(c) for c in classes]).head()
        many = classes[int(np.argmax(spread))]
        others = [(c, r[0]) for c in classes if c != many for r in rows.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
    elif classes:
        many = classes[0]
    counted = stored(rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("__ok").alias("n_valid"),
        F.coalesce(F.sum(F.when(F.col("__ok"), F.col("__y"))), F.lit(0.0)).alias("n_positive")))
    fit_for = counted.where((F.col("n_rows") >= min_rows) & (F.col("n_valid") >= min_rows) & (F.col("n_positive") > 0) & (F.col("n_positive") < F.col("n_valid")))
    dense = [F.col(c) for c in numeric] + [holds(F.col(c) == v).cast("double") for c, v in others]
    parts = fit_for.select(*keys, "n_valid", "n_positive", F.ceil(F.col("n_valid") / unit_rows).cast("int").alias("__units"))
    used = [*keys, "__y", *numeric, *classes]
    placed = attach_checked(rows.where("__ok").select(*used), parts, keys, "inner")
    unit = F.pmod(F.xxhash64(*used, F.spark_partition_id()), F.col("__units")).cast("int")
    # lists of rows shrink to next to nothing when they are packed, so their bytes do not tell how many a task can hold: rows are dealt by number
    dealt = deal(placed.select(*keys, "n_valid", "__units", unit.alias("unit"), "__y", F.coalesce(F.col(many) if many else F.lit(""), F.lit("")).alias("__level"), F.array(*dense).alias("__d")),
                 [*keys, "unit"], shares(spark, fit_for.agg(F.sum("n_valid")).head()[0] or 0))
    units = stored(dealt.groupBy(*keys, "n_valid", "__units", "unit").agg(F.collect_list("__y").alias("y"), F.collect_list("__level").alias("level"), F.flatten(F.collect_list("__d")).alias("d")))
    size = len(dense)
    blocks = tuple(tuple(len(numeric) + i for i, (c, _) in enumerate(others) if c == k) for k in dict(others))
    columns, blank = len(keys), Newton(np.zeros(size), np.array([], object), np.zeros(0), blocks=blocks)
    key_ddl = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    types = [pa_type(df.schema[k].dataType) for k in keys]

    def rows_of(batch, i):
        y = batch.column(columns + 3)[i].values.to_numpy(zero_copy_only=False)
        level = batch.column(columns + 4)[i].values.dictionary_encode()
        names = np.array(level.dictionary.to_pylist(), object)
        order = np.argsort(names)
        code = np.argsort(order)[level.indices.to_numpy()]
        x = batch.column(columns + 5)[i].values.to_numpy(zero_copy_only=False).reshape(len(y), size)
        return x, y, names[order], code

    def keyed(out, kind, names):
        fields = [(c.split()[0], c.split()[1]) for c in kind.split(", ")]
        made = [pa.array([r[0][j] for r in out], t) for j, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([*made, *[pa.array([r[1][n] for r in out], ARROW[t]) for n, t in fields]], names=[*keys, *names])

    def local(batches):
        for batch in batches:
            out = []
            for i in range(len(batch)):
                n, fit = batch.column(columns)[i].as_py(), replace(blank)
                data = rows_of(batch, i)
                for _ in range(MAX_STEPS):
                    fit.advance(n, Sums.of(fit, *data))
                    if fit.status != "running":
                        break
                # what was found is all that is needed of the levels
                out.append(([batch.column(j)[i].as_py() for j in range(columns)], _to_state(replace(fit, levels=fit.levels[:0], intercepts=fit.intercepts[:0], base=None, base_intercepts=None))))
            yield keyed(out, STATE, STATE_NAMES)

    def add(batches):
        for batch in batches:
            names = batch.schema.names
            for i in range(len(batch)):
                held = {k: batch.column(names.index(k))[i].as_py() for k in STATE_NAMES}
                s = Sums.of(_from_state(held, blank), *rows_of(batch, i))
                yield keyed([([batch.column(j)[i].as_py() for j in range(columns)],
                              {"unit": batch.column(columns + 2)[i].as_py(), "information": s.information.tobytes(), "gradient": s.gradient.tobytes(), "loglik": s.loglik,
                               "levels": s.levels.tolist(), "weight": s.weight.tobytes(), "cross": s.cross.tobytes(), "residual": s.residual.tobytes()})], SUMS, SUM_NAMES)

    def move(key, sums, state):
        parts = [Sums(np.frombuffer(r.information).reshape(size, size), np.frombuffer(r.gradient), r.loglik, np.array(list(r.levels), object),
                      np.frombuffer(r.weight), np.frombuffer(r.cross).reshape(-1, size), np.frombuffer(r.residual)) for r in sums.sort_values("unit").itertuples()]
        held = state.iloc[0].to_dict()
        held = {k: None if v is None or (isinstance(v, float) and math.isnan(v)) else v for k, v in held.items()}
        fit = _from_state(held, blank)
        fit.advance(int(held["n_valid"]), Sums.together(parts))
        return pd.DataFrame([[*key, held["n_valid"], *_to_state(fit).values()]], columns=[*keys, "n_valid", *STATE_NAMES])

    several = units.where(F.col("__units") > 1)
    done = units.where(F.col("__units") == 1).mapInArrow(local, f"{key_ddl}, {STATE}").select(*keys, "beta", "loglik", "variance", "status")
    state = stored(several.select(*keys, "n_valid").distinct().select("*", *[F.lit(None).cast(c.split(" ", 1)[1]).alias(c.split()[0]) for c in STATE.split(", ")]))
    for _ in range(MAX_STEPS if not state.isEmpty() else 0):
        running = state.where(F.col("status").isNull() | (F.col("status") == "running"))
        if running.isEmpty():
            break
        at = attach(several, running.select(*keys, *STATE_NAMES), keys, "inner")
        sums = at.mapInArrow(add, f"{key_ddl}, {SUMS}")
        moved = sums.groupBy(*keys).cogroup(running.groupBy(*keys)).applyInPandas(move, f"{key_ddl}, n_valid long, {STATE}")
        after = stored(moved.unionByName(state.where(F.col("status") != "running")))
        discard(state)
        state = after
    fits = stored(done.unionByName(state.select(*done.columns)))
    discard(units, state)
    told = attach_checked(counted, fits, keys)

    def finish(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                row = dict(zip(pdf.columns, r))
                problem = _precheck(row["n_rows"], row["n_valid"], row["n_positive"], min_rows)
                get = lambda k: row[k] if row[k] == row[k] else None
                found = _blank(problem) if problem else replace(
                    blank, beta=np.asarray(row["beta"], float), loglik=get("loglik"), variance=get("variance"), status=row["status"]).result(row["n_valid"], row["n_positive"])
                out.append([*[row[k] for k in keys], *[found[n] for n in RESULT_FIELDS.names]])
            yield pd.DataFrame(out, columns=[*keys, *RESULT_FIELDS.names])

    return stored(told.mapInPandas(finish, _schema(rows, keys)))


SUM_NAMES, STATE_NAMES = ([c.split()[0] for c in kind.split(", ")] for kind in (SUMS, STATE))
ARROW = {"int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string(), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}


def logit_global(df: DataFrame, outcome: str, predictors) -> DataFrame:
    """One logistic model on all complete rows: ``term``, ``estimate``, ``std_error``, ``p_value`` (fits: an action)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    rows = df.select(number(outcome).alias("label"), *[number(p).alias(p) for p in predictors]).dropna()
    vectors = VectorAssembler(inputCols=list(predictors), outputCol="features").transform(rows)
    model = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=50, tol=1e-10).fit(vectors)
    s = model.summary
    terms = [*predictors, "(Intercept)"]
    estimates = [*model.coefficients.toArray().tolist(), float(model.intercept)]
    table = [(t, float(e), float(se), float(p)) for t, e, se, p in zip(terms, estimates, s.coefficientStandardErrors, s.pValues)]
    return df.sparkSession.createDataFrame(table, "term string, estimate double, std_error double, p_value double")


def valid_results(results: DataFrame) -> DataFrame:
    """Fits that may enter the correction."""
    return results.where(
        number("p_value").isNotNull() & holds(F.col("is_converged")) & ~holds(F.col("singular_matrix_error"))
        & F.col("unexpected_error").isNull())


def discovery_scan(rows: DataFrame, annotation: DataFrame, outcome: str, value: str = "intensity_fill_log_scaled",
                   covariates=("pw_age", "ga_weeks"), categorical=("site",), method: str = "fdr_bh", alpha: float = 0.05,
                   feature: str = "unique_feature_label", analysis: str = "analysis", **fit_options) -> DataFrame:
    """All analyses at once: fit, annotate, keep valid fits, correct per (analysis, compound class), tag ``group``."""
    fits = logit_by_feature(rows, outcome, value, covariates, categorical, (analysis, feature), **fit_options)
    annotated = with_annotation(fits, annotation, feature)
    corrected = adjust(valid_results(annotated), method, alpha, families=[analysis, "compound_class"])
    return corrected.withColumnRenamed(analysis, "group")


def volcano_points(results: DataFrame, p_value: str = "p_value", effect: str = "estimate", p_limit: float = 0.05, effect_limit: float = 0.5) -> DataFrame:
    """Complete results with ``neg_log10_p`` (p floored at 1e-300) and ``significant``."""
    known = results.withColumns({p_value: number(p_value), effect: number(effect)}).dropna(subset=[p_value, effect])
    return known.withColumns({
        "neg_log10_p": -F.log10(F.greatest(F.col(p_value), F.lit(1e-300))),
        "significant": (F.col(p_value) < p_limit) & (F.abs(effect) > effect_limit)})
