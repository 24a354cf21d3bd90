"""Principal components, batch-effect report and correlations."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.nulls import complete
from ..functions.relate import cut_lineage
from .layout import Wide
from .normalize import apply_shift, apply_vector_scale, as_vector, fit_shift, fit_vector_scale
from .select import top_features
from .shapes import pivot_wide
from .stats import site_statistics


@dataclass
class Components:
    """Scaled rows (``__features``), loadings (columns x components) and explained shares."""

    rows: DataFrame
    loadings: np.ndarray
    shares: np.ndarray


# Columns multiplied beyond the wanted components, blocks kept before a restart, residual (of the largest value) that counts as met.
SPARE, KEPT_BLOCKS, RESIDUAL, MOST_PASSES = 8, 24, 1e-10, 500


def _gram_times(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    """X' (X block) of the array column ``x``: one pass; every task adds up its own and parts are added again by Spark."""
    size, width = block.shape
    shared = rows.sparkSession.sparkContext.broadcast(block)
    per = max(1, (1 << 18) // width)
    kind = "part int, sums binary"

    def add(batches):
        total, some = np.zeros((size, width)), False
        for batch in batches:
            x = _matrix(batch.column(0), size)
            total += x.T @ (x @ shared.value)
            some = some or len(x) > 0
        if some:
            cuts = range(0, size, per)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), pa.array([total[c:c + per].tobytes() for c in cuts], pa.binary())], names=["part", "sums"])

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums = np.frombuffer(sums.as_buffer())
                total[part] = total[part] + sums if part in total else sums
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["part", "sums"])

    out = np.zeros((size, width))
    for part, sums in rows.select("x").mapInArrow(add, kind).repartition(-(-size // per), "part").mapInArrow(merge, kind).collect():
        out[part * per:(part + 1) * per] = np.frombuffer(sums).reshape(-1, width)
    shared.destroy()
    return out


def principal_axes(rows: DataFrame, size: int, k: int, seed: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of X'X and their vectors, for the array column ``x`` of ``size`` numbers.

    Block Krylov iteration: every pass multiplies a block of ``k + SPARE`` columns by X'X; the products are made
    orthogonal to all that are kept, and the small problem within them is solved.  It ends when the residuals of
    the wanted pairs are below RESIDUAL of the largest value, or the kept columns span everything.  After KEPT_BLOCKS
    blocks it starts again from the best.  The driver holds a few hundred columns, never ``size`` squared numbers.
    """
    width = min(size, k + SPARE)
    rng = np.random.default_rng(seed)
    block = np.linalg.qr(rng.standard_normal((size, width)))[0]
    kept, images = np.zeros((size, 0)), np.zeros((size, 0))
    for _ in range(MOST_PASSES):
        kept, images = np.concatenate((kept, block), axis=1), np.concatenate((images, _gram_times(rows, block)), axis=1)
        small = kept.T @ images
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        vectors, moved = kept @ turns, images @ turns
        rest = moved[:, :k] - vectors[:, :k] * values[:k]
        if kept.shape[1] >= size or np.linalg.norm(rest, axis=0).max(initial=0.0) <= RESIDUAL * max(values[0], 1e-300):
            break
        if kept.shape[1] + width > KEPT_BLOCKS * width:
            kept, images = vectors[:, :2 * width], moved[:, :2 * width]
        new = images[:, -width:] if kept.shape[1] != 2 * width else moved[:, :width] - vectors[:, :width] * values[:width]
        for _ in range(2):
            new = new - kept @ (kept.T @ new)
        block, upper = np.linalg.qr(new)
        fresh = np.abs(np.diag(upper)) > 1e-12 * max(np.abs(upper).max(initial=0.0), 1e-300)
        if not fresh.all():     # directions used up are replaced by random ones
            spare = rng.standard_normal((size, int((~fresh).sum())))
            block = np.concatenate((block[:, fresh], spare), axis=1)
            for _ in range(2):
                block = block - kept @ (kept.T @ block)
                block = np.linalg.qr(block)[0]
        block = block[:, :size - kept.shape[1]]
    return values[:k], vectors[:, :k]


def fit_pca(wide: DataFrame, layout: Wide, n_components: int = 10, site: str | None = None, fill: float | None = None) -> Components:
    """Principal components of the scaled columns.  Fits: an action.

    Columns are batch-corrected if ``site`` is given, then scaled to mean 0 and sd 1.  Rows with a
    missing value are left out unless ``fill`` replaces it.  A component is turned so that its
    largest loading (by absolute value) is positive.
    """
    columns = layout.values()
    rows = wide.fillna(fill, subset=columns) if fill is not None else wide.where(complete(columns))
    # Medians, scales, the fit and the scores all read these rows.
    rows = cut_lineage(rows)
    vectors = rows.withColumn("__v", as_vector(columns))
    if site:
        vectors = apply_shift(vectors, "__v", fit_shift(rows, columns, site), len(columns), site)
    means, sds = fit_vector_scale(vectors, "__v", len(columns))
    vectors = cut_lineage(vectors.withColumn("__features", apply_vector_scale("__v", means, sds)).drop(*columns, "__v"))
    k = min(n_components, len(columns))
    whole = vectors.agg(F.sum(F.aggregate("__features", F.lit(0.0), lambda a, x: a + x * x))).head()[0] or 0.0
    values, loadings = principal_axes(vectors.select(F.col("__features").alias("x")), len(columns), k)
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    return Components(vectors, loadings * signs, np.maximum(values, 0.0) / whole if whole else np.zeros(k))


def pca_scores(fitted: Components, keep=("sample_id",)) -> DataFrame:
    loadings = fitted.loadings
    size, k = loadings.shape

    @F.arrow_udf("array<double>")
    def scores(x: pa.Array) -> pa.Array:
        made = _matrix(x, size) @ loadings
        return pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, k), pa.int32()), pa.array(made.ravel()))

    told = fitted.rows.select(*keep, scores(F.col("__features")).alias("__s"))
    return told.select(*keep, *[F.col("__s")[i].alias(f"PC{i + 1}") for i in range(k)])


def pca_variance(spark, fitted: Components) -> DataFrame:
    """Explained share per component and its running sum, over at most a few dozen rows."""
    table = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(fitted.shares)], "component int, explained_variance_ratio double")
    upto = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table.withColumn("cumulative_variance", F.sum("explained_variance_ratio").over(upto))


def pca_loadings(spark, fitted: Components, layout: Wide) -> DataFrame:
    names = [f"PC{i + 1} double" for i in range(fitted.loadings.shape[1])]
    return spark.createDataFrame([(c, *map(float, row)) for c, row in zip(layout.columns, fitted.loadings)],
                                 ", ".join(["feature_id string", *names]))


def pca_metadata_join(scores: DataFrame, metadata: DataFrame, key: str = "sample_id") -> DataFrame:
    return scores.join(metadata, key, "inner")


def batch_effect_report(wide: DataFrame, layout: Wide, site: str = "site", sample: str = "sample_id", n_components: int = 5) -> DataFrame:
    """Per site: intensity statistics, and mean component scores before and after correction."""
    long = wide.select(sample, site, *layout.columns).unpivot([sample, site], layout.values(), "feature_id", "value")
    out = site_statistics(long, site, "feature_id", sample)
    for name, by in (("original", None), ("corrected", site)):
        scores = pca_scores(fit_pca(wide, layout, n_components, by), (sample, site))
        names = [c for c in scores.columns if c.startswith("PC")]
        out = out.join(scores.groupBy(site).agg(*[F.avg(c).alias(f"{c}_{name}") for c in names]), site, "left")
    return out


# Columns of a tile of the products.
TILE = 256


def _sums_of(rows: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Means of the positions of the array ``v`` (0 where nothing is known), and how many rows there are."""

    def add(batches):
        total, n = np.zeros((2, size)), 0
        for batch in batches:
            x = _matrix(batch.column(0), size)
            known = ~np.isnan(x)
            total += np.stack((np.where(known, x, 0.0).sum(axis=0), known.sum(axis=0)))
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, size), pa.int32()), pa.array(np.append(0.0, total[0])), pa.array(np.append(n, total[1]))], names=["k", "s", "n"])

    found = rows.mapInArrow(add, "k int, s double, n double").groupBy("k").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).toPandas()
    means, n = np.zeros(size), 0
    for k, s, c in found.itertuples(index=False):
        if k < 0:
            n = int(c)
        elif c:
            means[k] = s / c
    return means, n


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), size)


def pair_moments(df: DataFrame, columns, others=None) -> DataFrame:
    """Sums over complete pairs (i, j, n, sx, sy, sxx, syy, sxy): of ``columns`` with i <= j, or of ``columns`` with ``others``.

    The columns are cut into tiles.  A pair of tiles is multiplied on its own, in as many parts as keep the tasks
    busy, so no task holds more than two tiles of rows and one tile of products; with one pair of
    tiles rows are summed where they lie.  Values are shifted by the column mean first, which keeps the sums of
    squares accurate.  ``j`` counts within ``others`` if they are given.  Runs a job for the means.
    """
    columns, others = list(columns), None if others is None else list(others)
    size, every = len(columns), [*columns, *(others or [])]
    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    if not size or (others is not None and not others):
        return df.sparkSession.createDataFrame([], schema)
    rows = df.select(as_vector(every).cast("array<double>").alias("v"))
    means, n_rows = _sums_of(rows, len(every))
    cuts = lambda first, last: [(a, min(a + TILE, last)) for a in range(first, last, TILE)]
    left = cuts(0, size)
    pairs = [(a, b) for a in left for b in left if a <= b] if others is None else [(a, b) for a in left for b in cuts(size, len(every))]
    spark = df.sparkSession
    salts = max(1, min(-(-2 * spark.sparkContext.defaultParallelism // max(len(pairs), 1)), -(-n_rows // 10_000)))

    def products(x, y):
        kx, ky = (~np.isnan(v) for v in (x, y))
        x, y, mx, my = np.where(kx, x, 0.0), np.where(ky, y, 0.0), kx.astype(float), ky.astype(float)
        return np.stack([mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y])

    def told(pair, total):
        (a, _), (b, _) = pairs[pair]
        i, j = (m.ravel() for m in np.meshgrid(np.arange(total.shape[1]) + a, np.arange(total.shape[2]) + b, indexing="ij"))
        used = i <= j if others is None else np.full(len(i), True)
        sums = [pa.array(t.ravel()[used]) for t in total]
        return pa.RecordBatch.from_arrays([pa.array(i[used], pa.int32()), pa.array((j - (0 if others is None else size))[used], pa.int32()), *sums], names=[f.split()[0] for f in schema.split(", ")])

    def whole(batches):
        total = 0.0
        for batch in batches:
            x = _matrix(batch.column(0), len(every)) - means
            (a, b), (c, d) = pairs[0]
            total = total + products(x[:, a:b], x[:, c:d])
        if not np.isscalar(total):
            yield told(0, total)

    def deal(batches):
        for batch in batches:
            x = _matrix(batch.column(0), len(every)) - means
            for at in range(0, len(x), 2048):
                part = x[at:at + 2048]
                salt = int(np.abs(np.nan_to_num(part[0])).sum() * 1e6) % salts
                for k, ((a, b), (c, d)) in enumerate(pairs):
                    sides = [pa.array([np.ascontiguousarray(part[:, p:q]).tobytes()], pa.binary()) for p, q in ((a, b), (c, d))]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([salt], pa.int32()), *sides], names=["pair", "salt", "x", "y"])

    def gather(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x, y in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
                (a, b), (c, d) = pairs[k]
                made = products(np.frombuffer(x).reshape(-1, b - a), np.frombuffer(y).reshape(-1, d - c))
                if k not in total and len(total) > 3:      # rows come by pair: what came before is done
                    yield told(*total.popitem())
                total[k] = total[k] + made if k in total else made
        for k, t in total.items():
            yield told(k, t)

    if len(pairs) == 1:
        parts = rows.mapInArrow(whole, schema)
    else:
        dealt = rows.mapInArrow(deal, "pair int, salt int, x binary, y binary")
        parts = dealt.repartition(len(pairs) * salts, "pair", "salt").sortWithinPartitions("pair", "salt").mapInArrow(gather, schema)
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def _corr():
    n = F.col("n")
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    vx = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n)
    vy = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    return F.when((n > 1) & (vx > 0) & (vy > 0), F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy)))


def _name(names, i):
    return F.get(F.expr("array(" + ", ".join(repr(str(n)) for n in names) + ")"), i)


def feature_corr_matrix(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation over complete pairs: ``feature_1``, ``feature_2``, ``corr`` for all ordered pairs.

    Each unordered pair is summed and shuffled once and told in both orders.
    """
    columns = list(columns)
    upper = pair_moments(df, columns).select("i", "j", _corr().alias("corr"))
    there, back = F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b"))
    both = upper.select("corr", F.explode(F.when(F.col("i") == F.col("j"), F.array(there)).otherwise(F.array(there, back))).alias("p"))
    return both.select(_name(columns, F.col("p.a")).alias("feature_1"), _name(columns, F.col("p.b")).alias("feature_2"), "corr")


def feature_covariate_corr(df: DataFrame, features, covariates) -> DataFrame:
    """Correlation of every feature with every covariate that exists: only these pairs are summed."""
    features, covariates = list(features), [c for c in covariates if c in df.columns]
    found = pair_moments(df, features, covariates) if covariates else pair_moments(df, [], [])
    names = covariates or [""]
    return found.select(_name(features or [""], F.col("i")).alias("feature_id"), _name(names, F.col("j")).alias("covariate"), _corr().alias("corr"))


def correlation_summary(corr: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Mean and maximum |r| and the number of high pairs, each unordered pair once, no diagonal."""
    r = F.abs("corr")
    return corr.where(F.col("feature_1") < F.col("feature_2")).agg(
        F.avg(r).alias("mean_abs_correlation"), F.max(r).alias("max_correlation"), F.count_if(r > threshold).alias("n_high_corr_pairs"))


def high_corr_pairs(corr: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs with |r| above the threshold, strongest first."""
    return corr.where((F.col("feature_1") < F.col("feature_2")) & (F.abs("corr") > threshold)) \
        .orderBy(F.abs("corr").desc(), "feature_1", "feature_2")


def top_variance_subset(long: DataFrame, stats: DataFrame, n: int = 50, sample="sample_id", feature: str = "feature_id", value: str = "value"):
    """(wide frame of the ``n`` most variable features, their names).  Fetches at most ``n`` names."""
    names = [r[0] for r in top_features(stats, n, feature=feature).select(feature).collect()]
    return pivot_wide(long, names, sample, feature, value, prefix="f"), [f"f{x}" for x in names]
