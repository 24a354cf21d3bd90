"""Hand-made frames for the traps: missing values, constants, ties, hot keys, empty groups."""

import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmill.functions.measures import pearson
from cohortmill.functions.nulls import ne
from cohortmill.operators import assoc, cohort, derive, impute, multitest, normalize, outlier, sampling, scoring, select, shapes, stats
from cohortmill.operators.layout import Long, Wide
from cohortmill.operators.neighbours import neighbours
from cohortmill.operators.ranking import chunked, exact_quantiles, running, spread_row_number


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_not_equal_keeps_missing(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert df.where(ne("x", 1)).count() == 2


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, None), (1, 3.0)], "feature_id int, value double")
    row = stats.missing_zero_rates(df, Long()).first()
    assert row["missing_rate"] == 0.5 and row["zero_rate"] == 0.0
    assert values(impute.impute(df, Long(), "mean"), "value") == [(1.0,), (2.0,), (2.0,), (3.0,)]


def test_correlation_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 1.0)], "x double, y double")
    assert df.agg(pearson("x", "y").alias("r")).first()["r"] is None


@pytest.mark.parametrize("interpolate", [True, False])
def test_exact_quantiles_with_hot_value(spark, interpolate):
    rng = np.random.default_rng(1)
    data = [("a", float(v)) for v in np.where(rng.random(5000) < 0.4, 0.0, rng.normal(size=5000))] + [("b", 2.0), (None, 7.0)]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = {r["g"]: r["q"] for r in exact_quantiles(df, ["g"], "x", probs, interpolate, accuracy=200).collect()}
    a = np.array([v for g, v in data if g == "a"])
    want = np.quantile(a, probs) if interpolate else np.sort(a)[[max(math.ceil(p * len(a)), 1) - 1 for p in probs]]
    assert np.allclose(found["a"], want) and found["b"] == [2.0] * 5 and found[None] == [7.0] * 5


def test_running_totals_across_chunks(spark):
    df = spark.createDataFrame([(i % 2, float(i * i), i) for i in range(400)], "g int, x double, w long")
    cut = chunked(df, ["g"], "x", total=F.col("w"), chunks=16)
    assert cut.select("g", "__chunk").distinct().count() > 10
    got = {(r["g"], r["x"]): (r["up"], r["down"], r["__n"]) for r in running(
        running(cut, ["g"], "x", "up", "sum", F.col("w")), ["g"], "x", "down", "min", F.col("w"), descending=True).collect()}
    for i in range(400):
        same = [j for j in range(400) if j % 2 == i % 2]
        assert got[(i % 2, float(i * i))] == (sum(j for j in same if j <= i), i, sum(same))


def test_chunks_are_even_whatever_the_values(spark):
    values = [*(float(i) / 1e6 for i in range(20_000)), -1e300, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    sizes = [r["count"] for r in chunked(df, [], "x", chunks=10).groupBy("__chunk").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 2 * len(values) / 10


def test_spread_row_number_is_a_permutation(spark):
    df = spark.createDataFrame([(i % 3, float(i % 5), i) for i in range(300)], "g int, x double, id long")
    rows = spread_row_number(df, ["g"], "id", order="x").collect()
    for g in range(3):
        mine = sorted((r for r in rows if r["g"] == g), key=lambda r: r["rn"])
        assert [r["rn"] for r in mine] == list(range(1, 101))
        assert [r["x"] for r in mine] == sorted(r["x"] for r in mine)


def test_corrections_with_ties_and_null_family(spark):
    p = [0.01, 0.01, 0.04, 0.03, None, float("nan"), 0.5]
    df = spark.createDataFrame([(i, None if i == 6 else "c", v) for i, v in enumerate(p)], "id int, compound_class string, p_value double")
    by_class = {r["id"]: r for r in multitest.adjust_by_class(df).collect()}
    assert set(by_class) == {0, 1, 2, 3, 6} and by_class[6]["p_value_corrected"] == 0.5
    assert by_class[0]["p_value_corrected"] == pytest.approx(0.02) and by_class[3]["p_value_corrected"] == pytest.approx(0.04)
    adjusted = {m: {r["id"]: r["p_value_corrected"] for r in multitest.adjust(df, m).collect()} for m in ("fdr_bh", "holm", "bonferroni")}
    for i in adjusted["holm"]:
        assert p[i] <= adjusted["fdr_bh"][i] <= adjusted["holm"][i] + 1e-12 <= adjusted["bonferroni"][i] + 1e-11


def test_outliers_constant_column_and_actions(spark):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(10)] + [(10, 1000.0, 1.0)], "id int, a double, b double")
    wide = Wide(["a", "b"])
    assert outlier.handle_outliers(df, wide, "iqr", 3.0, "remove").count() == 10
    capped = outlier.handle_outliers(df, wide, "zscore", 1.0, "cap").agg(F.max("a")).first()[0]
    assert capped < 1000.0
    flags = outlier.handle_outliers(df, wide, "zscore", 1.0, "flag").where("a_outlier OR b_outlier").count()
    assert flags == 1
    assert outlier.handle_outliers(df, wide, "iqr", 3.0, "remove", sequential=True).count() == 10


def test_group_centring_aligns_medians_in_both_layouts(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 2, float(v + 50 * (i % 2))) for i, v in enumerate(rng.random(41) * 10)]
    long = spark.createDataFrame([(i, s, "f", v) for i, s, v in rows], "sample_id int, site int, feature_id string, value double")
    wide = spark.createDataFrame(rows, "sample_id int, site int, f double")
    a = {r["sample_id"]: r["log2_value"] for r in normalize.center_median(long, Long(), ["site"]).collect()}
    b = {r["sample_id"]: r["log2_f"] for r in normalize.center_median(wide, Wide(["f"]), ["site"]).collect()}
    assert all(a[i] == pytest.approx(b[i]) for i in a)
    odd = sorted(v for i, v in a.items() if i % 2)
    even = sorted(v for i, v in a.items() if i % 2 == 0)
    assert odd[math.ceil(len(odd) / 2) - 1] == pytest.approx(even[math.ceil(len(even) / 2) - 1])


def test_batch_correction_of_unseen_site_changes_nothing(spark):
    train = spark.createDataFrame([(0, "f", 1.0), (0, "f", 3.0), (1, "f", 11.0)], "site int, feature_id string, value double")
    new = spark.createDataFrame([(9, "f", 5.0), (1, "f", 12.0)], "site int, feature_id string, value double")
    got = {r["site"]: r["value"] for r in normalize.batch_correct(new, Long(), train=train).collect()}
    assert got == {9: 5.0, 1: 12.0 - 11.0 + 3.0}


def logit_rows(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    data = []
    for f in ("a", "b"):
        x, c, s = rng.normal(size=n), rng.normal(size=n), rng.integers(0, 3, n)
        y = rng.random(n) < 1 / (1 + np.exp(-(0.5 * x - 0.3 * c + 0.2 * s)))
        data += [(f, float(x[i]), float(c[i]), f"s{s[i]}", int(y[i])) for i in range(n)]
    data += [("sep", float(i), float(i % 3), "s0", int(i >= 20)) for i in range(40)]
    data += [("flat", float(i), 0.5, "s0", 1) for i in range(40)]
    data += [("few", 1.0, 0.5, "s0", i % 2) for i in range(5)]
    data += [("dup", float(i % 7), float(i % 7), "s0", int((i * 7919) % 3 == 0)) for i in range(60)]
    return spark.createDataFrame(data, "k string, x double, c double, s string, y int")


def test_logit_agrees_in_any_units_and_with_glm(spark):
    df = logit_rows(spark)
    fits = {m: {r["k"]: r for r in assoc.logit_by_feature(df, "y", "x", ["c"], ["s"], ["k"], unit_rows=m).collect()} for m in (65_536, 90, 16)}
    for k in ("a", "b"):
        for m in (90, 16):
            g, s = fits[65_536][k], fits[m][k]
            assert g["is_converged"] and s["is_converged"]
            for field in ("estimate", "std_error", "p_value", "log_likelihood", "null_log_likelihood"):
                assert g[field] == pytest.approx(s[field], rel=1e-8)
    one = df.where("k = 'a'").withColumn("s1", (F.col("s") == "s1").cast("int")).withColumn("s2", (F.col("s") == "s2").cast("int"))
    glm = {r["term"]: r for r in assoc.logit_global(one, "y", ["x", "c", "s1", "s2"]).collect()}["x"]
    assert fits[90]["a"]["estimate"] == pytest.approx(glm["estimate"], abs=1e-6)
    assert fits[90]["a"]["std_error"] == pytest.approx(glm["std_error"], abs=1e-6)
    for m in fits.values():
        assert m["sep"]["perfect_separation_warning"] and not m["sep"]["is_converged"]
        assert m["flat"]["unexpected_error"] == assoc.NO_VARIANCE and m["few"]["unexpected_error"] == assoc.TOO_SMALL
        assert m["dup"]["singular_matrix_error"] and m["dup"]["estimate"] is None


def test_logit_with_many_levels_and_two_categories(spark):
    rng = np.random.default_rng(6)
    n, levels = 6000, 400
    x, s, t = rng.normal(size=n), rng.integers(0, levels, n), rng.integers(0, 3, n)
    shift = rng.normal(size=levels)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.4 * x + shift[s] * 0.5 + 0.3 * t)))).astype(int)
    seen = [k for k in range(levels) if 0 < y[s == k].mean() < 1]
    kept = np.isin(s, seen)
    x, s, t, y = x[kept], s[kept], t[kept], y[kept]
    design = np.column_stack([x, t == 1, t == 2, *[s == k for k in seen]]).astype(float)
    beta = np.zeros(design.shape[1])
    for _ in range(30):
        mu = 1 / (1 + np.exp(-design @ beta))
        cov = np.linalg.inv((design * (mu * (1 - mu))[:, None]).T @ design)
        beta = beta + cov @ design.T @ (y - mu)
    df = spark.createDataFrame([("k", float(a), f"s{b}", f"t{c}", int(d)) for a, b, c, d in zip(x, s, t, y)], "k string, x double, s string, t string, y int")
    for rows in (65_536, 700):
        got = assoc.logit_by_feature(df, "y", "x", [], ["t", "s"], ["k"], unit_rows=rows).first()
        assert got["is_converged"] and got["estimate"] == pytest.approx(beta[0], abs=1e-6) and got["std_error"] == pytest.approx(math.sqrt(cov[0, 0]), abs=1e-6)
    wide = spark.range(20_000).select(F.lit("k").alias("k"), ((F.col("id") * 7919) % 1000 / 500.0).alias("x"), (F.col("id") % 5000).cast("string").alias("s"), F.expr("CAST((id * 104729 + id DIV 5000) % 3 > 0 AS INT)").alias("y"))
    one, many = (assoc.logit_by_feature(wide, "y", "x", [], ["s"], ["k"], unit_rows=r).first() for r in (65_536, 3000))
    assert one["n_observations"] == 20_000 and one["estimate"] == pytest.approx(many["estimate"], abs=1e-6)


def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(5)
    q, p = rng.normal(size=(60, 3)), rng.normal(size=(300, 3))
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "qid long, vec array<double>")
    points = spark.createDataFrame([(v.tolist(), i, 1) for i, v in enumerate(p)], "vec array<double>, vid long, n long")
    d = np.sqrt(((q[:, None] - p[None]) ** 2).sum(-1))
    for farthest in (False, True):
        got = neighbours(queries, points, 4, farthest, pivots=8, block_rows=50).collect()
        found = {i: {r["vid"] for r in got if r["qid"] == i} for i in range(60)}
        order = np.argsort(-d if farthest else d, axis=1)[:, :4]
        assert all(found[i] == set(order[i].tolist()) for i in range(60))


def test_tomek_links_drop_only_majority(spark):
    df = spark.createDataFrame([(1, 0.0, 1), (2, 0.1, 0), (3, 5.0, 0), (4, 5.2, 0), (5, 9.0, 1), (6, 9.0, 0)], "id long, x double, y int")
    assert values(sampling.tomek_links(df, "y", "id", ["x"]), "id") == [(1,), (3,), (4,), (5,)]


def test_exact_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert scoring.auroc(df, "y", "s").first()["AUROC"] == pytest.approx(0.875)
    assert scoring.auprc(df, "y", "s").first()["AUPRC"] == pytest.approx(0.5 * 1.0 + 0.5 * 2 / 3)


def test_series_auc_is_the_same_in_chunks(spark):
    rng = np.random.default_rng(2)
    rows = [("u", "f", float(t), float(v), i) for i, (t, v) in enumerate(zip(rng.integers(0, 90, 200), rng.random(200)))]
    df = spark.createDataFrame(rows, "u string, f string, t double, v double, id long")
    whole = shapes.series_auc(df, "u", "f", "t", "v", "id").first()
    parts = shapes.series_auc(df, "u", "f", "t", "v", "id", chunks=5).first()
    ordered = sorted(rows, key=lambda r: (r[2], r[4]))
    t, v = np.array([r[2] for r in ordered]), np.array([r[3] for r in ordered])
    want = np.trapezoid(v - v[0], t) / (t[-1] - t[0])
    assert whole["auc"] == pytest.approx(want) and parts["auc"] == pytest.approx(want) and parts["n_points"] == 200


def test_splits_are_subject_pure_and_complete(spark):
    df = spark.createDataFrame([(i, i // 3, i // 3 % 2, "s") for i in range(180)], "sample_id int, subject_id int, y int, site string")
    got = cohort.stratified_splits(df, "y")
    assert got.count() == 180
    assert got.groupBy("subject_id").agg(F.count_distinct("dataset_assignment").alias("n")).where("n > 1").count() == 0
    assert got.select("dataset_assignment").distinct().count() == 6
    folds = cohort.cv_folds(got)
    assert folds.where("is_validation").count() == got.where("dataset_assignment <> 'lockbox'").count()


def test_selection_counts_and_names(spark):
    df = spark.createDataFrame([(float(i), 1.0, None if i < 5 else 2.0 * i) for i in range(10)], "a double, b double, c double")
    chosen, counts = select.select_comprehensive(df, Wide(["a", "b", "c"]), select.Criteria(variance=0.01))
    assert values(chosen, "feature_id") == [("a",)]
    assert [r["n_features"] for r in counts.orderBy("step_no").collect()] == [3, 2, 1, 1]
    names = derive.normalize_column_names(spark.createDataFrame([(1, 2, 3)], "Orig_ID int, VISIT_DT int, `Unnamed: 0` int"), {"VISIT_DT": "VISITDT"})
    assert names.columns == ["orig_id", "visitdt"]


def test_small_statistics_are_broadcast_and_large_ones_are_not(spark, monkeypatch):
    from cohortmill.functions import relate

    df = spark.createDataFrame([(i, i % 4, float(i)) for i in range(50)], "sample_id int, feature_id int, value double")
    plan = impute.impute(df, Long(), "mean")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    monkeypatch.setattr(relate, "BROADCAST_CELLS", 0)
    salted = impute.impute(df, Long(), "mean")
    assert "__salt" in salted._jdf.queryExecution().analyzed().toString() and salted.count() == 50


@pytest.mark.parametrize("pivots, block_rows", [(1, 4096), (32, 4096), (7, 50)])
@pytest.mark.parametrize("farthest", [False, True])
def test_neighbours_break_ties_by_id(spark, pivots, block_rows, farthest):
    from cohortmill.operators.neighbours import neighbours

    turn = [2 * math.pi * i / 600 for i in range(600)]
    points = spark.createDataFrame([(i, [math.cos(a), math.sin(a)], 1) for i, a in enumerate(turn)], "vid long, vec array<double>, n long")
    query = spark.createDataFrame([(9, [0.0, 0.0])], "qid long, vec array<double>")
    got = neighbours(query, points, 3, farthest, pivots=pivots, block_rows=block_rows).collect()
    assert sorted(r.vid for r in got) == [0, 1, 2]


def test_neighbours_of_a_grid_match_brute_force(spark):
    from cohortmill.operators.neighbours import neighbours

    grid = [(10 * x + y, [float(x), float(y)]) for x in range(10) for y in range(10)]
    points = spark.createDataFrame([(i, v, 1) for i, v in grid], "vid long, vec array<double>, n long")
    got = neighbours(spark.createDataFrame(grid, "qid long, vec array<double>"), points, 4, exclude_self=True, pivots=5, block_rows=16).collect()
    for i, v in grid:
        near = sorted((round(math.dist(v, w), 9), j) for j, w in grid if j != i)[:4]
        assert sorted(r.vid for r in got if r.qid == i) == sorted(j for _, j in near)


def test_failed_trials_are_reported(spark):
    from cohortmill.operators import boosting

    rows = spark.createDataFrame([(i, "a", i % 2, None, "split_1") for i in range(10)], "sample_id long, site string, y int, f double, dataset_assignment string")
    with pytest.raises(RuntimeError, match="no trial succeeded"):
        boosting.tune_random_search(rows, ["f"], [], "y", "sample_id", n_trials=1, n_splits=3, samplers=("random",))


def plain_boosting(x, y, learned, watched, edges, how, hashes):
    """Second-order boosting row by row: margins of all rows in the best round, and the losses watched."""
    def soft(g):
        return math.copysign(max(abs(g) - how.l1, 0.0), g)

    def worth(g, h):
        return soft(g) ** 2 / (h + how.l2)

    margins, losses, kept = [0.0] * len(y), [], []
    for turn in range(how.rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        w = [how.weight if c else 1.0 for c in y]
        g, h = [a * (b - c) for a, b, c in zip(w, p, y)], [a * b * (1 - b) for a, b in zip(w, p)]

        def node(rows, inner, depth):
            sums = [sum(v[i] for i in rows) for v in (g, h)]
            best = (1e-12, None, None)
            if depth < how.depth and rows and (depth == 0 or sums[1] >= 2 * how.least):
                for f in range(len(edges)):
                    for e in edges[f]:
                        left = [i for i in rows if x[i][f] <= e]
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        if hl >= how.least and sums[1] - hl >= how.least:
                            gain = 0.5 * (worth(gl, hl) + worth(sums[0] - gl, sums[1] - hl) - worth(*sums)) - how.gamma
                            if gain > best[0] + 1e-9:
                                best = gain, f, e
            if best[1] is None:
                for i in inner:
                    margins[i] += -soft(sums[0]) / (sums[1] + how.l2) * how.rate
                return
            _, f, e = best
            node([i for i in rows if x[i][f] <= e], [i for i in inner if x[i][f] <= e], depth + 1)
            node([i for i in rows if x[i][f] > e], [i for i in inner if x[i][f] > e], depth + 1)

        node(learned, list(range(len(y))), 0)
        kept.append(list(margins))
        losses.append(sum(math.log1p(math.exp(-margins[i] if y[i] else margins[i])) for i in watched) / len(watched))
        best = losses.index(min(losses))
        if how.patience is not None and len(losses) - 1 - best >= how.patience:
            break
    return kept[losses.index(min(losses))], losses


def test_boosting_agrees_with_a_plain_loop(spark):
    from cohortmill.operators import trees as forest

    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(240, 3)), 1)
    y = ((x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=240)) > 0.5).astype(int)
    fold = rng.integers(0, 3, 240)
    data = [(i, int(c), int(f), 0, [int(i)] * 3, [], v.tolist()) for i, (c, f, v) in enumerate(zip(y, fold, x))]
    rows = spark.createDataFrame(data, "h long, y int, fold int, site int, ranks array<long>, picks array<int>, x array<double>").repartition(3)
    blocks = forest.pack(rows, 3, 3, 0)
    parts = [forest.Part(f) for f in range(3)] + [forest.Part(1, forest.RANKED, limit=120)]
    still = np.zeros((len(parts), 2, 3))
    models = [forest.Growth(k % 4, 12, 1 + k % 3, 0.4, 1.0 + k % 2, 0.05 * k, 1.0 + k, l2=0.5 + k, l1=0.1 * k, patience=(None, 2)[k % 2]) for k in range(6)]
    edges = forest.tree_edges(blocks, still[0], 3)
    search = forest.Search(parts, still, np.zeros((len(parts), 3)), edges, models)
    grown = forest.grow(blocks, search, 3)
    for how, trees in zip(models, grown):
        part = parts[how.part]
        learned = [i for i in range(240) if fold[i] != part.fold and (part.kind == forest.EVERYTHING or y[i] or i <= part.limit)]
        watched = [i for i in range(240) if fold[i] == part.fold]
        margins, losses = plain_boosting(x.tolist(), y.tolist(), learned, watched, edges.tolist(), how, None)
        assert trees.losses == pytest.approx(losses)
        if how.patience is not None:
            assert trees.margins(x) == pytest.approx(margins)
    alone = forest.grow(blocks, forest.Search(parts, still, np.zeros((len(parts), 3)), edges, models[3:4]), 3)[0]
    assert alone.margins(x) == pytest.approx(grown[3].margins(x))


def test_medians_of_all_parts_are_exact(spark):
    from cohortmill.operators import trees as forest

    rng = np.random.default_rng(3)
    n = 900
    x = np.stack((rng.normal(size=n), rng.integers(0, 3, n), np.exp(rng.normal(size=n) * 4)), axis=1)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 1][rng.random(n) < 0.5] = 1.0
    fold, site, y = rng.integers(0, 3, n), rng.integers(-1, 2, n), rng.integers(0, 2, n)
    data = [(i, int(a), int(b), int(c), [int(i)] * 3, [0] if i % 3 else [], v.tolist()) for i, (a, b, c, v) in enumerate(zip(y, fold, site, x))]
    rows = spark.createDataFrame(data, "h long, y int, fold int, site int, ranks array<long>, picks array<int>, x array<double>")
    parts = [forest.Part(-1), forest.Part(1), forest.Part(0, forest.RANKED, limit=200), forest.Part(2, forest.PICKED, pick=0)]
    got = forest.part_medians(forest.pack(rows, 3, 3, 1), parts, 2, 3)
    for p, part in enumerate(parts):
        used = fold != part.fold
        if part.kind == forest.RANKED:
            used &= (y == 1) | (np.arange(n) <= part.limit)
        if part.kind == forest.PICKED:
            used &= np.arange(n) % 3 != 0
        for s in range(3):
            of = used if s == 2 else used & (site == s)
            assert got[p, s] == pytest.approx(np.nanmedian(x[of], axis=0))


def test_trials_over_all_samplers(spark, monkeypatch):
    from cohortmill.operators import boosting

    rng = np.random.default_rng(4)
    data = [(i, "ab"[i % 5 > 2], int(i % 4 == 0), float(x + (i % 4 == 0)), float(z), ("fold_0", "fold_1", "lockbox")[i // 4 % 3]) for i, (x, z) in enumerate(rng.normal(size=(120, 2)))]
    rows = spark.createDataFrame(data, "sample_id long, site string, y int, f double, g double, dataset_assignment string").coalesce(1).cache()
    drawn = [boosting.TreeParams(sampler=s, n_estimators=n, max_depth=2, reg_lambda=0.1) for s, n in (("random", 2), ("near_miss", 2), ("near_miss", 3), ("tomek", 2), ("tomek", 3))]
    calls, make = [], boosting.undersample
    monkeypatch.setattr(boosting, "undersample", lambda df, y, k, c, sampler, *a: (calls.append(sampler), make(df, y, k, c, sampler, *a))[1])

    def search(params):
        left = iter(params)
        monkeypatch.setattr(boosting, "draw_params", lambda *_: next(left))
        best, table = boosting.tune_random_search(rows, ["f"], ["g"], "y", "sample_id", n_trials=len(params), n_splits=3)
        assert table.where("error IS NOT NULL").count() == 0
        return best, {(r["trial"], r["metric"]): r["mean"] for r in table.collect()}

    best, whole = search(drawn)
    assert sorted(calls) == ["near_miss"] * 2 + ["tomek"] * 2
    assert {n for n, _ in whole} == set(range(5))
    values = [whole[n, "PPV_val"] for n in range(5)]
    assert best == drawn[values.index(max(values))]
    for number in (0, 2):     # a trial alone has the same scores
        _, alone = search([drawn[number]])
        assert {m: v for (n, m), v in whole.items() if n == number} == pytest.approx({m: v for (_, m), v in alone.items()})


def test_registered_searches_are_whole(monkeypatch):
    import inspect

    import __spark_entry__ as entry
    from cohortmill.operators import boosting
    from cohortmill.plans import jobs
    from workload import modelling

    t, asked, whole, full = SimpleNamespace(spark=None), [], inspect.signature(boosting.tune_random_search), inspect.signature(jobs.full)
    monkeypatch.setattr(modelling, "narrow", lambda t: None)
    monkeypatch.setattr(modelling, "dense_inputs", lambda t: None)
    monkeypatch.setattr(boosting, "tune_random_search", lambda *a, **b: asked.append(whole.bind(*a, **b)) or (None, None))
    monkeypatch.setattr(jobs, "full", lambda *a, **b: asked.append(full.bind(*a, **b)))
    monkeypatch.setattr(jobs, "run_summary", lambda *_: None)
    entry.REGISTRY["tune_random_search"].run(t)
    entry.REGISTRY["job_full"].run(t)
    for call in asked:
        call.apply_defaults()
    search, job = (call.arguments for call in asked)
    assert (search["n_trials"], search["n_splits"], search["samplers"]) == (150, 6, ("random", "near_miss", "tomek"))
    assert job["mode"] == "auto" and not job["user_list"] and not job.get("predict_options")


def test_pair_products_in_tiles(spark, monkeypatch):
    from cohortmill.operators import explore

    rng = np.random.default_rng(12)
    x = rng.normal(size=(300, 7)) + 1000.0
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 3] = 5.0
    names = [f"f{i}" for i in range(7)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in names)).repartition(3)

    def plain(i, j):
        known = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        a, b = x[known, i], x[known, j]
        return None if a.std() == 0 or b.std() == 0 else np.corrcoef(a, b)[0, 1]

    for tile in (256, 3):
        monkeypatch.setattr(explore, "TILE", tile)
        got = {(r["feature_1"], r["feature_2"]): r["corr"] for r in explore.feature_corr_matrix(df, names).collect()}
        assert len(got) == 49
        strip = {(r["feature_id"], r["covariate"]): r["corr"] for r in explore.feature_covariate_corr(df, names[:5], names[5:] + ["absent"]).collect()}
        assert set(strip) == {(a, b) for a in names[:5] for b in names[5:]}
        for i in range(7):
            for j in range(7):
                want = plain(i, j)
                assert got[names[i], names[j]] == (None if want is None else pytest.approx(want, abs=1e-9))
                if i < 5 <= j:
                    assert strip[names[i], names[j]] == (None if want is None else pytest.approx(want, abs=1e-9))


def test_quantile_input_is_evaluated_once(spark):
    rows = spark.createDataFrame([(i % 3, float(i % 50)) for i in range(2000)] + [(3, None), (4, float("nan")), (5, 2.5)], "g int, x double").repartition(4)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    found = {r["g"]: r["q"] for r in exact_quantiles(rows.mapInArrow(counted, rows.schema), ["g"], "x", [0.75, 0.0, 0.5, 1.0]).collect()}
    assert read.value == 2003 and set(found) == {0, 1, 2, 5}
    for g in range(3):
        assert found[g] == pytest.approx(np.quantile([i % 50 for i in range(2000) if i % 3 == g], [0.75, 0.0, 0.5, 1.0]))
    assert found[5] == [2.5] * 4
    small = spark.createDataFrame([(g, float((i * 37) % 101)) for g in range(40) for i in range(g + 1)], "g int, x double")
    for r in exact_quantiles(small, ["g"], "x", [0.25, 0.5, 0.9]).collect():
        assert r["q"] == pytest.approx(np.quantile([float((i * 37) % 101) for i in range(r["g"] + 1)], [0.25, 0.5, 0.9]))


def test_components_agree_with_the_dense_solution(spark, monkeypatch):
    from cohortmill.operators import explore
    from cohortmill.operators.layout import Wide

    rng = np.random.default_rng(21)
    x = rng.normal(size=(400, 30)) @ rng.normal(size=(30, 30)) + 5.0
    x[:, 7] = 2.0
    names = [f"f{i}" for i in range(30)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "sample_id int, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    scaled = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    values, axes = np.linalg.eigh(scaled.T @ scaled)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(4)])
    for spare, kept in ((8, 24), (1, 4)):
        monkeypatch.setattr(explore, "SPARE", spare)
        monkeypatch.setattr(explore, "KEPT_BLOCKS", kept)
        fitted = explore.fit_pca(df, Wide(names), 4)
        assert fitted.loadings == pytest.approx(axes, abs=1e-6)
        assert fitted.shares == pytest.approx(values / np.square(scaled).sum(), abs=1e-9)
        got = {r["sample_id"]: [r[f"PC{i + 1}"] for i in range(4)] for r in explore.pca_scores(fitted).collect()}
        assert got[17] == pytest.approx((scaled @ axes)[17], abs=1e-5)
