"""Empty lists of columns, inputs dealt by their size, and searches that hold no whole group."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmill.functions import relate
from cohortmill.functions.relate import cut_lineage
from cohortmill.operators import assoc, boosting, explore, neighbours, normalize, sampling, select, shapes, trees
from cohortmill.operators.layout import Long, Wide


def test_no_feature_without_nulls_gives_no_rows(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 2.0)], "vec_id int, e0 double, e1 double")
    rows, kept, gone = select.drop_features_with_nulls(df, Wide(["e0", "e1"]))
    assert kept.values() == [] and gone == ["e0", "e1"]
    melted = shapes.melt(rows, ["vec_id"], kept.values(), "c", "v")
    assert melted.select(F.substring("c", 2, 9).cast("long")).collect() == []
    assert melted.collect() == [] and melted.dtypes == [("vec_id", "int"), ("c", "string"), ("v", "double")]


def test_correlations_with_no_covariate_are_empty(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "x double, y double")
    found = explore.feature_covariate_corr(df, ["x", "y"], ["absent"])
    assert found.collect() == [] and found.columns == ["feature_id", "covariate", "corr"]
    assert explore.feature_covariate_corr(df, [], ["x"]).collect() == []
    assert explore.feature_corr_matrix(df, []).collect() == []


def test_long_is_dealt_by_its_rows_and_equals_its_sql(spark, tmp_path, monkeypatch):
    from cohortmill.functions import relate
    from workload import registry

    assert relate.shares(spark, 10 * relate.TASK_ROWS) * 6 == relate.shares(spark, 60 * relate.TASK_ROWS)
    tables = {
        "customer": spark.createDataFrame([(1, 7), (2, None), (2, 8), (None, 9)], "c_custkey long, c_nationkey int"),
        "orders": spark.sql("SELECT IF(id % 9 = 0, NULL, id) AS o_orderkey, 1 + id % 3 AS o_custkey, TIMESTAMP '2020-01-01' AS o_orderdate FROM range(40)"),
        "lineitem": spark.sql("SELECT IF(id % 7 = 0, NULL, id % 37) AS l_orderkey, IF(id % 11 = 0, NULL, id) AS l_partkey, CAST(id AS DOUBLE) AS l_extendedprice FROM range(400)"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(relate, "TASK_ROWS", 40)
    t = registry.Inputs(spark, str(tmp_path))
    want = spark.sql(registry.SHAPES["long"], **{n: t[n] for n in tables})
    got = t["long"]
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
    held = got.groupBy("sample_id").agg(F.sum("value"))
    assert held.rdd.getNumPartitions() == 10        # 400 lines at 40 to a task, and no other exchange since


def test_neighbours_do_not_depend_on_the_rows_taken_at_once(spark, monkeypatch):
    from cohortmill.operators import neighbours as nb

    rng = np.random.default_rng(3)
    rows = lambda n, name: spark.createDataFrame([(i, list(map(float, v)), 1) for i, v in enumerate(rng.integers(0, 6, (n, 3)))], f"{name} long, vec array<double>, n long")
    asked, points = rows(300, "qid"), rows(80, "vid").dropDuplicates(["vec"])
    whole = [sorted(map(tuple, nb.neighbours(asked, points, 2, farthest=f).collect())) for f in (False, True)]
    monkeypatch.setattr(nb, "ROUTED_BYTES", 1)      # one query at a time
    assert [sorted(map(tuple, nb.neighbours(asked, points, 2, farthest=f).collect())) for f in (False, True)] == whole


def test_spans_are_learned_from_all_candidates(spark):
    from cohortmill.llm import pii
    from cohortmill.llm.common import Scratch

    kept = []

    class Watched(Scratch):
        def keep(self, df):
            kept.append(super().keep(df))
            return kept[-1]

    features = F.array(*[(F.col("id") % 5).cast("double") for _ in pii.FEATURES])
    candidates = spark.range(25_000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 4).cast("int").alias("kind"),
                                            features.alias("features"), (F.col("id") % 5 > 2).cast("double").alias("label"))
    model = pii.fit(candidates, Watched(spark), trees=1)
    assert kept[0].agg(F.sum("weight")).first()[0] == 25_000 and kept[0].count() <= 4 * 5 * 2
    assert set(model.thresholds) == {0, 1, 2, 3}


@pytest.mark.parametrize("small", [1 << 17, 0])
def test_steps_over_few_edges_take_few_tasks(spark, monkeypatch, small):
    from cohortmill.llm import common

    files = []

    class Watched(common.Scratch):
        def keep(self, df, *rows):
            held = super().keep(df, *rows)
            files.append(len(held.inputFiles()))
            return held

    monkeypatch.setattr(common, "SMALL", small, raising=False)
    edges = spark.range(1, 400).selectExpr("id AS a", "IF(id % 100 = 0, id, id - 1) AS b")    # four chains
    settings = {"spark.sql.shuffle.partitions": "31", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = dict(common.components(edges, Watched(spark)).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i // 100 * 100 for i in range(400)}
    assert len(files) > 4 and max(files[1:]) == 1       # the first is written before its size is known


@pytest.mark.parametrize("grid", [False, True])
def test_samples_of_all_folds_come_from_one_search(spark, monkeypatch, grid):
    """F3 to F5: near-miss and Tomek draw for every fold left out at once, and draw what each fold alone would."""
    rng = random.Random(5)
    value = (lambda: float(rng.randint(0, 5))) if grid else (lambda: round(rng.gauss(0, 1), 2))
    rows = [(i, (1 if rng.random() < 0.25 else 0) if rng.random() > 0.03 else None, rng.randrange(3), value(), value()) for i in range(90)]
    df = cut_lineage(spark.createDataFrame(rows, "id long, y int, g int, a double, b double"))
    whole, runs = neighbours._searched, []
    monkeypatch.setattr(neighbours, "_searched", lambda *a: runs.append(1) or whole(*a))
    for method, version in (("near_miss", 3), ("tomek", 1)) if grid else (("near_miss", 1), ("near_miss", 2)):
        runs.clear()
        now = {tuple(r) for r in sampling.undersample_apart(df, "y", "id", ["a", "b"], "g", 3, method, version).collect()}
        assert len(runs) == (2 if grid else 1)
        each = {(r[0], f) for f in range(3) for r in sampling.undersample(df.where(F.col("g") != f), "y", "id", ["a", "b"], method, 1.0, version).collect()}
        assert now == each


def test_one_block_needs_no_exchange_per_level(spark, monkeypatch):
    """a level of trees over one block adds up its gradients where the rows are."""
    rng = random.Random(2)
    rows = [(i % 2, [rng.random() + i % 2, rng.random()]) for i in range(60)]
    df = spark.createDataFrame(rows, "y int, features array<double>")
    dealt, kinds = type(df).repartition, []
    monkeypatch.setattr(type(df), "repartition", lambda self, *a: kinds.append(a[1:]) or dealt(self, *a))
    grown = boosting.fit_gbt(df, "y", boosting.TreeParams(n_estimators=3))
    assert len(grown.feature) == 3 and ("model", "node", "chunk") not in kinds


def test_models_over_few_rows_grow_in_one_job_and_as_level_by_level(spark, monkeypatch):
    """where a task may hold all rows, no round stores the rows again, and the trees are those of the jobs per level."""
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(600, 70)), 2)
    x[rng.random(x.shape) < 0.05] = np.nan
    y = (np.nan_to_num(x[:, 0] - x[:, 66]) + rng.normal(size=600) > 0.4).astype(int)
    data = [(i, None if i % 50 == 0 else int(c), i % 3, i % 4 - 1, [i] * 3, [0] if i % 5 else [], [None if v != v else v for v in r.tolist()]) for i, (c, r) in enumerate(zip(y, x))]
    rows = spark.createDataFrame(data, "h long, y int, fold int, site int, ranks array<long>, picks array<int>, x array<double>").repartition(3)
    monkeypatch.setattr(trees, "LEAST_BLOCK", 100)
    blocks = trees.pack(rows, 70, 3, 1)
    assert blocks.count() > 1
    parts = [trees.Part(0), trees.Part(1, trees.RANKED, limit=300), trees.Part(2, trees.PICKED)]
    edges = trees.tree_edges(blocks, np.zeros((4, 70)), 70)
    models = [trees.Growth(k % 3, 9, 2 + k % 3, 0.3, 1.5, 0.01 * k, 2.0, (1.0, 0.7)[k % 2], (0.6, 1.0)[k % 2], 0.5, 0.1, (None, 2)[k // 3], k) for k in range(6)]
    search = trees.Search(parts, rng.normal(size=(3, 4, 69)) * 0.1, rng.normal(size=(3, 70)), edges, models)
    keep, written = trees.stored, []
    monkeypatch.setattr(trees, "stored", lambda df: written.append(1) or keep(df))
    at_once = trees.grow(blocks, search, 70)
    assert not written and any(len(t.losses) < 9 for t in at_once)
    monkeypatch.setattr(trees, "WHOLE_BYTES", 0)
    for a, b in zip(at_once, trees.grow(blocks, search, 70)):
        assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all()
        assert a.value == pytest.approx(b.value) and a.gain == pytest.approx(b.gain) and a.losses == pytest.approx(b.losses)
    assert written


def test_a_query_goes_to_few_blocks_where_cells_are_small(spark):
    """what cannot be skipped is searched together, and a block sends on the nearest of all its cells only."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(160, 40))
    rows = [(i, v.tolist(), 1, i, 0) for i, v in enumerate(x)]
    points = spark.createDataFrame(rows, "vid long, vec array<double>, n long, vno long, fold int")
    asked = points.where("vid < 30").select(F.col("vid").alias("qid"), "vec")
    for block_rows, most in ((4096, 2), (50, 14)):
        sent = neighbours._searched(asked, points, 2, 0, False, 32, block_rows).collect()
        assert len(sent) <= 30 * most
        for q in range(30):
            near = sorted((r["dist"], r["vid"]) for r in sent if r["qid"] == q)[:2]
            assert [v for _, v in near] == np.argsort(((x - x[q]) ** 2).sum(axis=1))[:2].tolist()


def test_quantile_normalisation_ranks_its_rows_by_one_exchange(spark):
    """the input is evaluated once and no table of the size of the rows is copied; hot samples are ranked over several ranges."""
    rng = random.Random(11)
    samples = [None, 1, 2, 3, *[4] * 40]
    data = [(rng.choice(samples), i, rng.choice([0.0, 1.5, None, float("nan"), rng.gauss(0, 1), rng.gauss(0, 1)])) for i in range(3000)]
    rows = spark.createDataFrame(data, "sample_id int, feature_id long, value double").repartition(5)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    known = [(s, f, v) for s, f, v in data if v is not None and v == v]
    order = {}
    for s, f, v in sorted(known, key=lambda r: (r[0] is not None, r[0] or 0, r[2], hashlib.md5(f"0:{r[1]}".encode()).hexdigest())):
        order.setdefault(s, []).append((f, v))
    want = {(s, f): np.mean([held[k][1] for held in order.values() if len(held) > k]) for s, held_by in order.items() for k, (f, _) in enumerate(held_by)}
    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            read.value = 0
            got = {(r[0], r[1]): r[2] for r in normalize.quantile_normalize(rows.mapInArrow(counted, rows.schema), Long(), log=False).collect()}
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert got == pytest.approx(want)
        assert read.value <= 2 * len(data)      # once to find the borders of the ranges, once for the rows


def test_units_of_logistic_fits_are_dealt_by_rows(spark, monkeypatch):
    """rows that pack into few bytes are not put together in one task."""
    rng = random.Random(3)
    rows = spark.createDataFrame([(i % 4, rng.randrange(2), int(rng.random() < 0.4)) for i in range(4000)], "feature_id int, outcome int, x int")
    monkeypatch.setattr(relate, "TASK_ROWS", 500)
    keep, held = assoc.stored, []

    def watched(df):
        out = keep(df)
        if "level" in out.columns:
            held.extend(r["n"] for r in out.groupBy(F.input_file_name()).agg(F.sum(F.size("y")).alias("n")).collect())
        return out

    monkeypatch.setattr(assoc, "stored", watched)
    fits = {r["feature_id"]: r for r in assoc.logit_by_feature(rows, "outcome", "x", keys=["feature_id"], unit_rows=50).collect()}
    assert sum(held) == 4000 and len(held) > 4 and max(held) <= 1000
    for k in range(4):
        (a, b), (c, d) = ([rows.where(f"feature_id = {k} AND x = {x} AND outcome = {y}").count() for y in (1, 0)] for x in (1, 0))
        assert fits[k]["estimate"] == pytest.approx(np.log(a * d / (b * c))) and fits[k]["n_observations"] == 1000
