"""Near-duplicate vectors by an inverted multi-index.

The two halves of a unit vector are quantised by codebooks of their own; a pair of codewords is a cell of
the product grid.  Every vector is stored in one cell and, as a query, visits the cells nearest to it
in the order of the sum of both distances (multi-sequence order), as many as a bounded sample needs to find
neighbours at the threshold with the target recall.  A pair is found if either visits the
cell of the other; it is then verified by cosine in double precision.

Distances to codewords are taken on whole numbers held in doubles, which are exact in any order of summation, so all
tasks agree on who visits what.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SMALLEST, Scratch, components, lookup

SCALE = 1 << 14
# Vectors to a cell on average, and vectors in a task's share of a first-half list.
CELL, SHARE = 4, 2_000


def _halves(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = unit.shape[1] // 2
    whole = np.rint(unit * SCALE)
    return whole[:, :half], whole[:, half:]


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (points * points).sum(axis=1, keepdims=True) - 2 * points @ book.T + (book * book).sum(axis=1)


def _codebook(points: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows; whole-numbered codewords."""
    book = points[np.linspace(0, len(points) - 1, size).astype(int)].astype(float)
    for _ in range(rounds):
        near = _distances(points, book).argmin(axis=1)
        n = np.bincount(near, minlength=size)
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
    return np.rint(book)


class MultiIndex:
    """Codebooks of both halves and the number of cells to visit."""

    def __init__(self, sample: np.ndarray, cells: int, threshold: float, recall: float):
        side = int(max(1, min(np.sqrt(cells), len(sample) // 8)))
        self.books = [_codebook(h, side) for h in _halves(sample)]
        # pairs of ranks that can be among the first ``visits`` cells are those with (a+1)(b+1) <= visits
        noise = np.random.default_rng(7).standard_normal(sample.shape)
        noise -= (noise * sample).sum(axis=1, keepdims=True) * sample
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        other = threshold * sample + np.sqrt(1 - threshold * threshold) * noise
        one, two = self._sorted_sums(sample), self._sorted_sums(other)
        rank = np.minimum(self._rank(one, self.sums_of(sample, *self.cell(other))), self._rank(two, self.sums_of(other, *self.cell(sample))))
        self.visits = int(max(1, np.ceil(np.quantile(rank, recall, method="higher"))))

    def _sorted_sums(self, unit):
        a, b = (_distances(h, k) for h, k in zip(_halves(unit), self.books))
        return a, b

    def _rank(self, grid, sums):
        """How many cells a query visits until it has seen ``sums``."""
        out = np.zeros(len(sums), np.int64)
        for i, (a, b, s) in enumerate(zip(*grid, sums)):
            out[i] = np.searchsorted(np.sort(b), s - a, "right").sum()
        return out

    def cell(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = (_distances(h, k).argmin(axis=1) for h, k in zip(_halves(unit), self.books))
        return a, b

    def sums_of(self, unit: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Distance of each vector to its cell (i, j)."""
        (u, v), (a, b) = _halves(unit), self.books
        return ((u - a[i]) ** 2).sum(axis=1) + ((v - b[j]) ** 2).sum(axis=1)

    def visit(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, first codewords and second codewords of all visited cells, and each row's largest visited distance."""
        side, n = len(self.books[0]), len(unit)
        a, b = (_distances(h, k) for h, k in zip(_halves(unit), self.books))
        near_a, near_b = (np.argsort(d, axis=1, kind="stable") for d in (a, b))
        p, q = np.divmod(np.arange(side * side), side)
        reach = (p + 1) * (q + 1) <= self.visits
        p, q = p[reach], q[reach]
        rows = np.arange(n)[:, None]
        sums = np.take_along_axis(a, near_a, 1)[:, p] + np.take_along_axis(b, near_b, 1)[:, q]
        most = np.partition(sums, min(self.visits, sums.shape[1]) - 1, axis=1)[:, min(self.visits, sums.shape[1]) - 1]
        row, at = np.nonzero(sums <= most[:, None])
        return row, near_a[rows[row, 0], p[at]], near_b[rows[row, 0], q[at]], most


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _find_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number for each of n nodes, by repeated minima over links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_vectors(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.995, sample_rows: int = 4096, scratch: Scratch | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Links join vectors with cosine >= ``threshold``.  Equal vectors are handled once and counted each.
    Vectors that are null, zero or have null or non-finite components link with nothing; so do vectors of
    another length than most.  The index is fitted on ``sample_rows`` vectors, chosen by a hash of the id,
    and holds all.  Repeated rows count as vectors of their own; a null vec_id counts as smallest.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark)
    v = F.col("embedding").cast("array<double>")
    fit = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0), F.lit(False))
    every = scratch.keep(vectors.select(F.coalesce("vec_id", F.lit(SMALLEST)).alias("id"), F.when(fit, v).alias("v")).withColumn("key", F.sha2(F.col("v").cast("string"), 256)))
    total = every.count()
    size = every.where("v IS NOT NULL").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).head()
    if size is None:
        return every.select(F.when(F.col("id") != SMALLEST, F.col("id")).alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.when(F.col("id") != SMALLEST, F.col("id")).alias("component_id"), F.lit(True).alias("kept"))
    usable = F.col("v").isNotNull() & (F.size("v") == size["d"])
    # F.first is safe here: rows of a key have the same vector
    classes = scratch.keep(every.where(usable).groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v")))
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("v").toPandas()
    n = classes.count()
    index = spark.sparkContext.broadcast(MultiIndex(_unit(sample["v"].tolist()), max(1, n // CELL), threshold, recall))
    sizes = dict(classes.select("v").mapInArrow(lambda it: _cells(it, index), "cell int").groupBy("cell").count().collect())
    shares = spark.sparkContext.broadcast({int(c): -(-k // SHARE) for c, k in sizes.items()})

    schema = "cell int, share int, member boolean, id long, copies long, second int, most double, visits binary, v binary"
    sent = classes.select("rep", "copies", "v").mapInArrow(lambda it: _send(it, index, shares), schema)
    met = sent.repartition("cell", "share").sortWithinPartitions("cell", "share", F.desc("member"))
    found = scratch.keep(met.mapInArrow(lambda it: _meet(it, index, threshold), "id long, root long, n long"))
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    component = components(found.where("root IS NOT NULL").select(F.col("id").alias("a"), F.col("root").alias("b")), scratch)
    solved = scratch.keep(classes.select("key", "rep", "copies").join(links.withColumnRenamed("id", "rep"), "rep", "left").join(
        component.withColumnRenamed("id", "rep"), "rep", "left").select(
            "key", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")))
    joined = lookup(every.where(usable).select("id", "key"), solved, ["key"], "copies", total).select("id", "n_links", "component").unionAll(
        every.where(~F.coalesce(usable, F.lit(False))).select("id", F.lit(0).cast("long"), "id"))
    plain = lambda c: F.when(F.col(c) != SMALLEST, F.col(c))
    return joined.select(plain("id").alias("vec_id"), "n_links", plain("component").alias("component_id"), (F.col("component") == F.col("id")).alias("kept"))


def _cells(batches, index):
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(index.value.cell(_unit(batch.column(0).to_pylist()))[0], pa.int32())], names=["cell"])


def _send(batches, index, shares):
    """A vector goes, as a member, to a share of the list of its first codeword, and as a query to all shares of each list it visits."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            ids, copies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            unit = _unit(batch.column(2).to_pylist())
            first, second = index.value.cell(unit)
            row, a, b, most = index.value.visit(unit)
            rows = []
            for k, id_ in enumerate(ids):
                data = unit[k].tobytes()
                rows.append((int(first[k]), id_ % shares.value[int(first[k])], True, id_, copies[k], int(second[k]), float(most[k]), None, data))
            order = np.lexsort((a, row))
            row, a, b = row[order], a[order], b[order].astype("<i4")
            cut = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(a, prepend=-1) != 0))
            for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(row)]):
                k, visits = int(row[s]), b[s:e].tobytes()
                for share in range(shares.value.get(int(a[s]), 0)):
                    rows.append((int(a[s]), share, False, ids[k], copies[k], int(first[k]) << 16 | int(second[k]), float(most[k]), visits, unit[k].tobytes()))
            kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary()]
            for s in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[s:s + 10_000]), kinds)],
                                                 names=["cell", "share", "member", "id", "copies", "second", "most", "visits", "v"])


def _meet(batches, index, threshold):
    """Members of a share come first and are held; queries follow in blocks."""
    now, members = None, []
    ids = copies = cells = most = unit = None

    def settle():
        nonlocal ids, copies, cells, most, unit
        ids, copies, cells, most = (np.array(c) for c in zip(*(m[:4] for m in members)))
        unit = np.frombuffer(b"".join(m[4] for m in members)).reshape(len(members), -1)

    def compare(queries):
        q_ids, q_copies, q_cells = (np.array([q[k] for q in queries], np.int64) for k in (0, 1, 2))
        q_unit = np.frombuffer(b"".join(q[4] for q in queries)).reshape(len(queries), -1)
        visited = np.zeros((len(queries), len(index.value.books[1])), bool)
        for k, q in enumerate(queries):
            visited[k, np.frombuffer(q[3], "<i4")] = True
        qs, ms = np.nonzero((q_unit @ unit.T >= threshold - 1e-9) & visited[:, cells])
        # the verdict itself: each product summed in the same way for both directions
        cosine = np.einsum("ij,ij->i", q_unit[qs], unit[ms])
        there = (cosine >= threshold) & (q_ids[qs] != ids[ms])
        qs, ms = qs[there], ms[there]
        # a pair counts for the query; for the member only if it does not visit the query's cell itself
        own = index.value.sums_of(unit[ms], q_cells[qs] >> 16, q_cells[qs] & 0xFFFF) <= most[ms]
        nodes, flat = np.unique(np.concatenate((q_ids[qs], ids[ms])), return_inverse=True)
        a, b = flat[:len(qs)], flat[len(qs):]
        n = np.bincount(a, weights=copies[ms], minlength=len(nodes)) + np.bincount(b, weights=np.where(own, 0, q_copies[qs]), minlength=len(nodes))
        root = nodes[_find_roots(len(nodes), a, b)] if len(nodes) else nodes
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(root, pa.int64()), pa.array(n.astype(np.int64))], names=["id", "root", "n"])

    queries: list = []
    for batch in batches:
        for cell, share, member, *rest in zip(*(batch.column(i).to_pylist() for i in range(9))):
            if (cell, share) != now:
                if queries:
                    yield compare(queries)
                now, members, queries, unit = (cell, share), [], [], None
            id_, n, second, far, visits, v = rest
            if member:
                members.append((id_, n, second, far, v))
            elif members:
                if unit is None:
                    settle()
                queries.append((id_, n, second, visits, v))
                if len(queries) >= 500:
                    yield compare(queries)
                    queries = []
    if queries:
        yield compare(queries)
