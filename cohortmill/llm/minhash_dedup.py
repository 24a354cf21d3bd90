"""Near-duplicates by one-permutation MinHash with optimal densification.

Documents with equal shingle sets form a class with a number of its own; one text stands for it, and doc_ids come
back only at the end.  A class falls into one bucket per band of its signature; of buckets with the
same members one is kept.  In every bucket the smallest number is the centre of a star: the others are
compared with it only.  Buckets whose members are then still in several components, and only those, get further
stars.  What still is apart is settled in clusters of such buckets: the classes outside a
cluster's largest component are held in blocks, and all of the cluster pass by each block in slices, so that no link
found by a bucket is lost to the components and no list of pairs is made.  Every comparison is of full sets.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, components, free_name, lookup
from .textcodes import BASE2, as_bytes, mix, spans, stretches, word_codes

BANDS, ROWS = 36, 6
BINS = BANDS * ROWS
# Members of a star that are compared in one task.
STAR = 500
# Stars before the rest is settled in clusters, and classes of a cluster that a task holds and that pass by them.
STARS = 2
BLOCK, SLICE = 300, 1000
# Open buckets that are broadcast at most (16 bytes each).
OPEN = 1 << 20


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct codes of the shingles of each text, A-Z lower-cased; a shorter text is one shingle."""
    codes, bounds = word_codes(texts, lower=True)
    grams = spans(codes, width)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            own = np.sort(grams[a:b - width + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif b > a:
            out.append(mix(spans(codes[a:b], b - a, BASE2) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """BINS minima per set that is not empty: the smallest code of each bin of the code range.

    An empty bin takes the value of the first filled one of a random sequence of bins that depends
    on the bin only, so equal fillings choose alike.
    """
    sign, filled = np.zeros((len(sets), BINS), np.uint64), np.zeros((len(sets), BINS), bool)
    for i, own in enumerate(sets):
        bin_ = ((own >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        first = np.flatnonzero(np.diff(bin_.astype(np.int64), prepend=-1))
        where = bin_[first].astype(np.int64)
        sign[i, where], filled[i, where] = own[first], True
    row, col = np.nonzero(~filled & (filled.any(axis=1))[:, None])
    step = 0
    while len(row):
        step += 1
        donor = (mix(col.astype(np.uint64) + np.uint64(step * 1_000_003)) % np.uint64(BINS)).astype(np.int64)
        found = filled[row, donor]
        sign[row[found], col[found]] = sign[row[found], donor[found]]
        row, col = row[~found], col[~found]
    return sign


def bands(sign: np.ndarray) -> np.ndarray:
    """BANDS bucket codes per signature."""
    out = np.zeros((len(sign), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(BASE2)
    for r in range(ROWS):
        out = mix(out * np.uint64(31) + sign[:, r::ROWS])
    return out.view(np.int64)


def _sign(width: int):
    def run(batches):
        for batch in batches:
            for a, b in stretches(batch.column(1)):
                sets = shingle_sets(as_bytes(batch.column(1).slice(a, b - a)), width)
                marks = bands(signatures(sets))
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, marks.size + 1, BANDS), pa.int32()), pa.array(marks.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), lists],
                    names=["id", "key", "n", "digest", "bands"])
    return run


def _parts(batches):
    """Batches with sets in the last column, cut so that few of them are Python objects at once."""
    for batch in batches:
        for a, b in stretches(batch.column(4)):
            yield batch.slice(a, b - a)


def _compare(percent: int):
    """Rows sorted by (centre, salt, role): the set of a centre, then those of its members."""

    def run(batches):
        now, own = None, None
        for batch in _parts(batches):
            centre, ids, linked = [], [], []
            for c, salt, member, data in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                data = np.frombuffer(data, np.uint64)
                if member is None:
                    now, own = (c, salt), data
                    continue
                assert now == (c, salt)
                place = np.minimum(np.searchsorted(own, data), len(own) - 1)
                both = int((own[place] == data).sum())
                centre.append(c)
                ids.append(member)
                linked.append(100 * both >= percent * (len(own) + len(data) - both))
            yield pa.RecordBatch.from_arrays([pa.array(centre, pa.int64()), pa.array(ids, pa.int64()), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
    return run


def verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int, scratch: Scratch, most: int | None = None) -> DataFrame:
    """``pairs`` (a, b) with ``linked``: whether the full shingle sets are similar enough.

    Sets travel to their centre ``a``; a centre with many members is copied once per STAR members.
    ``most`` bounds the number of pairs, where the caller knows one.
    """
    pairs = scratch.keep(pairs, most)
    total = pairs.count()
    stars = scratch.keep(pairs.groupBy("a").agg(F.count("*").alias("w")), total)
    salts = F.ceil(F.col("w") / STAR).cast("int")
    members = lookup(pairs, stars, ["a"], "w", total, narrow=True).select(
        F.col("b").alias("id"), F.struct("a", F.pmod(F.xxhash64("b"), salts).cast("int").alias("salt"), F.lit(1).alias("role"), F.col("b").alias("member")).alias("to"))
    centres = stars.select("a", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")).select(
        F.col("a").alias("id"), F.struct("a", "salt", F.lit(0).alias("role"), F.lit(None).cast("long").alias("member")).alias("to"))
    return _gather(texts, members.unionAll(centres), width).mapInArrow(_compare(percent), "a long, b long, linked boolean").distinct()


def _gather(texts: DataFrame, routes: DataFrame, width: int) -> DataFrame:
    """The sets of classes, sent along ``routes`` (id, to: a, salt, role, member), sorted where they arrive."""

    def send(batches):
        for batch in batches:
            for a, b in stretches(batch.column(0)):
                texts, routes = as_bytes(batch.column(0).slice(a, b - a)), batch.column(1).slice(a, b - a).to_pylist()
                out, size = [], 0
                for own, to in zip(shingle_sets(texts, width), routes):
                    data = own.tobytes()
                    for r in to:
                        out.append((r["a"], r["salt"], r["role"], r["member"], data))
                        size += len(data) + 40
                        if size > 1 << 22:
                            yield packed(out)
                            out, size = [], 0
                if out:
                    yield packed(out)

    def packed(rows):
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["a", "salt", "role", "member", "data"])

    lists = routes.groupBy("id").agg(F.collect_list("to").alias("to"))
    placed = texts.join(lists.hint("shuffle_hash"), "id").select("text", "to").mapInArrow(send, "a long, salt int, role int, member long, data binary")
    return placed.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")


def _settle(percent: int):
    """Rows of a block: held sets (role 0), then all of the cluster; ``member`` is the document's component.

    Yields a link for every two components that a pair of documents joins, once per block.
    """

    def run(batches):
        now, held, index = None, [], None
        for batch in _parts(batches):
            links = []
            for cluster, block, role, component, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (cluster, block) != now:
                    now, held, index, root = (cluster, block), [], None, {}
                data = np.frombuffer(data, np.uint64)
                if role == 0:
                    held.append((component, data))
                    continue
                if index is None and held:
                    codes = np.concatenate([h[1] for h in held])
                    order = np.argsort(codes, kind="stable")
                    index = codes[order], np.repeat(np.arange(len(held)), [len(h[1]) for h in held])[order]
                    sizes, labels = np.array([len(h[1]) for h in held]), np.array([h[0] for h in held])
                if not held:
                    continue
                low, high = np.searchsorted(index[0], data, "left"), np.searchsorted(index[0], data, "right")
                n = high - low
                hit = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                both = np.bincount(index[1][hit], minlength=len(held))
                near = (100 * both >= percent * (sizes + len(data) - both)) & (labels != component)
                for other in set(labels[near].tolist()):
                    x, y = _root(root, component), _root(root, other)
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        links.append((component, other))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])
    return run


def _root(root: dict, x: int) -> int:
    while x in root:
        x = root[x]
    return x


def settle(open_: DataFrame, texts: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between components that share buckets in ``open_`` (bucket, rep, component)."""
    centre = scratch.keep(open_.groupBy("bucket").agg(F.min("rep").alias("centre"), F.count("*").alias("w")))
    total = centre.agg(F.sum("w")).head()[0] or 0
    cluster = components(lookup(open_.select("bucket", "rep"), centre, ["bucket"], "w", total, narrow=True).select(F.col("rep").alias("a"), F.col("centre").alias("b")), scratch, total)
    members = scratch.keep(open_.select(F.col("rep").alias("id"), F.col("component").alias("own")).distinct().join(cluster.withColumnRenamed("component", "cluster"), "id"), total)
    parts = members.groupBy("cluster", "own").agg(F.count("*").alias("k"))
    main = scratch.keep(parts.groupBy("cluster").agg(F.max_by("own", F.struct("k", "own")).alias("main"), F.sum("k").alias("w"), F.max("k").alias("most")), total)
    placed = lookup(members, main, ["cluster"], "w", members.count(), narrow=True)
    blocks, slices = F.ceil((F.col("w") - F.col("most")) / BLOCK).cast("int"), F.ceil(F.col("w") / SLICE).cast("int")
    to = lambda salt, role: F.struct(F.col("cluster").alias("a"), salt.alias("salt"), F.lit(role).alias("role"), F.col("own").alias("member"))
    # a unit is a block and a slice: a held class goes to all slices of its block, a passing one to its slice of all blocks
    block, slice_ = F.pmod(F.xxhash64("id"), blocks).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), slices).cast("int")
    held = placed.where("own <> main").select("id", "cluster", "own", block.alias("block"), slices.alias("slices"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    passing = placed.select("id", "cluster", "own", slice_.alias("slice"), slices.alias("slices"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    routes = [part.select("id", to(F.col("block") * F.col("slices") + F.col("slice"), role).alias("to")) for part, role in ((held, 0), (passing, 1))]
    return _gather(texts, routes[0].unionAll(routes[1]), width).mapInArrow(_settle(percent), "a long, b long").distinct()


def _labelled(docs: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """Per row of ``docs``: id, key (hash of the text), n (set size), component (smallest id reachable, null first)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).withColumn("key", F.xxhash64("text"))
    signed = scratch.keep(rows.select("id", "text", "key").mapInArrow(_sign(width), "id long, key long, n long, digest binary, bands array<long>"))
    total = signed.count()
    classes = scratch.keep(signed.where("n > 0").groupBy("digest").agg(
        F.min(F.struct("id", "key")).alias("first"), F.first("n").alias("n"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
        .withColumn("rep", F.monotonically_increasing_id()))
    buckets = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    mark = [F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    found = buckets.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("c"), F.count("*").alias("w"), *mark).where("w > 1")
    full = scratch.keep(found.groupBy("x1", "x2", "w", "c").agg(F.min("bucket").alias("bucket")).select("bucket", "c", "w"), total * BANDS)
    weight = full.agg(F.sum("w")).head()[0] or 0
    component = spark.createDataFrame([], "id long, component long")
    if weight:
        members = scratch.keep(lookup(buckets, full.select("bucket", "w", F.col("c.rep").alias("centre"), F.col("c.n").alias("centre_n")), ["bucket"], "w", weight, narrow=True), total * BANDS)
        texts = _texts(classes, members, rows, scratch)
        close = F.greatest("n", "centre_n") * percent <= F.least("n", "centre_n") * 100
        pairs = members.where("rep <> centre").where(close).select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
        tested = scratch.keep(verify(pairs, texts, width, percent, scratch, weight), weight)
        open_ = members.select("bucket", "rep", "n")
        for star in range(STARS):
            component = scratch.keep(components(tested.where("linked").select("a", "b"), scratch, weight * (star + 1)), 2 * weight * (star + 1))
            open_ = _open_buckets(open_.select("bucket", "rep", "n"), component, scratch)
            if not open_.limit(1).count():
                break
            if star == STARS - 1:
                links = tested.where("linked").select("a", "b").unionAll(settle(open_, texts, width, percent, scratch))
                component = scratch.keep(components(links, scratch))
                break
            pairs = _next_star(open_, star, percent, scratch)
            new = pairs.select("a", "b").distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti").join(
                tested.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
            tested = scratch.keep(tested.unionAll(verify(new, texts, width, percent, scratch, weight)), 2 * weight)
    placed = scratch.keep(classes.select("digest", "rep", "copies", "first.id").join(component.withColumnRenamed("id", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("group"), "copies", "id"), total)
    groups = scratch.keep(placed.groupBy("group").agg(F.min(F.struct("id")).alias("least"), F.count("*").alias("w")), total)
    named = lookup(placed, groups.withColumn("component", F.col("least.id")).drop("least"), ["group"], "w", placed.count(), narrow=True)
    classed = scratch.keep(named.select("digest", "component", "copies", F.lit(True).alias("classed")), total)
    joined = lookup(signed.select("id", "key", "n", "digest"), classed, ["digest"], "copies", total, "left", narrow=True)
    return joined.select("id", "key", "n", F.when(F.col("classed"), F.col("component")).otherwise(F.col("id")).alias("component"))


def _texts(classes: DataFrame, members: DataFrame, rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(id: class number, text) of all classes that share a bucket: read from the documents once."""
    wanted = classes.select("rep", "first.id", "first.key").join(members.select("rep").distinct(), "rep", "left_semi").select(
        F.col("rep").alias("class"), F.col("id").alias("of_id"), F.col("key").alias("of_key"))
    match = rows["id"].eqNullSafe(F.col("of_id")) & (rows["key"] == F.col("of_key"))
    return scratch.keep(rows.join(wanted, match).select(F.col("class").alias("id"), "text").dropDuplicates(["id"]))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked whose sets of distinct ``width``-word shingles have a Jaccard similarity
    of ``percent`` / 100 or more.  A pair at 0.8 misses all buckets with probability 2e-5.
    Null, empty and blank texts have an empty set and are linked with nothing.  Repeated rows, and different
    texts with the same doc_id or none, are rows of their own.  A null doc_id counts as smallest, and is
    null in component_id.  Texts are read whole; other columns are not read, so their names do not matter.
    """
    found = _labelled(docs, width, percent, scratch or Scratch(docs.sparkSession))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("component").eqNullSafe(F.col("id")).alias("kept"))


def _open_buckets(members: DataFrame, component: DataFrame, scratch: Scratch) -> DataFrame:
    """Members (bucket, rep, n), with their component, of the buckets that hold several components."""
    placed = scratch.keep(members.join(component.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    mixed = scratch.keep(placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("w")).where("low < high AND w > 2").select("bucket", "w"))
    count, total = mixed.agg(F.count("*"), F.sum("w")).head()
    if count <= OPEN:
        return scratch.keep(placed.join(F.broadcast(mixed.select("bucket")), "bucket", "left_semi"))
    return scratch.keep(lookup(placed, mixed, ["bucket"], "w", total).drop("w"))


def _next_star(open_: DataFrame, star: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of other centres, chosen by a hash, with the members of other components."""
    centre = scratch.keep(open_.groupBy("bucket").agg(F.min_by(F.struct(F.col("rep").alias("centre"), F.col("n").alias("centre_n"), F.col("component").alias("centre_component")),
                                                               F.xxhash64("rep", F.lit(star))).alias("c"), F.count("*").alias("w")).select("bucket", "w", "c.*"))
    total = centre.agg(F.sum("w")).head()[0] or 0
    return lookup(open_, centre, ["bucket"], "w", total, narrow=True).where("component <> centre_component").where(
        F.greatest("n", "centre_n") * percent <= F.least("n", "centre_n") * 100).select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with the document of smallest doc_id of each group, all columns unchanged, whatever their names.

    Rows with that doc_id stay, repeated ones too; documents without an id count as smallest.
    """
    found = _labelled(docs, width, percent, scratch or Scratch(docs.sparkSession))
    stay = found.where(F.col("component").eqNullSafe(F.col("id"))).select(F.col("id").alias(free_name(docs, "kept_id")), F.col("key").alias(free_name(docs, "kept_key"))).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(stay[stay.columns[0]]) & (F.xxhash64(docs["text"].cast("string")) == stay[stay.columns[1]])
    return docs.join(stay, same, "left_semi")
