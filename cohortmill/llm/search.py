"""Ranked lexical search by bit-sliced Bloom signatures, exact in its results.

1. The index: documents are put in blocks of similar size.  A block is a matrix of bits, one slice (bitmap over
   the block's documents) per signature position.  A document sets two bits for each of its terms and each
   level of LEVELS that the term's frequency reaches.
2. The items' terms pick slices; their conjunctions overestimate where a term occurs how often, so weighted
   sums of slices are upper bounds of the scores.
3. The documents with the highest bounds of an item are scored exactly; the worst of them is a lower
   bound of its last place.  All documents whose bound reaches it are scored exactly and ranked.

Items are searched in blocks of at most about ITEM_TERMS terms, each against the whole index.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import HEAVY, SMALLEST, Scratch, lookup
from .textcodes import LOWER, as_bytes, mix, stretches, word_codes

# Frequencies from which a term sets further bits; the last level stands for all higher ones too.
LEVELS = (1, 2, 3, 4, 6, 9, 13, 19, 28, 42, 63, 94, 141, 211, 316, 474, 711, 1066, 1600, 2400)
# Signature positions for each bit that a document sets, at least (and up to twice that), and bits of a block's matrix.
POSITIONS, MATRIX = 4, 1 << 23
SMALLEST_WIDTH = 256
# Terms of a block of items, and (document, item) pairs that are broadcast at most.
ITEM_TERMS, PAIRS = 1 << 17, 1 << 19

GAP = np.ones(256, bool)
GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

INDEX = "width int, ids array<long>, keys array<long>, lengths array<long>, slices binary"


def term_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all terms, A-Z lower-cased, and, per text, where its terms begin (one more at the end)."""
    return word_codes(texts, lower=True, gap=GAP)


def _frequencies(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) with their frequency."""
    order = np.lexsort((codes, owner))
    own, code = owner[order], codes[order]
    first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (code[1:] != code[:-1])))) if len(own) else np.empty(0, np.int64)
    return own[first], code[first], np.diff(np.append(first, len(own)))


def _slots(codes: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(codes + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64)))
    return (h & np.uint64(width - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(width - 1)).astype(np.int64)


class _Blocks:
    """Documents waiting for their block, by signature width."""

    def __init__(self):
        self.waiting: dict[int, list] = {}
        self.rows: dict[int, int] = {}

    def add(self, ids: pa.Array, keys: np.ndarray, texts: list[bytes]):
        """Yields the blocks that are full."""
        codes, bounds = term_codes(texts)
        lengths = np.diff(bounds)
        own, code, often = _frequencies(codes, np.repeat(np.arange(len(texts)), lengths))
        level = np.searchsorted(np.array(LEVELS), often, "right")
        bits = np.bincount(own, 2 * level, len(texts))
        widths = np.maximum(SMALLEST_WIDTH, 1 << np.ceil(np.log2(np.maximum(bits, 1) * POSITIONS)).astype(np.int64))
        for width in np.unique(widths[lengths > 0]).tolist():
            rows = np.flatnonzero((widths == width) & (lengths > 0))
            of = widths[own] == width
            place = np.searchsorted(rows, own[of])
            self.waiting.setdefault(width, []).append((ids.take(pa.array(rows)), keys[rows], lengths[rows], place, code[of], level[of]))
            self.rows[width] = self.rows.get(width, 0) + len(rows)
            if self.rows[width] * width >= MATRIX:
                yield self.take(width)

    def take(self, width: int) -> tuple:
        parts, rows = self.waiting.pop(width), self.rows.pop(width)
        matrix, at = np.zeros((width, -(-rows // 8) * 8), bool), 0
        for _, keys, _, place, code, level in parts:
            for k in range(int(level.max(initial=0))):
                reach = level > k
                for slot in _slots(code[reach], k, width):
                    matrix[slot, at + place[reach]] = True
            at += len(keys)
        return width, pa.concat_arrays([p[0] for p in parts]).to_pylist(), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), \
            np.packbits(matrix, axis=1, bitorder="little").tobytes()


def build_index(docs: DataFrame) -> DataFrame:
    """Blocks of ``docs`` (id, key, text) that have terms: width, ids, keys, lengths (terms with repeats), slices."""

    def packed(block):
        width, ids, keys, lengths, slices = block
        kinds = [pa.int32(), *[pa.list_(pa.int64())] * 3, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip((width, ids, keys, lengths, slices), kinds)], names=["width", "ids", "keys", "lengths", "slices"])

    def run(batches):
        blocks = _Blocks()
        for batch in batches:
            for a, b in stretches(batch.column(2)):
                part = batch.slice(a, b - a)
                for block in blocks.add(part.column(0), part.column(1).to_numpy(), as_bytes(part.column(2))):
                    yield packed(block)
        for width in sorted(blocks.waiting):
            yield packed(blocks.take(width))

    return docs.select("id", "key", "text").mapInArrow(run, INDEX)


class Items:
    """A block of items: sorted codes of their terms, weights by document frequency, and each item's terms."""

    def __init__(self, codes: np.ndarray, of_item: np.ndarray, n_items: int):
        self.codes, place = np.unique(codes, return_inverse=True)
        order = np.argsort(of_item, kind="stable")
        self.terms = np.split(place[order], np.searchsorted(of_item[order], np.arange(1, n_items)))
        self.weights, self.documents, self.length = np.zeros(len(self.codes), np.int64), 0, 1

    def weigh(self, frequency: np.ndarray, documents: int, length: int) -> None:
        """Sets floor(1000 ln((2 N + 2) / (2 df + 1))) for every term."""
        self.documents, self.length = documents, length
        self.weights = np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * frequency + 1))).astype(np.int64)

    def measure(self, lengths: np.ndarray) -> np.ndarray:
        return 50 + (50 * lengths * self.documents) // self.length

    def found(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, place of the term, frequency) of the items' terms in the texts, by text and term, and the texts' lengths."""
        codes, bounds = term_codes(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = self.codes[place] == codes
        return *_frequencies(place[hit], owner[hit]), np.diff(bounds)

    def bounds(self, width: int, lengths: np.ndarray, slices: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, items x documents of a block."""
        out, part = np.zeros((len(self.terms), len(lengths)), np.int64), self.measure(lengths)
        weights, there, last = self.weights.astype(float), None, np.zeros(len(lengths), np.int64)
        for k, level in enumerate(LEVELS):
            reach = lengths >= level
            if not reach.any():
                break
            one, two = _slots(self.codes, k, width)
            rows = slices[one] & slices[two]
            there = rows if there is None else there & rows
            if not there.any():
                break
            most = np.minimum(lengths, LEVELS[k + 1] - 1) if k + 1 < len(LEVELS) else lengths
            value = np.where(reach, 1_000_000_000 * most // np.maximum(1000 * most + 20 * part, 1), last)
            bits = np.unpackbits(there, axis=1, count=len(lengths), bitorder="little")
            used = there.any(axis=1)
            for i, terms in enumerate(self.terms):
                terms = terms[used[terms]]
                if len(terms):
                    out[i] += (weights[terms] @ bits[terms]).astype(np.int64) * (value - last)
            last = value
        return out


def _blocks(batch, items: Items):
    """Per block: ids, keys and upper bounds."""
    for width, ids, keys, lengths, slices in zip(*(batch.column(i) for i in range(5))):
        lengths = np.asarray(lengths.values)
        held = np.frombuffer(slices.as_buffer(), np.uint8).reshape(width.as_py(), -1)
        yield ids.values, np.asarray(keys.values), items.bounds(width.as_py(), lengths, held)


def _pairs(item: np.ndarray, ids: pa.Array, keys: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids, pa.array(keys), pa.array(bound)], names=["item", "id", "key", "bound"])


def _highest(items, top: int):
    """The ``top`` rows of highest bound above 0 of each item, of all blocks of a task."""

    def run(batches):
        held = None
        for batch in batches:
            for ids, keys, bounds in _blocks(batch, items.value):
                n = min(top, bounds.shape[1])
                at = np.argpartition(-bounds, n - 1, axis=1)[:, :n]
                found = np.take_along_axis(bounds, at, axis=1), np.asarray(ids.fill_null(SMALLEST))[at], keys[at]
                held = found if held is None else tuple(np.concatenate((a, b), axis=1) for a, b in zip(held, found))
                if held[0].shape[1] > 20 * top:
                    at = np.argpartition(-held[0], top - 1, axis=1)[:, :top]
                    held = tuple(np.take_along_axis(h, at, axis=1) for h in held)
        if held is not None:
            n = min(top, held[0].shape[1])
            at = np.argpartition(-held[0], n - 1, axis=1)[:, :n]
            item, (bound, ids, keys) = np.repeat(np.arange(len(held[0])), n), (np.take_along_axis(h, at, axis=1).ravel() for h in held)
            some = bound > 0
            yield _pairs(item[some], pa.array(ids[some]), keys[some], bound[some])

    return run


def _reaching(items, floors):
    """All rows whose bound reaches the item's floor."""

    def run(batches):
        for batch in batches:
            for ids, keys, bounds in _blocks(batch, items.value):
                item, row = np.nonzero(bounds >= floors.value[:, None])
                if len(item):
                    yield _pairs(item, ids.take(pa.array(row)), keys[row], bounds[item, row])

    return run


def _count_terms(items):
    """How many documents hold each of the items' terms."""

    def run(batches):
        total = np.zeros(len(items.value.codes), np.int64)
        for batch in batches:
            for a, b in stretches(batch.column(0)):
                _, term, _, _ = items.value.found(as_bytes(batch.column(0).slice(a, b - a)))
                total += np.bincount(term, minlength=len(total))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there])], names=["term", "n"])

    return run


def _score(items):
    """Exact scores of documents (id, text, items)."""

    def run(batches):
        held = items.value
        for batch in batches:
            for a, b in stretches(batch.column(1)):
                part = batch.slice(a, b - a)
                own, term, often, lengths = held.found(as_bytes(part.column(1)))
                value = 1_000_000_000 * often // (1000 * often + 20 * held.measure(lengths)[own])
                value *= held.weights[term]
                cut = np.searchsorted(own, np.arange(len(part) + 1)).tolist()
                item, row, score, full = [], [], [], np.zeros(len(held.codes), np.int64)
                for k, wanted in enumerate(part.column(2).to_pylist()):
                    full[term[cut[k]:cut[k + 1]]] = value[cut[k]:cut[k + 1]]
                    item += wanted
                    row += [k] * len(wanted)
                    score += [int(full[held.terms[i]].sum()) for i in wanted]
                    full[term[cut[k]:cut[k + 1]]] = 0
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), part.column(0).take(pa.array(row, pa.int64())), pa.array(score, pa.int64())], names=["item", "id", "score"])

    return run


def _scored(pairs: DataFrame, docs: DataFrame, items, total: int, scratch: Scratch) -> DataFrame:
    """Exact scores (item, id, score) of ``pairs`` (item, id, key): one row per item and row of ``docs``.

    Few pairs are broadcast, so that no text is shuffled; many are joined, rows with the same id and text
    that are a large share of all apart from the others.
    """
    single = pairs.groupBy("id", "key", "item").agg(F.count("*").alias("w"))
    lists = scratch.keep(single.groupBy("id", "key").agg(F.collect_list("item").alias("items"), F.max("w").alias("w")))
    size, most = lists.agg(F.sum(F.size("items")), F.max("w")).head()
    if (size or 0) <= PAIRS:
        joined = docs.join(F.broadcast(lists), ["id", "key"])
    elif most < total * HEAVY:
        joined = docs.join(lists, ["id", "key"])
    else:
        joined = lookup(docs, lists, ["id", "key"], "w", total)
    return joined.select("id", "text", "items").mapInArrow(_score(items), "item int, id long, score long")


def search(docs: DataFrame, queries: DataFrame, top: int = 50, scratch: Scratch | None = None) -> DataFrame:
    """The ``top`` documents of each item of ``queries`` (item_id, text): item_id, rank, doc_id, score.

    Every row of ``docs`` with a term is indexed and counts as a document; repeated rows are ranked each.  Rows of
    ``queries`` with the same item_id (or none) are one item with the terms of all.  Null, empty and blank texts
    have no terms and are never found; items without terms have no rows.  Equal scores go by doc_id, a
    null one first.  Texts are read whole.  Other columns are not read, so their names do not matter.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    text = F.col("text").cast("string").alias("text")
    rows = docs.select(F.coalesce("doc_id", F.lit(SMALLEST)).alias("id"), F.xxhash64("text").alias("key"), text)

    def terms_of(batches):
        for batch in batches:
            for a, b in stretches(batch.column(1)):
                codes, bounds = term_codes(as_bytes(batch.column(1).slice(a, b - a)))
                row = np.repeat(np.arange(a, b), np.diff(bounds))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(codes.view(np.int64))], names=["item_id", "code"])

    terms = scratch.keep(queries.select(F.col("item_id").cast("long"), text).mapInArrow(terms_of, "item_id long, code long").distinct())
    blocks = -(-terms.count() // ITEM_TERMS)
    index = scratch.keep(build_index(rows))
    total, length = index.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b))).head()
    out = None
    for block in range(blocks if total else 0):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toPandas()
        if not len(own):
            continue
        ids, of_item = np.unique(own["item_id"].fillna(SMALLEST).astype("int64"), return_inverse=True)
        found = _search(rows, index, Items(own["code"].to_numpy().view(np.uint64), of_item, len(ids)), total, length, top, scratch)
        names = spark.createDataFrame([(k, int(i)) for k, i in enumerate(ids)], "item int, item_id long")
        placed = scratch.keep(found.join(F.broadcast(names), "item").select("item_id", "rank", "id", "score"))
        out = placed if out is None else out.unionAll(placed)
    if out is None:
        out = spark.createDataFrame([], "item_id long, rank int, id long, score long")
    plain = lambda c: F.when(F.col(c) != SMALLEST, F.col(c))
    return out.select(plain("item_id").alias("item_id"), "rank", plain("id").alias("doc_id"), "score")


def _search(rows: DataFrame, index: DataFrame, items: Items, total: int, length: int, top: int, scratch: Scratch) -> DataFrame:
    """(item, rank, id, score) of a block of items."""
    context = rows.sparkSession.sparkContext
    counted = rows.select("text").mapInArrow(_count_terms(context.broadcast(items)), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(len(items.codes))
    frequency[counted["term"]] = counted["n"]
    items.weigh(frequency, total, length)
    held = context.broadcast(items)
    pairs = "item int, id long, key long, bound long"
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "id", "key"))
    first = index.mapInArrow(_highest(held, top), pairs).withColumn("place", place).where(F.col("place") <= top).drop("place")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    ranked = lambda scored: scored.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    last = ranked(_scored(first, rows, held, total, scratch)).where(F.col("rank") == top).select("item", "score").toPandas()
    floors = np.ones(len(items.terms), np.int64)
    floors[last["item"]] = last["score"]
    reaching = index.mapInArrow(_reaching(held, context.broadcast(floors)), pairs)
    return ranked(_scored(reaching, rows, held, total, scratch))
