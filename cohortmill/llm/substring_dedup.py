"""Removing passages that occurred before: windows of words, prefiltered by a count-min sketch.

1. Every batch counts, in a sparse count-min sketch, the rarest-code gram of each window (each
   position once).  Equal windows choose equal grams at equal places, so the count of a gram is never below
   the number of its windows.  The sketches are merged by Spark, block by block.
2. Windows whose gram is estimated to occur once are unique and go no further.  The others are grouped
   exactly by 128-bit code; all but the first of each group are marked.
3. Marked windows return to their documents, and the words that they cover are removed.

The merged sketch has a fixed largest size.  If the corpus outgrows it, more windows reach the
exact grouping, and the result stays the same.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SMALLEST, Scratch
from .textcodes import BASE, BASE2, as_bytes, groups_of_texts, spans, word_codes

ROWS, BLOCK = 2, 1 << 16
# Bits of the merged sketch per row at most: 16 MB for each of its two rows.
MOST_COUNTERS = 1 << 27
# Windows per shard of the exact grouping, and windows that a task holds before it sends them on.
SHARD_WINDOWS = 500_000
FLUSH = 400_000


def _first_minimum(codes: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest code in every run of ``width`` codes."""
    low, place, have = codes, np.arange(len(codes)), 1
    while have < width:
        step = min(have, width - have)
        n = len(low) - step
        later = low[step:] < low[:n]
        low, place = np.where(later, low[step:], low[:n]), np.where(later, place[step:], place[:n])
        have += step
    return place


def _windows(texts: list[bytes], window: int, gram: int):
    """Of all windows of the texts: number of the text, start in it, start in all words, code of the chosen gram, its place; and the word codes."""
    codes, bounds = word_codes(texts)
    if len(codes) < window:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty, codes
    grams = spans(codes, gram)
    place = _first_minimum(grams, window - gram + 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    at = np.flatnonzero(owner[:len(place)] == owner[window - 1:])
    return owner[at], at - bounds[owner[at]], at, grams[place[at]], place[at], codes


def _slots(codes: np.ndarray, row: int, counters: int) -> np.ndarray:
    return ((codes >> np.uint64(32 * row)) & np.uint64(counters - 1)).astype(np.int64)


def sketch(docs: DataFrame, window: int, gram: int, counters: int) -> np.ndarray:
    """Bits (ROWS x counters / 8): set where the merged count is two or more."""

    def count(batches):
        held, size = [], 0

        def sparse():
            codes = np.concatenate(held)
            for row in range(ROWS):
                slot, n = np.unique(_slots(codes, row, counters), return_counts=True)
                cut = np.flatnonzero(np.diff(slot // BLOCK, prepend=-1))
                for a, b in zip(cut, [*cut[1:], len(slot)]):
                    low, many = (slot[a:b] % BLOCK).astype("<u2"), n[a:b] > 1
                    yield row, int(slot[a] // BLOCK), low[~many].tobytes(), low[many].tobytes()

        def batch_of(rows):
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["row", "block", "once", "more"])

        for batch in batches:
            texts = as_bytes(batch.column(0))
            for a, b in groups_of_texts(texts):
                _, _, _, codes, place, _ = _windows(texts[a:b], window, gram)
                if len(codes):
                    held.append(codes[np.diff(place, prepend=-1) != 0])
                    size += len(held[-1])
                if size >= 1_000_000:
                    yield batch_of(list(sparse()))
                    held, size = [], 0
        if size:
            yield batch_of(list(sparse()))

    def merge(batches):
        now, total = None, np.zeros(BLOCK, np.uint8)

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([np.packbits(total >= 2).tobytes()], pa.binary())], names=["row", "block", "bits"])

        for batch in batches:
            for row, block, once, more in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now != (row, block):
                    if now is not None and (total >= 2).any():
                        yield done()
                    now = row, block
                    total[:] = 0
                once = np.frombuffer(once, "<u2")
                total[once] = np.minimum(total[once] + 1, 2)
                total[np.frombuffer(more, "<u2")] = 2
        if now is not None and (total >= 2).any():
            yield done()

    parts = docs.select(F.col("text").cast("string")).mapInArrow(count, "row int, block int, once binary, more binary")
    merged = parts.repartition("row", "block").sortWithinPartitions("row", "block").mapInArrow(merge, "row int, block int, bits binary")
    bits = np.zeros((ROWS, counters // 8), np.uint8)
    for row, block, part in merged.collect():
        bits[row, block * BLOCK // 8:(block + 1) * BLOCK // 8] = np.frombuffer(part, np.uint8)
    return bits


def marked_windows(docs: DataFrame, window: int = 20, gram: int = 8, most_counters: int = MOST_COUNTERS) -> DataFrame:
    """(id, start) of every window whose words also start earlier (smaller id, or earlier in the same document)."""
    spark = docs.sparkSession
    gram = min(gram, window)
    rows = docs.select("id", F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    counters = BLOCK
    while counters < min(size // 4, most_counters):  # about eight counters to a chosen gram
        counters *= 2
    bits = spark.sparkContext.broadcast(sketch(docs, window, gram, counters))
    shards = max(16, size // 30 // SHARD_WINDOWS)

    def candidates(batches):
        held, size = [], 0

        def packed():
            low, high, ids, starts = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((starts, ids, high, low))
            low, high, ids, starts = low[order], high[order], ids[order], starts[order]
            again = np.zeros(len(low), bool)
            again[1:] = (low[1:] == low[:-1]) & (high[1:] == high[:-1]) & ((ids[1:] != ids[:-1]) | (starts[1:] != starts[:-1]))
            # within a group only the first is sent for comparison; the others are marked here already
            shard = np.where(again, -1, (low % np.uint64(shards)).astype(np.int64))
            order = np.argsort(shard, kind="stable")
            shard, low, high, ids, starts = shard[order], low[order], high[order], ids[order], starts[order]
            cut = np.flatnonzero(np.diff(shard, prepend=-2))
            out = []
            for a, b in zip(cut, [*cut[1:], len(shard)]):
                codes = np.stack((low[a:b], high[a:b]), axis=1).tobytes() if shard[a] >= 0 else b""
                # marked ones need no shard of their own: any will do
                to = int(shard[a]) if shard[a] >= 0 else int(low[a] % np.uint64(shards))
                out.append((to, codes, ids[a:b].tobytes(), starts[a:b].astype("<i4").tobytes()))
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["shard", "codes", "ids", "starts"])

        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), as_bytes(batch.column(1))
            for a, b in groups_of_texts(texts):
                owner, start, at, codes, _, words = _windows(texts[a:b], window, gram)
                if not len(codes):
                    continue
                repeated = np.ones(len(codes), bool)
                for row in range(ROWS):
                    slot = _slots(codes, row, counters)
                    repeated &= (bits.value[row, slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
                if not repeated.any():
                    continue
                owner, start, at = owner[repeated], start[repeated], at[repeated]
                held.append((spans(words, window, BASE)[at], spans(words, window, BASE2)[at], ids[a:b][owner], start))
                size += len(owner)
                if size >= FLUSH:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()

    def group(batches):
        now, held = None, []

        def repeats():
            low, high, ids, starts = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((starts, ids, high, low))
            low, high, ids, starts = low[order], high[order], ids[order], starts[order]
            first = np.ones(len(low), bool)
            first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            lead = np.flatnonzero(first)[np.cumsum(first) - 1]
            later = (ids != ids[lead]) | (starts != starts[lead])
            return ids[later], starts[later]

        def out(ids, starts):
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int32())], names=["id", "start"])

        for batch in batches:
            for shard, codes, ids, starts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ids, starts = np.frombuffer(ids, np.int64), np.frombuffer(starts, "<i4")
                if not codes:
                    yield out(ids, starts)
                    continue
                if shard != now and held:
                    yield out(*repeats())
                    held = []
                now = shard
                codes = np.frombuffer(codes, np.uint64).reshape(-1, 2)
                held.append((codes[:, 0], codes[:, 1], ids, starts))
        if held:
            yield out(*repeats())

    sent = rows.mapInArrow(candidates, "shard long, codes binary, ids binary, starts binary")
    return sent.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(group, "id long, start int")


def remove_repeats(docs: DataFrame, window: int = 20, scratch: Scratch | None = None, most_counters: int = MOST_COUNTERS) -> DataFrame:
    """One row per document: doc_id, text (the words that stay, joined by one space), n_words, n_removed.

    Words are runs of other than space, tab, line feed, vertical tab, form feed and return.  Null text has no words.
    A null doc_id counts as smallest.  Rows with the same doc_id are one document: a window is
    earlier only by its start, and what is marked in one is marked in all.
    """
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(SMALLEST)).alias("id"), F.col("text").cast("string").alias("text"))
    marks = marked_windows(rows, window, most_counters=most_counters).groupBy("id").agg(F.collect_set("start").alias("starts"))
    marked = rows.join(marks.hint("shuffle_hash"), "id", "left").select("doc_id", "text", "starts")

    def cut(batches):
        for batch in batches:
            texts, starts, out = as_bytes(batch.column(1)), batch.column(2), []
            for i, text in enumerate(texts):
                words = text.split()
                at = starts[i].values
                removed = 0
                if at is not None:
                    at = at.to_numpy()
                    covered = np.zeros(len(words) + 1, np.int64)
                    at = at[at + window <= len(words)]
                    covered[at] += 1
                    covered[at + window] -= 1
                    stays = np.cumsum(covered[:-1]) == 0
                    removed = len(words) - int(stays.sum())
                    words = [words[k] for k in np.flatnonzero(stays)]
                out.append((b" ".join(words).decode(), len(words) + removed, removed))
            text, n, removed = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64())], names=["doc_id", "text", "n_words", "n_removed"])

    return marked.mapInArrow(cut, "doc_id long, text string, n_words long, n_removed long")
