"""Best-fit decreasing packing of token sequences.

The packing of a multiset of lengths depends only on how many pieces have each length, so the
driver packs the histogram (one count per length and slice), never the pieces: pieces of
one length go, in order of their rank, into runs of equal bins.  The runs are then applied to the pieces where
they lie.
"""

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import SMALLEST, Scratch
from .textcodes import STRETCH, as_bytes, cuts, edges, hash_spans, stretches

END_ID = 1
CACHED_WORDS = 3_000_000
SEPARATOR = "★"
SLICES = 64
STOP, LETTER = np.zeros(256, bool), np.zeros(256, bool)
STOP[[*b".,"]] = True
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


class WordIds:
    """Token ids of texts, word by word, each distinct word encoded once per worker.

    For tokenizers whose pre-tokenization drops white space and separates letters from signs, so
    that no token spans white space, or the dot or comma that ends a word of ASCII letters; the
    ids of a text are those of such parts in order.  Texts of ASCII only are lower-cased before, as
    the tokenizer does.  The cache holds sorted 64-bit codes of at most CACHED_WORDS words and their ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        mark = self._encode([SEPARATOR])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.codes, self.at, self.ids = np.empty(0, np.uint64), np.zeros((0, 2), np.int64), np.empty(0, "<u4")

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        joined = [i for i, t in enumerate(texts) if self.mark is not None and SEPARATOR not in t]
        alone = sorted(set(range(len(texts))).difference(joined))
        for i, ids in zip(alone, self._encode([texts[i] for i in alone])):
            out[i] = np.array(ids, "<u4")
        groups = [joined[a:a + 256] for a in range(0, len(joined), 256)]
        for group, ids in zip(groups, self._encode([f" {SEPARATOR} ".join(texts[i] for i in g) for g in groups])):
            ids = np.array(ids, "<u4")
            cut = np.flatnonzero(ids == self.mark).tolist()
            for i, a, b in zip(group, [0, *(c + 1 for c in cut)], [*cut, len(ids)]):
                out[i] = ids[a:b]
        return out

    def _find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
        return place, (self.codes[place] == codes if len(self.codes) else np.zeros(len(codes), bool))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts of a piece's size together, and where the ids of each text end."""
        data = b"\n".join([*(t.lower() if t.isascii() and b"<|" not in t else t for t in texts), b""])
        raw = np.frombuffer(data, np.uint8)
        starts, ends = edges(raw)
        split = ends[(STOP[raw[ends - 1]]) & LETTER[raw[np.maximum(ends - 2, 0)]] & (ends - starts > 1)] - 1
        starts, ends = np.sort(np.concatenate((starts, split))), np.sort(np.concatenate((ends, split)))
        codes, first, which = np.unique(hash_spans(raw, starts, ends), return_index=True, return_inverse=True)
        place, known = self._find(codes)
        if not known.all():
            if len(self.codes) > CACHED_WORDS:
                self._forget()
                known[:] = False
            new = first[~known]
            ids = self._words([data[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            lengths = np.array([len(i) for i in ids], np.int64)
            at = len(self.ids) + np.cumsum(lengths) - lengths
            self.ids = np.concatenate((self.ids, *ids))
            self.codes = np.concatenate((self.codes, codes[~known]))
            self.at = np.concatenate((self.at, np.stack((at, lengths), axis=1)))
            order = np.argsort(self.codes, kind="stable")
            self.codes, self.at = self.codes[order], self.at[order]
            place, _ = self._find(codes)
        at, lengths = self.at[place, 0][which], self.at[place, 1][which]
        total = np.cumsum(lengths)
        ids = self.ids[np.repeat(at - total + lengths, lengths) + np.arange(total[-1] if len(total) else 0)]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        words = np.searchsorted(starts, text_ends)
        return ids, np.concatenate(([0], total))[words]


_encoders: dict[str, WordIds] = {}


def pieces(docs: DataFrame, tokenizer: str, limit: int = 4096, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (and ids): a document's ids and END_ID, cut at ``limit``."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    def run(batches):
        encoder = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, WordIds(tokenizer))
        for batch in batches:
            for a, b in stretches(batch.column(1)):
                docs, texts, rows = batch.column(0).slice(a, b - a).to_pylist(), as_bytes(batch.column(1).slice(a, b - a)), []
                if len(texts) == 1 and len(texts[0]) > STRETCH:
                    whole = np.concatenate([encoder([part])[0] for part in cuts(texts[0], STRETCH)])
                    ids, ends = whole, [len(whole)]
                else:
                    ids, ends = encoder(texts)
                at = 0
                for doc, stop in zip(docs, ends):
                    own = np.append(ids[at:stop], END_ID).astype("<u4")
                    at = stop
                    for k, s in enumerate(range(0, len(own), limit)):
                        part = own[s:s + limit]
                        rows.append((doc, k, s, len(part), zlib.crc32(part.tobytes()), *([part.view("<i4")] if with_ids else [])))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names[:5 + with_ids])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


class OpenBins:
    """Open bins by remaining capacity, with a segment tree that finds the smallest sufficient one."""

    def __init__(self, limit: int):
        self.leaves = 1 << limit.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]

    def _set(self, capacity: int) -> None:
        at = capacity + self.leaves
        self.tree[at] = bool(self.runs[capacity])
        while at > 1:
            at //= 2
            self.tree[at] = self.tree[2 * at] | self.tree[2 * at + 1]

    def add(self, capacity: int, first: int, n: int) -> None:
        if capacity and n:
            self.runs[capacity].append((first, n))
            self._set(capacity)

    def tightest(self, need: int) -> tuple[int, int, int] | None:
        """Takes out a run of bins: (capacity, first bin, number of bins)."""
        at = need + self.leaves
        while not self.tree[at]:
            while at & 1:  # a right child: go up until there is something to the right
                at //= 2
                if at <= 1:
                    return None
            if at == 0:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.tree[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        first, n = self.runs[capacity].pop()
        self._set(capacity)
        return capacity, first, n


def plan(counts: dict[int, int], limit: int) -> pd.DataFrame:
    """Best-fit decreasing over ``counts`` (pieces per length).

    Rows (length, rank, bin, each, offset): from this rank on, pieces of the length go ``each`` to a
    bin, the first into ``bin`` at ``offset``.  Pieces of equal length that follow each other fill
    the same tightest bin as long as they fit, so whole runs of equal bins are filled at once.
    """
    bins, opened, rows = OpenBins(limit), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity, first, n = bins.tightest(length) or (limit, opened, None)
            each = capacity // length
            used = -(-left // each) if n is None else min(n, -(-left // each))
            if n is None:
                opened += used
            placed = min(left, used * each)
            rows.append((length, rank, first, each, limit - capacity))
            full, some = divmod(placed, each)
            bins.add(capacity - each * length, first, full)
            if some:
                bins.add(capacity - some * length, first + full, 1)
            if n is not None:
                bins.add(capacity, first + used, n - used)
            rank, left = rank + placed, left - placed
    return pd.DataFrame(rows, columns=["length", "rank", "bin", "each", "offset"])


def pack(docs: DataFrame, tokenizer: str, limit: int = 4096, scratch: Scratch | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null text is empty and gives the end id alone.  Only documents longer than ``limit`` are cut.
    Repeated rows and ids are packed each.  The driver sees at most ``limit`` x SLICES counts.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    held = scratch.keep(pieces(docs, tokenizer, limit, with_ids).withColumn(
        "slice", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(SMALLEST)), "piece"), F.lit(SLICES)).cast("int")))
    counts = held.groupBy("length", "slice").count().toPandas().sort_values(["length", "slice"])
    base = {(a, b): c for a, b, c in zip(counts["length"], counts["slice"], counts.groupby("length")["count"].cumsum() - counts["count"])}
    made = plan(counts.groupby("length")["count"].sum().to_dict(), limit)
    key = made["length"].to_numpy(np.int64) << 48 | made["rank"].to_numpy(np.int64)
    order = np.argsort(key)
    bases = np.zeros((limit + 1, SLICES), np.int64)
    for (a, b), c in base.items():
        bases[a, b] = c
    shared = spark.sparkContext.broadcast((key[order], *[made[c].to_numpy(np.int64)[order] for c in ("rank", "bin", "each", "offset")], bases))
    ranked = held.withColumn("nth", F.row_number().over(Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")))
    out = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches):
        keys, first, bin_, each, offset, bases = shared.value
        for batch in batches:
            length, slice_, nth = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "slice", "nth"))
            rank = bases[length, slice_] + nth - 1
            at = np.searchsorted(keys, length << 48 | rank, "right") - 1
            into, within = np.divmod(rank - first[at], each[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in out), pa.array(bin_[at] + into), pa.array(offset[at] + within * length), *([batch.column("ids")] if with_ids else [])],
                names=[*out, "sequence_id", "offset", *(["ids"] if with_ids else [])])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + (", ids array<int>" if with_ids else ""))
