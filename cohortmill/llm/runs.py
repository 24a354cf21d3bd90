"""Periodic runs of words, found with suffix trees and Lyndon roots.

A run is a maximal stretch of words with a smallest period q and at least ``least`` words and ``times`` periods.
Each long enough run has a Lyndon root: the longest Lyndon word that starts at one of its words, in the order of
the words or in the reverse order.  Ukkonen trees of the words and of their reversal, with constant-time lowest
common ancestors over Euler tours, give for any two places how far the words agree to the right and to the
left; every root is extended both ways by them, and the roots that reach the wanted length are runs.

Only stretches that can hold a run get trees: in a run of n >= max(least, times * q) words every window of up to
1 + n - 2 * q words recurs within it, q words further or before, so words that no recurring window of that size
covers are in no run.  Recurring windows are found by codes, whose chance
collisions could only keep a stretch too many; the trees work on the words themselves.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .textcodes import as_bytes, groups_of_texts, mix, spans, word_codes

RUNS = "array<struct<start: long, length: long, period: long>>"
# Entries of an Euler tour between two samples of the sparse table.
STEP = 16


class SuffixTree:
    """Ukkonen's tree of ``letters`` (numbers from 1; an end mark is added here)."""

    def __init__(self, letters: np.ndarray):
        self.n = len(letters)
        self.letters = np.append(letters, 0)
        self._build(self.letters.tolist(), int(letters.max(initial=0)) + 1)
        self._tour()

    def _build(self, s: list[int], width: int) -> None:
        """Edges are s[begin:end]; an end of ``last`` is open.  Leaves are made in the order of their suffixes."""
        last = len(s)
        begin, end, link, parent, leaves = [0], [0], [0], [0], []
        child: dict[int, int] = {}
        node = edge = length = left = 0
        for at, letter in enumerate(s):
            left += 1
            waiting = 0
            while left:
                if not length:
                    edge = at
                key = node * width + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    leaves.append(len(begin))
                    begin.append(at)
                    end.append(last)
                    link.append(0)
                    parent.append(node)
                    if waiting:
                        link[waiting] = node
                    waiting = node
                else:
                    start = begin[below]
                    size = min(end[below], at + 1) - start
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    if s[start + length] == letter:
                        length += 1
                        if waiting and node:
                            link[waiting] = node
                        break
                    inner = len(begin)
                    child[key] = inner
                    begin += (start, at)
                    end += (start + length, last)
                    link += (0, 0)
                    parent += (node, inner)
                    leaves.append(inner + 1)
                    child[inner * width + letter] = inner + 1
                    begin[below] = start + length
                    child[inner * width + s[start + length]] = below
                    parent[below] = inner
                    if waiting:
                        link[waiting] = inner
                    waiting = inner
                left -= 1
                if not node and length:
                    length -= 1
                    edge = at - left + 1
                elif node:
                    node = link[node]
        self.begin, self.parent, self.leaves = np.array(begin), np.array(parent), np.array(leaves)
        self.size = np.array(end) - self.begin

    def _preorder(self, first_letter: np.ndarray) -> np.ndarray:
        """Nodes in the order of a walk from the root, children by ``first_letter``."""
        inner = np.arange(1, len(self.begin))
        order = inner[np.lexsort((-first_letter[inner], self.parent[inner]))]
        at = np.searchsorted(self.parent[order], np.arange(len(self.begin) + 1)).tolist()
        below, out, open_ = order.tolist(), [], [0]
        while open_:
            node = open_.pop()
            out.append(node)
            if at[node + 1] > at[node]:
                open_ += below[at[node]:at[node + 1]]
        return np.array(out)

    def _tour(self) -> None:
        """Depths along an Euler tour: every node, and the node to which the walk climbs before the next one."""
        letter = self.letters[self.begin]
        order = self._preorder(letter)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        depth = np.zeros(len(order), np.int64)
        sizes, parents, depths = self.size[order].tolist(), place[self.parent[order]].tolist(), depth.tolist()
        for k in range(1, len(order)):
            depths[k] = depths[parents[k]] + sizes[k]
        depth = np.array(depths)
        tour = np.zeros(2 * len(order) + STEP, np.int32)
        tour[0:2 * len(order):2] = depth
        tour[1:2 * len(order) - 1:2] = depth[parents[1:]]
        self.at = 2 * place[self.leaves]
        blocks = tour[:len(tour) // STEP * STEP].reshape(-1, STEP)
        self.tour, self.before = tour, np.minimum.accumulate(blocks, axis=1).ravel()
        self.after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [blocks.min(axis=1)]
        while 2 << len(self.table) - 1 <= len(blocks):
            held, half = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(held[:-half], held[half:]))

    def ranks(self, reverse: bool) -> np.ndarray:
        """Place of every suffix in the order of the letters, or of reversed letters; the end comes first in both."""
        letter = self.letters[self.begin]
        order = self._preorder(np.where(letter, letter.max(initial=0) + 1 - letter, 0) if reverse else letter)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return place[self.leaves][:self.n]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many letters the suffixes from i and from j have in common (i <> j; n is the empty suffix)."""
        low, high = np.minimum(self.at[i], self.at[j]), np.maximum(self.at[i], self.at[j])
        a, b = low // STEP, high // STEP
        out = np.minimum(self.after[low], self.before[high])
        same = np.flatnonzero(a == b)
        if len(same):
            low, high = low[same], high[same]
            least = self.tour[low]
            for k in range(1, STEP):
                least = np.minimum(least, self.tour[np.minimum(low + k, high)])
            out[same] = least
        wide = np.flatnonzero(b - a > 1)
        if len(wide):
            first, n = a[wide] + 1, b[wide] - a[wide] - 1
            level = np.frexp(n)[1] - 1
            least = out[wide]
            for k in np.unique(level).tolist():
                of = level == k
                f, past = first[of], first[of] + n[of] - (1 << k)
                least[of] = np.minimum(least[of], np.minimum(self.table[k][f], self.table[k][past]))
            out[wide] = least
        return out.astype(np.int64)


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every place the next one of smaller rank, or the end."""
    rank, open_ = rank.tolist(), []
    out = [len(rank)] * len(rank)
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return np.array(out, np.int64)


def runs_of(letters: np.ndarray, least: int, times: int) -> np.ndarray:
    """(start, length, period) of all runs of ``letters`` (numbers from 1), by start, then period."""
    n = len(letters)
    if n < least:
        return np.empty((0, 3), np.int64)
    tree, roots = SuffixTree(letters), []
    for reverse in (False, True):
        end = _next_smaller(tree.ranks(reverse))
        roots.append(np.stack((np.arange(n), end - np.arange(n)), axis=1))
    roots = np.unique(np.concatenate(roots), axis=0)
    start, period = roots[:, 0], roots[:, 1]
    right = tree.common(start, start + period)
    tree = SuffixTree(letters[::-1])
    left = tree.common(n - start, n - start - period)
    length = left + period + right
    found = np.stack((start - left, length, period), axis=1)[length >= np.maximum(least, times * period)]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _stretches(texts: list[bytes], least: int, times: int):
    """Ranges of words (number of the text, from, to) that recurring windows cover without a gap."""
    codes, bounds = word_codes(texts)
    window = min(1 + n - 2 * (n // times) for n in range(least, least + times))
    if len(codes) < window:
        return
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    at = np.flatnonzero(owner[:len(codes) - window + 1] == owner[window - 1:])
    of_window = mix(spans(codes, window)[at] + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(of_window, kind="stable")
    same = of_window[order][1:] == of_window[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + window, -1)
    covered = np.cumsum(cover[:-1]) > 0
    new_text = np.zeros(len(codes), bool)
    new_text[bounds[:-1][bounds[:-1] < len(codes)]] = True
    edge = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    starts = np.flatnonzero((edge[:-1] == 1) | (covered & new_text))
    ends = np.flatnonzero((edge[1:] == -1) | (covered & np.append(new_text[1:], True))) + 1
    long = ends - starts >= least
    for a, b in zip(starts[long].tolist(), ends[long].tolist()):
        k = int(owner[a])
        yield k, a - int(bounds[k]), b - int(bounds[k])


def _find(least: int, times: int):
    def run(batches):
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for a, b in groups_of_texts(texts):
                part, held, words = texts[a:b], -1, []
                found: list[list[np.ndarray]] = [[np.empty((0, 3), np.int64)] for _ in part]
                for k, start, end in _stretches(part, least, times):
                    if k != held:
                        held, words = k, part[k].split()
                    number: dict[bytes, int] = {}
                    letters = np.array([number.setdefault(w, len(number) + 1) for w in words[start:end]], np.int64)
                    found[k].append(runs_of(letters, least, times) + np.array([start, 0, 0]))
                lists, stays = [np.concatenate(f) for f in found], []
                for text, got in zip(part, lists):
                    words = text.split()
                    if len(got):
                        cover = np.zeros(len(words) + 1, np.int64)
                        np.add.at(cover, got[:, 0] + got[:, 2], 1)
                        np.add.at(cover, got[:, 0] + got[:, 1], -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
                    stays.append(b" ".join(words).decode())
                all_ = np.concatenate(lists)
                runs = pa.StructArray.from_arrays([pa.array(all_[:, c]) for c in range(3)], names=["start", "length", "period"])
                places = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in lists]))), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(places, runs), pa.array(stays, pa.string())],
                                                 names=["doc_id", "runs", "text"])
    return run


def find_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (start, length, period; by start, then period), text.

    ``text`` holds the words that stay, joined by one space: a word goes if any run contains it after that run's
    first period.  Words are runs of other than space, tab, line feed, vertical tab, form feed and return, numbered from 0.
    Null, empty and blank texts have no runs and an empty text.  A text is worked on whole, whatever its length,
    in memory linear in its repeated stretches.  Repeated rows and rows without an id are rows of their own;
    runs of equal start go by period; other columns are not read, so their names do not matter.
    """
    if times < 2 or least < times:
        raise ValueError("runs need at least two periods, and as many words as periods")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_find(least, times), f"doc_id long, runs {RUNS}, text string")


def longest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; of equal ones the first in ``runs``; null if there is none."""
    better = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.when(F.size(runs) > 0, F.aggregate(runs, runs[0], lambda best, r: F.when(better(best, r), r).otherwise(best)))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where a tenth of the texts, chosen by crc32 of doc_id, end in a repeated stretch.

    With h = crc32(doc_id as text), h % 10 = 0 and g = h / 10, each of the n words from a = g % n on becomes
    word a + (i - a) % p, where p = 1 + (n - a) / (3 + g % 8), all divisions rounding down.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    placed = chosen.select("doc_id", "text", "words", g.alias("g"), n.alias("n"), (g % F.when(n > 0, n)).alias("a"))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p")
    placed = placed.select("doc_id", "text", "words", "n", "a", period)
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", at(i).cast("int"))), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))
