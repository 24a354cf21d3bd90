"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated.

Every text becomes a few statistics of its bytes and words.  Random Fourier features of the standardised
statistics approximate a Gaussian kernel; their normal equations are summed per partition, then by Spark, and
solved once.  An isotonic step function, fitted on rows that the regression did not see, turns its output into
probabilities.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch
from .language import held_out
from .textcodes import LOWER, SPACE, as_bytes, edges, hash_spans, spans, stretches

STATISTICS = (
    "log_words log_distinct log_bytes word_length word_spread letters capitals all_capitals capital_starts digits marks signs controls beyond_ascii "
    "spaces line_ends words_ending_in_sign words_of_signs sentence_length distinct_share most_frequent_share same_as_before repeated_fives repeated_lines long_words"
).split()
FEATURES, SEED = 512, 7
# Kernel width in standard deviations per root of the number of statistics; ridge weight per learned row.
WIDTH, RIDGE = 1.0, 1e-4
# Standardised statistics are held within this many deviations.
REACH = 8.0
# Steps of the regression's output in which calibration counts, from -1 to 2.
STEPS = 4096
PARTS = 32

LETTER, CAPITAL, DIGIT = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
CAPITAL[0x41:0x5B] = True
LETTER[0x61:0x7B] = LETTER[0x80:] = True
LETTER |= CAPITAL
DIGIT[0x30:0x3A] = True
# Marks of ordinary sentences; all other printable signs of ASCII count as signs.
MARK = np.zeros(256, bool)
MARK[[*b".,;:!?'\"()-"]] = True
SIGN = np.zeros(256, bool)
SIGN[0x21:0x7F] = True
SIGN &= ~(LETTER | DIGIT | MARK)
STOP = np.zeros(256, bool)
STOP[[*b".!?"]] = True


def _kinds(raw: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """How many bytes of a kind each text has."""
    total = np.concatenate(([0], np.cumsum(kind[raw])))
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _repeats(owner: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, how many different codes it has and how often its most frequent one occurs."""
    order = np.lexsort((codes, owner))
    own, code = owner[order], codes[order]
    first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (code[1:] != code[:-1])))) if len(own) else np.empty(0, np.int64)
    often, most = np.diff(np.append(first, len(own))), np.zeros(n)
    np.maximum.at(most, own[first], often)
    return np.bincount(own[first], minlength=n).astype(float), most


def statistics(texts: list[bytes]) -> np.ndarray:
    """STATISTICS of each text; all are 0 for an empty one."""
    n = len(texts)
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate(([0], np.cumsum(size + 1)))
    starts, ends = edges(raw)
    owner = np.searchsorted(bounds, starts, "right") - 1
    words = np.bincount(owner, minlength=n).astype(float)
    per = lambda which: np.bincount(owner[which], minlength=n)
    some_bytes, some_words = np.maximum(size, 1), np.maximum(words, 1)
    share = lambda kind: _kinds(raw, bounds, kind) / some_bytes
    width = (ends - starts).astype(float)
    mean = np.bincount(owner, width, n) / some_words
    spread = np.sqrt(np.bincount(owner, (width - mean[owner]) ** 2, n) / some_words)
    capitals, signs, letters = (np.concatenate(([0], np.cumsum(k[raw]))) for k in (CAPITAL, SIGN, LETTER))
    inside = lambda total: total[ends] - total[starts]
    codes = hash_spans(LOWER[raw], starts, ends)
    distinct, most = _repeats(owner, codes, n)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    five = spans(codes, 5)
    whole = owner[:len(five)] == owner[4:] if len(five) else np.empty(0, bool)
    fives = np.bincount(owner[:len(five)][whole], minlength=n)
    different_fives, _ = _repeats(owner[:len(five)][whole], five[whole], n)
    at = np.flatnonzero(raw == 0x0A)
    line_start = np.concatenate(([0], at[:-1] + 1)) if len(at) else at
    full = at > line_start
    of_line = np.searchsorted(bounds, line_start[full], "right") - 1
    lines = np.bincount(of_line, minlength=n)
    different_lines, _ = _repeats(of_line, hash_spans(raw, line_start[full], at[full]), n)
    sentences = per(STOP[raw[ends - 1]]) if len(ends) else np.zeros(n)
    out = [
        np.log1p(words), np.log1p(distinct), np.log1p(size), mean, spread, share(LETTER), share(CAPITAL),
        per((inside(capitals) == inside(letters)) & (inside(letters) > 1)) / some_words, per(CAPITAL[raw[starts]]) / some_words,
        share(DIGIT), share(MARK), share(SIGN), share(np.arange(256) < 0x20) - 1 / some_bytes * (size > 0), share(np.arange(256) >= 0x80),
        share(SPACE) - 1 / some_bytes * (size > 0), np.maximum(lines - 1, 0) / some_words, per(SIGN[raw[ends - 1]]) / some_words, per(inside(letters) == 0) / some_words,
        np.log1p(words / np.maximum(sentences, 1)), distinct / some_words, most / some_words, per(same) / some_words,
        1 - different_fives / np.maximum(fives, 1) * (fives > 0) - (fives == 0), 1 - different_lines / np.maximum(lines, 1) * (lines > 0) - (lines == 0),
        per(width > 24) / some_words,
    ]
    out = np.stack(out, axis=1)
    out[size == 0] = 0
    return out


def _statistics(texts: pa.Array) -> pa.Array:
    parts = [statistics(as_bytes(texts.slice(a, b - a))) for a, b in stretches(texts)]
    values = np.concatenate(parts) if parts else np.empty((0, len(STATISTICS)))
    places = pa.array(np.arange(0, values.size + 1, len(STATISTICS)), pa.int32())
    return pa.ListArray.from_arrays(places, pa.array(values.ravel()))


class QualityModel:
    """Standardising constants, kernel frequencies, ridge weights and calibration steps."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, width: float, features: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.deviation = mean, deviation
        self.frequency = rng.standard_normal((len(mean), features)) / (width * np.sqrt(len(mean)))
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.edges, self.levels = np.zeros(1), np.full(1, 0.5)

    def features(self, values: np.ndarray) -> np.ndarray:
        """A one and the random Fourier features of rows of statistics."""
        held = np.clip((values - self.mean) / self.deviation, -REACH, REACH)
        waves = np.cos(held @ self.frequency + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate((np.ones((len(values), 1)), waves), axis=1)

    def output(self, values: np.ndarray) -> np.ndarray:
        return np.concatenate([np.empty(0), *(self.features(values[a:a + 4096]) @ self.weights for a in range(0, len(values), 4096))])

    def score(self, values: np.ndarray) -> np.ndarray:
        return np.interp(self.output(values), self.edges, self.levels)


def isotonic(x: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and mean levels of the blocks, for ``total`` ones of ``weight`` rows at rising ``x``."""
    blocks: list[list[float]] = []
    for at, t, w in zip(x, total, weight):
        blocks.append([at * w, t, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    held = np.array(blocks)
    return held[:, 0] / held[:, 2], held[:, 1] / held[:, 2]


def _vectors(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(STATISTICS))


def normal_equations(rows: DataFrame, model: QualityModel) -> np.ndarray:
    """Sums of products of the features and the label of ``rows`` (statistics, label), square and symmetric.

    Every partition adds up its own; the sums are dealt by parts of their rows and added again, so
    that no task holds more than two matrices.
    """
    size = len(model.weights) + 1
    per = -(-size // PARTS)

    def add(batches):
        total = np.zeros((size, size))
        for batch in batches:
            values, label = _vectors(batch.column(0)), batch.column(1).to_numpy()
            for a in range(0, len(values), 4096):
                x = np.concatenate((model.features(values[a:a + 4096]), label[a:a + 4096, None]), axis=1)
                total += x.T @ x
        if total[0, 0]:
            parts = [total[a:a + per].tobytes() for a in range(0, size, per)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["part", "sums"])

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums = np.frombuffer(sums.as_buffer())
                total[part] = total[part] + sums if part in total else sums
        kinds = [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(kinds, names=["part", "sums"])

    kind = "part int, sums binary"
    out = np.zeros((size, size))
    for part, sums in rows.mapInArrow(add, kind).repartition(PARTS, "part").mapInArrow(merge, kind).collect():
        out[part * per:(part + 1) * per] = np.frombuffer(sums).reshape(-1, size)
    return out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, part (0 to 3 by a hash of the text, so that equal texts stay together) and statistics of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", held_out().alias("held_out"), F.pmod(F.xxhash64(text), F.lit(4)).cast("int").alias("part"), _column(text).alias("statistics"))


def fit(rows: DataFrame, labels: DataFrame, learn: Column | None = None, features: int = FEATURES, width: float = WIDTH, ridge: float = RIDGE,
        seed: int = SEED, scratch: Scratch | None = None) -> QualityModel:
    """Learns ``labels.quality`` (0 or 1; other values teach nothing) of ``rows`` (stored ``measured``) that are not held out.

    All such rows are used, without a sample: three quarters by the normal equations, those of part 0 by the
    calibration.  A document with several labels teaches each of them.  Only statistics travel to the labels, never
    texts.  Driver and tasks hold matrices of ``features`` squared and STEPS counts, whatever the
    number of rows.  Without rows every score is 0.5; with one label only, its value.
    """
    scratch = scratch or Scratch(rows.sparkSession)
    label = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("double").alias("label"))
    rows = scratch.keep(rows.where(~F.col("held_out") if learn is None else learn).join(label, "doc_id").select("statistics", "label", "part"))
    each = range(len(STATISTICS))
    sums = rows.agg(F.count("*"), *[F.avg(F.col("statistics")[k]) for k in each], *[F.stddev_pop(F.col("statistics")[k]) for k in each]).head()
    n, mean, deviation = sums[0], np.array(sums[1:1 + len(each)], float), np.array(sums[1 + len(each):], float)
    if not n:
        model = QualityModel(np.zeros(len(each)), np.ones(len(each)), width, features, seed)
        scratch.drop(rows)
        return model
    model = QualityModel(mean, np.where(deviation > 1e-9, deviation, 1.0), width, features, seed)
    learned = normal_equations(rows.where("part <> 0").select("statistics", "label"), model)
    weight = np.full(features + 1, ridge * max(learned[0, 0], 1.0))
    weight[0] = 1e-9
    model.weights = np.linalg.solve(learned[:-1, :-1] + np.diag(weight), learned[:-1, -1])
    held = rows.where("part = 0")
    counts = held.select(F.floor((F.least(F.greatest(_column_of_output(F.col("statistics"), model), F.lit(-1.0)), F.lit(2.0)) + 1) * (STEPS / 3)).alias("step"), "label")
    found = counts.groupBy("step").agg(F.sum("label").alias("ones"), F.count("*").alias("n")).orderBy("step").toPandas()
    if len(found):
        model.edges, model.levels = isotonic((found["step"].to_numpy(float) + 0.5) * 3 / STEPS - 1, found["ones"].to_numpy(float), found["n"].to_numpy(float))
    else:  # nothing to calibrate on: the output itself, held to 0 and 1
        model.edges, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    scratch.drop(rows)
    return model


def _column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def values(texts: pa.Array) -> pa.Array:
        return _statistics(texts)

    return values(text)


def _column_of_output(values: Column, model: QualityModel) -> Column:
    @F.arrow_udf("double")
    def output(column: pa.Array) -> pa.Array:
        return pa.array(model.output(_vectors(column)))

    return output(values)


def predict(rows: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """One row per row of ``measured``: doc_id, held_out, score, predicted (1 if score >= threshold)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(_vectors(column)))

    return rows.select("doc_id", "held_out", scored(F.col("statistics")).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, scratch: Scratch | None = None, **options) -> DataFrame:
    """Scores of all documents by a model learned from those that are not held out.

    Null text counts as empty; empty and blank texts get the score of their statistics.  Whole texts
    are read, whatever their length, and once.  Rows without an id are not held out and teach nothing; repeated rows
    teach and are scored each; equal texts get equal scores.  Other columns are not read, so their names do not matter.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.keep(measured(docs))
    return predict(rows, fit(rows, labels, scratch=scratch, **options), threshold)
