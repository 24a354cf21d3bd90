"""Language identification: multinomial naive Bayes over hashed character n-grams."""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .common import free_name, plain_columns
from .textcodes import stretches

BUCKETS = 1 << 14
ORDERS = (2, 3)
# Characters worked on at once; a longer text is scored in pieces whose counts are added.
PIECE = 1 << 18
LETTER = regex.compile(r"\p{L}")
_held: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _held:
        table = np.zeros(0x110000, bool)
        table[[i for i in range(0x110000) if chr(i).isalpha()]] = True
        _held.append(table)
    return _held[0]


def _grams(texts: list[str]):
    """For each order: the buckets of all n-grams and the number of the text each is from.

    Letters are lower-cased; every run of other characters is one space, also at both ends.
    """
    table = _letters()
    padded = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("\n".join([*padded, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    after = np.cumsum([len(t) + 1 for t in padded]) - 1
    letter = table[code]
    code = np.where(letter, code, np.uint32(32))
    code[after] = 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.concatenate(([0], after[:-1] + 1))] = True
    keep[after] = True
    owner = np.repeat(np.arange(len(texts)), np.diff(after, prepend=-1))[keep]
    code = code[keep].astype(np.uint64)
    for n in ORDERS:
        size = max(len(code) - n + 1, 0)
        h, whole = np.full(size, n, np.uint64), np.ones(size, bool)
        for k in range(n):
            part = code[k:k + size]
            h = h * np.uint64(0x9E3779B97F4A7C15) + part
            whole &= part != 0
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        yield (h >> np.uint64(50)).astype(np.int64)[whole], owner[:size][whole]


def _pieces(column):
    """Lists of (number of the text, piece) of about PIECE characters of an Arrow column; texts without letters are left out."""
    group, size = [], 0
    for a, b in stretches(column, PIECE):
        for i, t in enumerate(column.slice(a, b - a).to_pylist(), a):
            if t is None or not LETTER.search(t):
                continue
            for at in range(0, len(t), PIECE):
                group.append((i, t[at:at + PIECE]))
                size += len(group[-1][1])
                if size >= PIECE:
                    yield group
                    group, size = [], 0
    if group:
        yield group


def _count(batches):
    for batch in batches:
        of_row = batch.column(0).to_pylist()
        langs = sorted(set(of_row))
        number = {x: i for i, x in enumerate(langs)}
        place = np.array([number[x] for x in of_row], np.int64)
        total = np.zeros(len(langs) * BUCKETS, np.int64)
        for group in _pieces(batch.column(1)):
            of = place[[i for i, _ in group]]
            for bucket, owner in _grams([t for _, t in group]):
                total += np.bincount(of[owner] * BUCKETS + bucket, minlength=len(total))
        there = np.flatnonzero(total)
        names = pa.array(langs, pa.string()).take(pa.array(there // BUCKETS))
        yield pa.RecordBatch.from_arrays([names, pa.array(there % BUCKETS, pa.int32()), pa.array(total[there], pa.int64())], names=["lang", "bucket", "n"])


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that no model learns from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class LanguageModel:
    """Log probabilities (languages x buckets) and log priors; ``predict`` makes a column of a text column."""

    def __init__(self, langs: list[str], table: np.ndarray, prior: np.ndarray):
        self.langs, self.table, self.prior = langs, table, prior

    def score(self, texts: pa.Array) -> pa.StructArray:
        if not self.langs:
            return self._scored(np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts), bool))
        total, seen = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), bool)
        for group in _pieces(texts):
            of = np.array([i for i, _ in group])
            seen[of] = True
            for bucket, owner in _grams([t for _, t in group]):
                for k in range(len(self.langs)):
                    sums = np.bincount(owner, weights=self.table[k][bucket], minlength=len(of))
                    np.add.at(total[:, k], of, sums)
        total += self.prior
        total -= total.max(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        score = 1 / np.exp(total).sum(axis=1)
        return self._scored(best, score, seen)

    def _scored(self, best, score, seen) -> pa.StructArray:
        names = pa.array([*self.langs, "und"], pa.string()).take(pa.array(np.where(seen, best, len(self.langs))))
        return pa.StructArray.from_arrays([names, pa.array(np.where(seen, score, 0.0))], names=["lang_pred", "score"])

    def predict(self, text: Column, spark) -> Column:
        """Struct of lang_pred and score.  The model is as large as languages x buckets, whatever the corpus."""
        model = spark.sparkContext.broadcast(self)

        @F.arrow_udf("lang_pred string, score double")
        def predicted(texts: pa.Array) -> pa.Array:
            return model.value.score(texts)

        return predicted(text)


def fit(docs: DataFrame, learn: Column | None = None) -> LanguageModel:
    """Counts n-grams per language over all labelled documents that are not held out.

    Null lang or text teaches nothing.  Counts are summed per language and bucket in each batch,
    then by Spark; add-one smoothing; priors are the shares of the languages' n-grams on a
    logarithmic scale, so that they matter only for very short texts.
    """
    rows = docs.where(~held_out() if learn is None else learn).where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counted = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(counted["lang"]))
    table = np.zeros((len(langs), BUCKETS))
    table[counted["lang"].map({x: i for i, x in enumerate(langs)}).astype(int), counted["bucket"]] = counted["n"]
    sums = table.sum(axis=1, keepdims=True)
    prior = np.log(sums[:, 0] / sums.sum()) if len(langs) else np.zeros(0)
    return LanguageModel(langs, np.log((table + 1) / (sums + BUCKETS)), prior)


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (posterior probability).

    Null texts and texts without letters are ``und`` with score 0, as is every text when nothing
    could be learned.  A text that fits two languages equally gets the alphabetically first.
    """
    model = model or fit(docs)
    out = docs.select("doc_id", held_out().alias("held_out"), model.predict(F.col("text"), docs.sparkSession).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``docs`` without those whose language cannot be told (``und``); columns unchanged, whatever their names."""
    model, told = model or fit(docs), free_name(docs, "told")
    return docs.withColumn(told, model.predict(F.col("text"), docs.sparkSession)).where(F.col(told)["lang_pred"] != "und").select(*plain_columns(docs))
