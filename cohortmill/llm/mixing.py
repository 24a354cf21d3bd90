"""Mixing to target weights with soft membership, in DataFrame functions only.

A classifier learned from the labelled table gives every document posteriors over domains.  Non-negative rates are then
fitted so that the expected tokens of each domain meet their targets: projected gradient descent on the
weighted squares of what is missing.  A rate depends only on the document and on the residuals of all
steps, a few numbers each, so that every step is one aggregation over documents.
"""

import logging

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, plain_columns, text_or_empty

LOG = logging.getLogger(__name__)

DOMAINS = ("good", "poor", "toxic")
FEATURES = 1 << 12


def domain(quality: Column, toxic: Column) -> Column:
    """Number of the domain of a labelled document."""
    return F.when(toxic == 1, 2).when(quality == 1, 0).when(quality == 0, 1)


def _features(docs: DataFrame) -> DataFrame:
    """Adds words and which hashed words occur."""
    words = RegexTokenizer(inputCol="__text", outputCol="__words", pattern=r"\s+").transform(docs.withColumn("__text", text_or_empty()))
    return HashingTF(inputCol="__words", outputCol="__counts", numFeatures=FEATURES, binary=True).transform(words)


def fit_domains(docs: DataFrame, labels: DataFrame, label_rows: int = 4_000):
    """Logistic regression over hashed words, learned from at most ``label_rows`` labelled documents.

    The sample takes the labels with the smallest hash of doc_id.  Rows with null labels or ids teach nothing.
    None if fewer than two domains are labelled: posteriors are then equal shares.
    """
    known = labels.select("doc_id", domain(F.col("quality"), F.col("toxic")).cast("double").alias("__domain")).dropna()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "__domain").limit(label_rows)
    rows = _features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")).select("__domain", "__counts").cache()
    several = len(rows.select("__domain").distinct().limit(2).collect()) == 2
    model = LogisticRegression(featuresCol="__counts", labelCol="__domain", probabilityCol="__p", rawPredictionCol="__raw", predictionCol="__best",
                               family="multinomial", maxIter=15, regParam=0.01).fit(rows) if several else None
    rows.unpersist()
    return model


def posteriors(docs: DataFrame, model) -> DataFrame:
    """Adds tokens (words) and p (array of DOMAINS posteriors, adding up to one)."""
    made = _features(docs)
    if model is None:
        p = F.array(*[F.lit(1 / len(DOMAINS))] * len(DOMAINS))
    else:
        made = model.transform(made)
        raw = vector_to_array("__p")
        p = F.array(*[F.coalesce(F.get(raw, F.lit(k)), F.lit(0.0)) for k in range(len(DOMAINS))])
    return made.withColumn("tokens", F.size("__words").cast("long")).withColumn("p", p).drop("__text", "__words", "__counts", "__raw", "__p", "__best")


def _state(p: Column, steps: list[list[float]]) -> Column:
    """x, the rate after ``steps``, and y, where the next gradient is taken: x carried on along its last move."""
    begin = F.struct(F.lit(1.0).alias("x"), F.lit(1.0).alias("y"))
    if not steps:
        return begin
    taken = F.array(*[F.array(*[F.lit(float(v)) for v in (*s, k / (k + 3))]) for k, s in enumerate(steps)])

    def move(at, s):
        x = F.greatest(F.lit(0.0), at["y"] - sum((F.get(p, F.lit(k)) * F.get(s, F.lit(k)) for k in range(len(DOMAINS))), F.lit(0.0)))
        return F.struct(x.alias("x"), (x + F.get(s, F.lit(len(DOMAINS))) * (x - at["x"])).alias("y"))

    return F.aggregate(taken, begin, move)


def rate(p: Column, steps: list[list[float]]) -> Column:
    """The rate after ``steps``: from one, along each step's direction, never below zero."""
    return _state(p, steps)["x"]


def _inverse(rows: list[list[float]], ridge: float) -> list[list[float]]:
    """Inverse of a small positive matrix, by elimination."""
    k = len(rows)
    m = [[rows[i][j] + (ridge if i == j else 0.0) for j in range(k)] + [float(i == j) for j in range(k)] for i in range(k)]
    for c in range(k):
        top = max(range(c, k), key=lambda r: abs(m[r][c]))
        m[c], m[top] = m[top], m[c]
        m[c] = [x / m[c][c] for x in m[c]]
        for r in range(k):
            if r != c:
                m[r] = [x - m[r][c] * y for x, y in zip(m[r], m[c])]
    return [r[k:] for r in m]


def fit_rates(held: DataFrame, targets: dict[str, float], budget: float = 1.0, most_steps: int = 60, tolerance: float = 1e-4) -> tuple[list[list[float]], list[float]]:
    """Steps of the descent for ``held`` (tokens, p), and the expected share of ``budget`` that each domain is left with.

    ``targets`` are weights of DOMAINS; the expected tokens of a domain are to be its share of
    ``budget`` times all tokens.  The squares are weighted by the inverse of the domains' second
    moments, under which a step of length one is safe.  A domain without any token cannot be met.
    """
    k = range(len(DOMAINS))
    whole = sum(targets.get(d, 0.0) for d in DOMAINS)
    moment = held.agg(F.sum("tokens").alias("t"), *[F.sum(F.col("tokens") * F.get("p", F.lit(i)) * F.get("p", F.lit(j))).alias(f"m{i}{j}") for i in k for j in k]).head()
    if not moment["t"] or not whole:
        return [], [0.0] * len(DOMAINS)
    total = float(moment["t"])
    goal = [budget * targets.get(d, 0.0) / whole for d in DOMAINS]
    weight = _inverse([[moment[f"m{i}{j}"] / total for j in k] for i in k], 1e-6)
    steps: list[list[float]] = []
    while True:
        at = held.select("tokens", "p", _state(F.col("p"), steps).alias("at"))
        sums = at.agg(*[F.sum(F.col(f"at.{v}") * F.col("tokens") * F.get("p", F.lit(i))).alias(f"{v}{i}") for v in "xy" for i in k]).head()
        shares = [sums[f"x{i}"] / total for i in k]
        gap = max(abs(s - g) for s, g in zip(shares, goal))
        if gap > tolerance * budget and len(steps) == most_steps:
            LOG.warning("targets missed after %d steps: reached %s of %s", most_steps, shares, goal)
        if gap <= tolerance * budget or len(steps) == most_steps:
            return steps, shares
        missing = [sums[f"y{i}"] / total - goal[i] for i in k]
        steps.append([round(sum(weight[i][j] * missing[j] for j in k), 9) for i in k])


def _mark(doc_id: Column, text: Column) -> Column:
    """What the rounding of a row goes by: its id, or the hash of its text where it has none."""
    return F.coalesce(doc_id.cast("long"), F.xxhash64(text))


def _copies(rate_: Column, mark: Column) -> Column:
    """A rate as a whole number of copies: rounded up with the probability of its fraction, by a hash of the mark."""
    return (F.floor(rate_) + (F.pmod(F.xxhash64(mark, F.lit("copies")), F.lit(1 << 20)) / float(1 << 20) < rate_ - F.floor(rate_)).cast("long")).cast("long")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float = 1.0, label_rows: int = 4_000, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, tokens, p_good, p_poor, p_toxic, rate, copies.

    Null and empty texts have no tokens; their rate follows from the posteriors of an empty text and changes no total.
    Repeated rows count each and are rounded alike.  Texts are read whole; other columns are not read.
    Shares that miss a target by more than the tolerance are reported as a warning.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    made = posteriors(docs.select("doc_id", "text"), fit_domains(docs, labels, label_rows))
    held = scratch.keep(made.select("doc_id", _mark(F.col("doc_id"), F.col("text")).alias("mark"), "tokens", "p"))
    steps, _ = fit_rates(held, targets, budget)
    return held.withColumn("rate", rate(F.col("p"), steps)).select(
        "doc_id", "tokens", *[F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", _copies(F.col("rate"), F.col("mark")).alias("copies"))


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float = 1.0, label_rows: int = 4_000, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with every row as often as its rate says, columns unchanged, whatever their names."""
    scratch = scratch or Scratch(docs.sparkSession)
    model = fit_domains(docs, labels, label_rows)
    whole = posteriors(docs.select(F.struct(*plain_columns(docs)).alias("__row"), "text"), model)
    held = scratch.keep(whole.select("tokens", "p"))
    steps, _ = fit_rates(held, targets, budget)
    n = _copies(rate(F.col("p"), steps), _mark(F.col("__row.doc_id"), F.col("text"))).cast("int")
    return whole.select("__row", F.explode(F.array_repeat(F.lit(0), n)).alias("__copy")).select("__row.*")
