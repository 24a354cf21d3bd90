"""Personal data by candidate gradient boosting, in DataFrame functions only.

Fixed patterns give the base spans.  Wider generators propose further, possibly overlapping spans;
boosted trees score them by their format and by the words before them.  The trees learn, from three quarters of all
candidates, what the fixed patterns accept; per kind, a threshold calibrated on the others
selects those that are added.
"""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SMALLEST, Scratch

KINDS = ("email", "ip", "card", "phone")

# The base patterns, written so that a run is tried once, from its start or from the end
# of the match before; possessive, as nothing that follows can need a shorter match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]{1,63}+)*+",
    "ip": r"(?<![0-9.,:])[0-9]{1,4}(?:[.,:][0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){11,20}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|\()?[0-9](?:[ ()./-]{0,2}[0-9]){6,14}+(?![0-9A-Za-z])",
}
# What a text must hold for a pattern of the kind to match at all.
NEEDS = {"email": ("@", "(at)", "[at]"), "phone": ("+",)}
CUES = ("mail", "contact", "card", "visa", "pay", "ip", "host", "server", "call", "phone", "tel", "fax")
FEATURES = ("size", "digits", "letters", "dots", "signs", "blanks", "parts", "plus", "longest", "cue", "colon", "family")
CONTEXT = 24

SPAN = "array<struct<kind:int,start:int,end:int,value:string,before:string>>"


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """Spans of all matches: the text is cut at them, and the lengths of the parts are added up."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(found.alias("m"), F.split(text, pattern, -1).alias("g"))
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPAN).alias("out"))

    def step(acc, pair):
        begin = acc["at"] + F.length(pair["g"])
        end = begin + F.length(F.coalesce(pair["m"], F.lit("")))
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), pair["m"].alias("value"), F.right(pair["g"], F.lit(CONTEXT)).alias("before"))
        return F.struct(end.alias("at"), F.when(pair["m"].isNull(), acc["out"]).otherwise(F.concat(F.coalesce(acc["out"], F.array().cast(SPAN)), F.array(span))).alias("out"))

    added = F.aggregate(pairs, start, step, lambda acc: F.coalesce(acc["out"], F.array().cast(SPAN)))
    return F.when(F.size(found) > 0, added).otherwise(F.array().cast(SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check sum of card numbers: from the right, every second digit doubled and its digits added."""
    def add(total, i):
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _accepted(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _test(kind: str):
    return lambda s: _accepted(kind, s["value"])


def _gate(kind: str, text: Column, wide: bool) -> Column:
    if kind == "email" and not wide:
        return text.contains("@")
    if kind == "email" or (kind == "phone" and not wide):
        test = F.lit(False)
        for part in NEEDS[kind]:
            test = test | text.contains(part)
        return test
    return text.rlike("[0-9]")


def spans_of(text: Column, wide: bool = False) -> dict[str, Column]:
    out = {}
    for k, kind in enumerate(KINDS):
        found = _matches(text, (WIDE if wide else BASE)[kind], k)
        if not wide and kind != "email":
            found = F.filter(found, _test(kind))
        out[kind] = F.when(_gate(kind, text, wide), found).otherwise(F.array().cast(SPAN))
    return out


def _feature(name: str, s) -> Column:
    value, before = s["value"], F.lower(s["before"])
    if name == "cue":
        test = F.lit(0)
        for i, cue in enumerate(CUES):
            test = F.when(before.contains(cue), i + 1).otherwise(test)
        return test.cast("double")
    number = {
        "size": lambda: F.length(value), "digits": lambda: F.length(_digits(value)), "letters": lambda: F.length(F.regexp_replace(value, "[^A-Za-z]", "")),
        "dots": lambda: F.length(F.regexp_replace(value, "[^.]", "")), "signs": lambda: F.length(F.regexp_replace(value, "[^()/:,@+-]", "")),
        "blanks": lambda: F.length(F.regexp_replace(value, "[^ ]", "")), "parts": lambda: F.size(F.split(value, "[^0-9A-Za-z]+")),
        "plus": lambda: value.startswith("+").cast("int"), "longest": lambda: F.array_max(F.transform(F.split(value, "[^0-9]+"), lambda p: F.length(p))),
        "colon": lambda: before.rlike("[:=] ?\"?$").cast("int"), "family": lambda: s["kind"],
    }[name]()
    return number.cast("double")


def _overlap(a, b) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


class SpanModel:
    """Boosted trees as nested lists (feature, threshold, left, right) or leaf values, and a threshold per kind."""

    def __init__(self, trees: list[tuple[float, object]], thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    def margin(self, features: Column) -> Column:
        """The weighted sum of the trees for an array of features."""
        def walk(node):
            if isinstance(node, float):
                return F.lit(node)
            feature, at, left, right = node
            return F.when(F.get(features, F.lit(feature)) <= at, walk(left)).otherwise(walk(right))
        total = F.lit(0.0)
        for weight, tree in self.trees:
            total = total + F.lit(weight) * walk(tree)
        return total

    def threshold(self, kind: Column) -> Column:
        out = F.lit(float("inf"))
        for k, at in self.thresholds.items():
            out = F.when(kind == k, F.lit(at)).otherwise(out)
        return out


def _tree(node) -> object:
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return split.featureIndex(), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def fit(candidates: DataFrame, scratch: Scratch, trees: int = 10, precision: float = 0.9) -> SpanModel:
    """``candidates``: key, kind, features, label.  Learns from all of them; those described alike are one row with their number as weight.

    A quarter of them, chosen by hash, calibrates: the threshold of a kind is the smallest score above which at least
    ``precision`` of them are labelled; a kind for which there is none adds nothing, as do candidates of one label.
    """
    alike = ["kind", "label", "tests", *FEATURES]
    described = scratch.keep(candidates.select(
        "kind", "label", (F.pmod(F.xxhash64("key", F.lit(1)), F.lit(4)) == 0).alias("tests"),
        *[F.get("features", F.lit(i)).alias(f) for i, f in enumerate(FEATURES)]).groupBy(*alike).agg(F.count("*").cast("double").alias("weight")))
    learned = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(described.where("NOT tests"))
    seen = {r["label"] for r in learned.select("label").distinct().collect()}
    if seen != {0.0, 1.0}:
        return SpanModel([], {})
    model = GBTClassifier(featuresCol="vector", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=3, seed=7).fit(learned)
    out = SpanModel([(float(w), _tree(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees)], {})
    scored = described.where("tests").select("kind", "label", "weight", F.round(out.margin(F.array(*FEATURES)), 9).alias("score"))
    steps = scored.groupBy("kind", "score").agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n"))
    above = Window.partitionBy("kind").orderBy(F.desc("score"))
    best = steps.withColumn("share", F.sum("good").over(above) / F.sum("n").over(above)).where(F.col("share") >= precision).groupBy("kind").agg(F.min("score").alias("at"))
    out.thresholds = {r["kind"]: r["at"] for r in best.collect()}
    return out


def find_personal_data(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, base and added (arrays of kind, start, end, value).

    Positions count code points; ends are exclusive.  Null text is empty and has no spans.  Added spans
    overlap no base span, and of added ones that overlap the first, then longest stays.  Rows are
    independent of each other, so repeated rows give repeated results.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    base, wide = spans_of(F.col("text")), spans_of(F.col("text"), True)
    both = rows.select("doc_id", F.concat(*[base[k] for k in KINDS]).alias("base"), F.concat(*[wide[k] for k in KINDS]).alias("wide"))
    described = F.transform("wide", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        F.exists("base", lambda b: (b["kind"] == s["kind"]) & _overlap(b, s)).cast("double").alias("label"),
        F.exists("base", lambda b: _overlap(b, s)).alias("known"), F.array(*[_feature(f, s) for f in FEATURES]).alias("features")))
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    held = scratch.keep(both.select("doc_id", plain.alias("base"), described.alias("wide")))
    each = held.where(F.size("wide") > 0).select("doc_id", F.explode("wide").alias("s")).select(
        F.concat_ws(":", F.coalesce("doc_id", F.lit(SMALLEST)), "s.start", "s.end", "s.kind").alias("key"), "s.kind", "s.features", "s.label")
    model = fit(each, scratch)
    chosen = F.filter("wide", lambda s: ~s["known"] & (model.margin(s["features"]) >= model.threshold(s["kind"])))
    brief = F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"), s["value"].alias("value")))
    kind = "array<struct<start:int,back:int,kind:int,value:string>>"

    def clear(acc, s):
        return F.when(F.exists(acc, lambda a: (a["start"] < -s["back"]) & (s["start"] < -a["back"])), acc).otherwise(F.concat(acc, F.array(s)))

    apart = F.aggregate(F.array_sort(brief), F.array().cast(kind), clear)
    return held.select("doc_id", "base", F.transform(apart, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), (-s["back"]).alias("end"), s["value"].alias("value"))).alias("added"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` by kind and start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
