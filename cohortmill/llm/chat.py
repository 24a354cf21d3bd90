"""Chat formatting with collapse of cumulative snapshots, in DataFrame functions only."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SMALLEST, Scratch

# Turns of a conversation that are rendered into one row; longer conversations have several parts.
PART = 4096
# Turn numbers that are hashed by one window; longer conversations are hashed part by part.
CHUNK = 1024


def _codes(*columns) -> list[Column]:
    """Two independent 64-bit codes of a turn; null differs from empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, n, a, b): number of turns up to this one and the rolling codes of them.

    The code of a prefix is the exclusive or of the codes of its turns (number, role, text), so it rolls on by one
    operation per turn and is put together from chunks of CHUNK turn numbers.  Repeated rows count once.
    """
    a, b = _codes("turn", "role", "text")
    coded = turns.select(F.coalesce("conv_id", F.lit(SMALLEST)).alias("conv"), "turn", a.alias("a"), b.alias("b")).distinct()
    held = scratch.keep(coded.withColumn("chunk", F.floor(F.coalesce("turn", F.lit(SMALLEST)) / CHUNK)))
    within = Window.partitionBy("conv", "chunk").orderBy("turn", "a", "b").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = held.groupBy("conv", "chunk").agg(F.count("*").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    base = chunks.select("conv", "chunk", *[F.coalesce(f(c).over(before), F.lit(0)).alias(f"{c}0") for c, f in (("n", F.sum), ("a", F.bit_xor), ("b", F.bit_xor))])
    rolled = held.select("conv", "chunk", "turn", F.count("*").over(within).alias("n"), F.bit_xor("a").over(within).alias("a"), F.bit_xor("b").over(within).alias("b"))
    return rolled.join(base, ["conv", "chunk"]).select(
        "conv", "turn", (F.col("n") + F.col("n0")).alias("n"), F.col("a").bitwiseXOR(F.col("a0")).alias("a"), F.col("b").bitwiseXOR(F.col("b0")).alias("b"))


def maximal(turns: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Conversations that are no prefix of a longer one: conv, n_turns, n_copies.

    Of equal conversations the smallest conv_id stays and ``n_copies`` counts them.
    """
    scratch = scratch or Scratch(turns.sparkSession)
    rolled = scratch.keep(prefixes(turns, scratch))
    last = rolled.groupBy("conv").agg(F.max("n").alias("n"))
    ends = rolled.join(last, ["conv", "n"])
    whole = ends.groupBy("n", "a", "b").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    # codes of proper prefixes: those of a turn that is not the last one of its conversation
    inner = rolled.join(last.select("conv", F.col("n").alias("n_last")), "conv").where("n < n_last").groupBy("n", "a", "b").count().drop("count")
    return whole.join(inner, ["n", "a", "b"], "left_anti").select("conv", F.col("n").alias("n_turns"), "n_copies")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n<|end|>\n"))


def format_chats(turns: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per part of a retained conversation: conv_id, n_turns, n_copies, part, text.

    A conversation is the set of its distinct turns (number, role, text) in the order of the number; repeated rows
    count once, and turns with the same number follow each other by role and text.  A null conv_id is a conversation of its own, null
    numbers come first, a null role is rendered as ``unknown``, null text as empty.  ``part`` numbers stretches of PART turn numbers
    and is 0 throughout for conversations of usual length.
    """
    scratch = scratch or Scratch(turns.sparkSession)
    kept = scratch.keep(maximal(turns, scratch))
    own = turns.select(F.coalesce("conv_id", F.lit(SMALLEST)).alias("conv"), "turn", "role", "text").join(kept, "conv")
    part = F.floor(F.coalesce("turn", F.lit(0)) / PART)
    order = F.array_sort(F.collect_set(F.struct("turn", "role", "text")))
    made = own.groupBy("conv", part.alias("part")).agg(F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), order.alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: render(t["role"], t["text"])), "")
    return made.select(F.when(F.col("conv") != SMALLEST, F.col("conv")).alias("conv_id"), "n_turns", "n_copies", "part", text.alias("text"))
