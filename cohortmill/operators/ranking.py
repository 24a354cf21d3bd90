"""Order-dependent statistics that never sort a whole group in one task.

A plain window over a hot key puts that key into one task.  Here values are first collapsed to
distinct ones with counts (hot values become one row), then either bracketed by a sketch
(quantiles) or cut into ranges of even size with running totals carried over (scans).
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.nulls import all_of, number
from ..functions.relate import SALTS, attach, attach_checked, discard, md5_order, stored

_COMBINE = {"sum": (F.sum, lambda a, b: a + b), "min": (F.min, F.least), "max": (F.max, F.greatest)}


def exact_quantiles(df: DataFrame, by, value, probs, interpolate: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Exact quantiles per group: columns ``by`` and ``q`` (array in the order of ``probs``).  Runs jobs.

    The groups and values are evaluated once and stored.  A mergeable sketch per group then brackets all wanted
    ranks; one more pass counts, without copying a row, what lies between the brackets and keeps the distinct
    values inside them, about ``8 / accuracy`` of a group for each.  ``interpolate`` gives the linear (continuous)
    quantile, otherwise the order statistic of rank ``ceil(p * n)``.
    """
    by, probs = list(by), [float(p) for p in probs]
    x, n, rising = F.col("__x"), len(probs), sorted(range(len(probs)), key=lambda i: probs[i])
    rows = stored(df.select(*by, number(value).alias("__x")).where(x.isNotNull()))
    slack = 4.0 / accuracy
    low, high = [max(probs[i] - slack, 0.0) for i in rising], [min(probs[i] + slack, 1.0) for i in rising]

    def edges(points):
        return F.percentile_approx("__x", points, accuracy)

    sketch = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__x").alias("__min"), F.max("__x").alias("__max"), edges(low).alias("__lo"), edges(high).alias("__hi"))
    ranks = []
    for k, i in enumerate(rising):
        if interpolate:
            position = F.lit(probs[i]) * (F.col("__n") - 1)
            first, second = F.floor(position) + 1, F.ceil(position) + 1
            part = position - F.floor(position)
        else:
            first = F.greatest(F.ceil(F.lit(probs[i]) * F.col("__n")), F.lit(1))
            second, part = first, F.lit(0.0)
        few = F.col("__n") * slack < 2      # the slack is less than two ranks: the bracket is the whole group
        lo = F.col("__min") if low[k] <= 0.0 else F.when(few, F.col("__min")).otherwise(F.col("__lo")[k])
        hi = F.col("__max") if high[k] >= 1.0 else F.when(few, F.col("__max")).otherwise(F.col("__hi")[k])
        ranks.append(F.struct(F.lit(k).alias("k"), F.lit(i).alias("i"), lo.alias("lo"), hi.alias("hi"), first.cast("long").alias("first"), second.cast("long").alias("second"), part.alias("part")))
    # sketches depend on the order of arrival: stored, the brackets are the same for all that follows
    wanted = stored(sketch.select(*by, F.array(*ranks).alias("__want")))
    held = attach_checked(rows, wanted, by, "inner", cells_per_row=7 * n)
    want = [F.col("__want")[k] for k in range(n)]
    above = sum(((x >= w["lo"]).cast("int") for w in want[1:]), (x >= want[0]["lo"]).cast("int"))
    inside = (x >= want[0]["lo"]) & (x <= want[0]["hi"])
    for w in want[1:]:
        inside = inside | ((x >= w["lo"]) & (x <= w["hi"]))
    # __above tells which brackets a row lies below: those from this number on
    counts = held.select(*by, above.alias("__above"), F.when(inside, x).alias("__x")).groupBy(*by, "__above", "__x").agg(F.count(F.lit(1)).alias("__c"))
    each = attach_checked(counts, wanted, by, "inner", cells_per_row=7 * n).select(*by, "__above", "__x", "__c", F.explode("__want").alias("w"))
    goal = ["__k", "__i", "__first", "__second", "__part"]
    within = F.coalesce((x >= F.col("w.lo")) & (x <= F.col("w.hi")), F.lit(False))
    near = each.where(within | (F.col("__above") <= F.col("w.k"))).select(
        *by, *[F.col(f"w.{g[2:]}").alias(g) for g in goal], F.when(within, x).alias("__x"), "__c")
    near = near.groupBy(*by, *goal, "__x").agg(F.sum("__c").alias("__c"))
    upto = Window.partitionBy(*by, *goal).orderBy(F.col("__x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = near.withColumn("__cum", F.sum("__c").over(upto))

    def at(rank: str) -> Column:
        return F.min(F.when(F.col("__cum") >= F.col(rank), F.col("__x")))

    found = counted.groupBy(*by, *goal).agg(
        at("__first").alias("a"), at("__second").alias("b"),
        F.max(F.when(F.col("__x").isNull(), F.col("__cum"))).alias("below"),
    ).withColumn("q", F.when(
        (F.coalesce(F.col("below"), F.lit(0)) < F.col("__first")) & F.col("b").isNotNull(),
        F.col("a") + (F.col("b") - F.col("a")) * F.col("__part"),
    ).otherwise(F.raise_error(F.lit("quantile rank fell outside its bracket; raise accuracy")).cast("double")))
    out = stored(found.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(F.col("__i").alias("i"), "q"))).alias("__q")
    ).select(*by, F.transform("__q", lambda s: s.getField("q")).alias("q")))
    discard(rows, wanted)
    return out


def sketch_quantiles(df: DataFrame, by, value, probs, accuracy: int) -> DataFrame:
    """Approximate order statistics in one pass (relative rank error ``1 / accuracy``)."""
    return df.groupBy(*by).agg(
        F.percentile_approx(number(value), [float(p) for p in probs], accuracy).alias("q"))


def quantiles(df: DataFrame, by, value, probs, interpolate: bool = False, accuracy: int | None = None) -> DataFrame:
    """Exact quantiles, or a sketch when an ``accuracy`` is given."""
    if accuracy:
        return sketch_quantiles(df, by, value, probs, accuracy)
    return exact_quantiles(df, by, value, probs, interpolate)


def chunked(df: DataFrame, by, order: str, total: Column | None = None, chunks: int | None = None) -> DataFrame:
    """Label rows with ``__chunk`` so that chunks follow ``order`` within each group, and store them.

    Rows are range-partitioned by group and ``order`` at sampled borders, so chunks hold about equally many rows
    whatever the values; a chunk is the part of a group in one partition.  The labelled rows are stored (one job):
    what is read several times keeps its labels.  ``chunks`` fixes the number of ranges, otherwise
    partition sizes decide.  With ``total`` the group's sum of it is added as ``__n``.  Meant for frames holding each
    (group, order) once, so that a repeated value cannot fill a chunk.
    """
    by = list(by)
    if total is not None:
        df = attach(df, df.groupBy(*by).agg(F.sum(total).alias("__n")), by)
    placed = df.repartitionByRange(*([chunks] if chunks else []), *by, order)
    return stored(placed.withColumn("__chunk", F.spark_partition_id().cast("long")))


def running(df: DataFrame, by, order: str, name: str, how: str, expr: Column, descending: bool = False) -> DataFrame:
    """Inclusive running sum, min or max over a chunked frame, as column ``name``."""
    by = list(by)
    agg, combine = _COMBINE[how]

    def direction(c):
        return F.col(c).desc() if descending else F.col(c).asc()

    inside = Window.partitionBy(*by, "__chunk").orderBy(direction(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*by).orderBy(direction("__chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = df.groupBy(*by, "__chunk").agg(agg(expr).alias("__part")).select(
        *by, "__chunk", agg("__part").over(before).alias("__carry"))
    local = df.withColumn(name, agg(expr).over(inside))
    whole = F.when(F.col("__carry").isNull(), F.col(name)).otherwise(combine(F.col("__carry"), F.col(name)))
    return attach(local, carried, [*by, "__chunk"]).withColumn(name, whole).drop("__carry")


def spread_row_number(df: DataFrame, by, key, seed=0, order: str | None = None, name: str = "rn") -> DataFrame:
    """Row number per group by (``order``,) md5 of ``seed:key``, counted in 256 slices per value.

    Only the slice of one group (and one ``order`` value) is ever sorted together; slice and value
    sizes are aggregated first and added as offsets.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by = list(by)
    marked = df.withColumn("__h", md5_order(seed, *keys)).withColumn("__slice", F.substring("__h", 1, 2))
    cell = [*by, *([order] if order else []), "__slice"]
    within = Window.partitionBy(*cell).orderBy("__h", *keys)
    sizes = marked.groupBy(*cell).agg(F.count(F.lit(1)).alias("__c"))
    whole = cell[:-1]
    earlier = Window.partitionBy(*whole).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*cell, F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__before"))
    numbered = attach(marked.withColumn(name, F.row_number().over(within).cast("long")), offsets, cell) \
        .withColumn(name, F.col(name) + F.col("__before")).drop("__before", "__h", "__slice")
    if not order:
        return numbered
    values = sizes.groupBy(*whole).agg(F.sum("__c").alias("__c"))
    starts = running(chunked(values, by, order), by, order, "__cum", "sum", F.col("__c")) \
        .select(*whole, (F.col("__cum") - F.col("__c")).alias("__start"))
    return attach(numbered, starts, whole, salts=SALTS).withColumn(name, F.col(name) + F.col("__start")).drop("__start")


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Which values are of other groups: missing ones are one group, and so are NaN."""
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(a.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return ~same.to_numpy(zero_copy_only=False)


def sorted_row_number(df: DataFrame, by, key, seed=0, order: str | None = None, name: str = "rn") -> DataFrame:
    """What ``spread_row_number`` gives, by one exchange of the rows, which are then stored.  Runs jobs.

    Rows are cut at sampled borders into ranges of (group, ``order``, md5) and numbered where they lie.  Only the first
    group of a range can have begun in earlier ones: the rows it has there, a number per range, are added.  No group is
    held or sorted as a whole, and no statistics of the size of the rows are joined.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by, columns = list(by), df.columns
    sort = [*[F.col(c) for c in [*by, *([order] if order else [])]], md5_order(seed, *keys), *[F.col(k) for k in keys]]

    def numbered(batches):
        last, n, first = None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            group = [batch.column(columns.index(c)) for c in by]
            new = np.zeros(batch.num_rows, bool)
            for c in group:
                new[1:] |= _differs(c.slice(0, len(c) - 1), c.slice(1))
            if last is not None and any(_differs(x, c.slice(0, 1))[0] for x, c in zip(last, group)):
                n, first = 0, False
            starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            number = np.arange(1, batch.num_rows + 1) - np.repeat(starts[:-1], np.diff(starts))
            number[:starts[1]] += n
            begun = np.zeros(batch.num_rows, bool)
            begun[:starts[1]] = first
            n, first, last = int(number[-1]), first and len(starts) == 2, [c.slice(len(c) - 1) for c in group]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array(begun)], names=[*columns, name, "__first"])

    kinds = T.StructType([*df.schema.fields, T.StructField(name, T.LongType()), T.StructField("__first", T.BooleanType())])
    placed = df.repartitionByRange(*sort).sortWithinPartitions(*sort).mapInArrow(numbered, kinds)
    rows = stored(placed.withColumn("__range", F.spark_partition_id()))
    cut = rows.where("__first").select(*[F.col(c).alias(f"__cut_{c}") for c in by], F.lit(1).alias("__one")).distinct()
    of_cut = rows.join(F.broadcast(cut), all_of([F.col(c).eqNullSafe(F.col(f"__cut_{c}")) for c in by]), "left_semi") if by else rows
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = of_cut.groupBy(*by, "__range").agg(F.count(F.lit(1)).alias("__c")).select("__range", F.sum("__c").over(earlier).alias("__before"))
    held = attach(rows, F.broadcast(stored(carried.where("__before > 0"))), ["__range"])
    return held.withColumn(name, F.col(name) + F.when(F.col("__first"), F.coalesce("__before", F.lit(0))).otherwise(0)).select(*columns, name)
