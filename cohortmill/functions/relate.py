"""Joining small statistics to rows, spreading rows, and cutting lineage."""

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from .nulls import all_of


SALTS = 8


def attach(rows: DataFrame, stats: DataFrame, by, how: str = "left", salts: int = 1) -> DataFrame:
    """Add the columns of ``stats`` (one row per key) to every row.

    Null keys match null keys.  Without keys ``stats`` is a single aggregated row and is read as
    a scalar subquery.  With keys the join strategy is left to the optimizer, which broadcasts
    only below its size threshold.  ``salts`` > 1 spreads each key's rows over that many join
    keys (by a hash of the row) against as many copies of the statistics: a hot key is split even in a shuffled join,
    and a later aggregation on a superset of ``by`` cannot inherit a skewed partitioning.
    """
    by = list(by)
    added = [c for c in stats.columns if c not in by]
    if not by:
        one = stats.select(F.struct(*added).alias("s")).scalar()
        held = rows.withColumn("__stats", one)
        return held.select(*rows.columns, *[F.col("__stats").getField(c).alias(c) for c in added])
    columns = rows.columns
    keyed = stats.select(*[F.col(c).alias(f"__key_{i}") for i, c in enumerate(by)],
                         *[F.col(c).alias(f"__add_{i}") for i, c in enumerate(added)])
    match = [F.col(c).eqNullSafe(F.col(f"__key_{i}")) for i, c in enumerate(by)]
    if salts > 1:
        rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int"))
        keyed = keyed.withColumn("__copy", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
        match.append(F.col("__salt") == F.col("__copy"))
    joined = rows.join(keyed, all_of(match), how)
    return joined.select(*columns, *[F.col(f"__add_{i}").alias(c) for i, c in enumerate(added)])


# Cells (rows x columns, numbers mostly) up to which a statistics table is broadcast: about 32 MB.
BROADCAST_CELLS = 1_000_000


def attach_checked(rows: DataFrame, stats: DataFrame, by, how: str = "left", cells_per_row: int | None = None) -> DataFrame:
    """``attach`` for statistics that are usually small: computes them now and looks at their size.

    The statistics are checkpointed (one job, which the result needs anyway) and counted.  Within
    ``BROADCAST_CELLS`` they are broadcast, so the rows are not shuffled at all; beyond it the
    salted shuffle join is used.
    """
    if not by:
        return attach(rows, stats, by, how)
    settled = cut_lineage(stats)
    if settled.count() * (cells_per_row or len(stats.columns)) <= BROADCAST_CELLS:
        return attach(rows, F.broadcast(settled), by, how)
    return attach(rows, settled, by, how, SALTS)


# Rows that a task should hold at most, and at least as long as there are cores without work.
TASK_ROWS, LEAST_ROWS = 150_000, 20_000


def shares(spark, rows: int) -> int:
    """How many tasks so many rows are dealt to: as many as the rows ask for, so that a task's share does not grow with them."""
    return max(1, -(-rows // TASK_ROWS), min(spark.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS)))


def deal(df: DataFrame, by, parts: int) -> DataFrame:
    """Rows by hash of the keys in a fixed number of partitions, which is not cut back by size in bytes.

    Joins and groups by a superset of these keys then work where the rows lie.
    """
    return df.repartition(parts, *[F.col(c) for c in ([by] if isinstance(by, str) else by)])


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The row with the smallest ``order`` per key, combined map-side (no window over a hot key)."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order) if not isinstance(order, Column) else order
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("__row"))
    return kept.select(*[F.col(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns])


def md5_order(seed, *keys) -> Column:
    """Portable pseudo-random sort key: md5 of ``seed:key[:key]``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def shared_folder(spark) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, one in the session's warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names in ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def free(df: DataFrame) -> None:
    """Delete the files of a frame from ``cut_lineage`` that no plan reads any more."""
    plan = df._jdf.queryExecution().analyzed()
    file = plan.rdd().getCheckpointFile()
    if file.isDefined():
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as read again from a new Parquet table in the shared folder: computed once, read by columns."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    held._stored_at = path
    return held


def discard(*tables: DataFrame) -> None:
    """Delete tables from ``stored`` that no plan reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
