"""Shared pieces: scratch tables, lookups that survive hot keys, connected components."""

import uuid
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.relate import shares

SMALLEST = -(2**63)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name beginning with ``stem`` that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (f"__{stem}{k or ''}" for k in count()) if n.lower() not in taken)


def plain_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, also those with dots or other signs in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


class Scratch:
    """Tables written once and read again, in the shared folder the cluster names.

    The folder is ``spark.checkpoint.dir``; only where that is unset (tests) it lies in the
    warehouse of the session.  A written table cuts lineage and survives the loss of executors.
    Tables that the result no longer needs are dropped by the operators; the others stay until
    ``clear`` or until the folder is emptied by the cluster.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
        self.root = f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex}"
        self._names = count()

    def keep(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Write ``df`` and return it as read from there; column names may be of any kind.

        Where ``rows`` bounds the (short) rows of the last step, no more tasks write than so many rows ask for.
        """
        if rows is not None:
            df = df.coalesce(shares(self.spark, rows))
        path = f"{self.root}/{next(self._names)}"
        df.write.parquet(path)
        held = self.spark.read.schema(df.schema).parquet(path)
        held._scratch_path = path
        return held

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self._delete(t._scratch_path)

    def clear(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


# A key with more than this share of the rows is looked up by broadcast: at most 1 / HEAVY keys.
HEAVY = 1 / 1000
# Rows, of a few numbers each, up to which a table is broadcast whole: about 6 MB.
SMALL = 1 << 17


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner", narrow: bool = False) -> DataFrame:
    """Join ``table`` (one row per key, with the number of ``rows`` of that key in ``weight``).

    Keys that hold a share of ``HEAVY`` of all rows or more, of which there can be at most
    ``1 / HEAVY``, are broadcast, so that their rows are not shuffled; the others are joined by
    shuffle, where no key is large.  Both inputs are read twice: pass stored tables.  Every key has a row, so
    ``total`` bounds the table too: a ``narrow`` one, of a few numbers a row, is broadcast whole up to SMALL rows.
    """
    if narrow and total <= SMALL:
        return rows.join(F.broadcast(table), keys, how)
    heavy = F.broadcast(table.where(F.col(weight) >= total * HEAVY))
    light = table.where(F.col(weight) < total * HEAVY)
    rest = rows.join(heavy.select(*keys), keys, "left_anti").join(light, keys, how)
    return rows.join(heavy, keys).select(*rest.columns).unionAll(rest)


def components(edges: DataFrame, scratch: Scratch, most: int | None = None) -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b): the smallest id that can be reached.

    Large-star and small-star steps alternate until the edges no longer change; each step is one
    aggregation and one join of edges, and never adds an edge.  Hot nodes go through ``lookup``.
    A step takes as many tasks as its edges ask for; ``most`` bounds the first ones, repeated ones included.
    """
    spark = edges.sparkSession
    ordered = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    held = scratch.keep(ordered, most)
    seen = _checksum(held)
    while seen[0]:
        both = held.unionAll(held.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        rows = 2 * seen[0]
        lowest = scratch.keep(both.groupBy("hi").agg(F.least("hi", F.min("lo")).alias("m"), F.count("*").alias("w")), rows)
        large = scratch.keep(lookup(both.where("lo > hi"), lowest, ["hi"], "w", rows, narrow=True).select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct(), rows)
        lower = scratch.keep(large.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("w")), rows)
        moved = lookup(large, lower, ["hi"], "w", seen[0], narrow=True).select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        after = scratch.keep(moved.unionAll(lower.select("hi", F.col("m").alias("lo"))).distinct(), rows)
        scratch.drop(held, lowest, large, lower)
        held, before, seen = after, seen, _checksum(after)
        if before == seen:
            break
    members = held.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return members.unionAll(held.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()) if seen[0] else \
        spark.createDataFrame([], members.schema)


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.pmod(F.xxhash64("lo", "hi"), F.lit(1 << 20)))).head())
