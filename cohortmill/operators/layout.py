"""The two shapes of a measurement table and how statistics are computed on and applied to them.

``Long`` is one row per (sample, feature) and scales with the number of features.  ``Wide`` is one
row per sample with a column per feature, for up to a few thousand columns.  An operator is
written once against the shared methods; all features are summarised in one aggregation.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import all_of, number
from ..functions.relate import attach, attach_checked
from .ranking import exact_quantiles

Stat = Callable[[Column], Column]
Rule = Callable[[Column, Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Long:
    feature: str = "feature_id"
    value: str = "value"

    def values(self):
        return [self.value]

    def summarise(self, df: DataFrame, by=(), aggs: dict[str, Stat] | None = None,
                  probs: dict[str, float] | None = None, accuracy: int | None = None,
                  interpolate: bool = False) -> DataFrame:
        """One row per (group, feature) with the named statistics."""
        keys = [*by, self.feature]
        x = number(self.value)
        plain = {n: fn(x) for n, fn in (aggs or {}).items()}
        if probs and accuracy:
            sketch = F.percentile_approx(x, [float(p) for p in probs.values()], accuracy)
            plain |= {n: sketch[i] for i, n in enumerate(probs)}
            probs = None
        out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in plain.items()]) if plain else None
        if probs:
            q = exact_quantiles(df, keys, self.value, list(probs.values()), interpolate)
            q = q.select(*keys, *[F.col("q")[i].alias(n) for i, n in enumerate(probs)])
            out = q if out is None else attach(out, q, keys)
        return out

    def _with(self, df, stats, by):
        keys = [*by, self.feature]
        named = stats.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in stats.columns if c not in keys])
        return attach_checked(df, named, keys)

    def merge(self, stats: DataFrame, overall: DataFrame) -> DataFrame:
        """Group statistics with the features' overall ones beside them as ``all_<name>``."""
        named = overall.select(self.feature, *[F.col(c).alias(f"all_{c}") for c in overall.columns if c != self.feature])
        return attach(stats, named, [self.feature])

    def apply(self, df: DataFrame, stats: DataFrame, rule: Rule, by=(), name: Callable[[str], str] = lambda c: c) -> DataFrame:
        """Compute ``rule(value, statistic)`` for every value."""
        held = self._with(df, stats, by)
        return held.withColumn(name(self.value), rule(number(self.value), lambda s: F.col(f"__s_{s}"))) \
            .drop(*[c for c in held.columns if c.startswith("__s_")])

    def keep(self, df: DataFrame, stats: DataFrame, rule: Rule, by=()) -> DataFrame:
        """Rows for which the rule holds."""
        return self._with(df, stats, by).where(rule(number(self.value), lambda s: F.col(f"__s_{s}"))).select(*df.columns)

    def project(self, df: DataFrame, fn: Stat, name: Callable[[str], str] = lambda c: c) -> DataFrame:
        """A row-wise expression of the value, without statistics."""
        return df.withColumn(name(self.value), fn(number(self.value)))

    def renamed(self, name: Callable[[str], str]) -> "Long":
        return Long(self.feature, name(self.value))


@dataclass(frozen=True)
class Wide:
    columns: tuple[str, ...]

    def __init__(self, columns):
        object.__setattr__(self, "columns", tuple(columns))

    def values(self):
        return list(self.columns)

    def summarise(self, df: DataFrame, by=(), aggs=None, probs=None, accuracy=None, interpolate=False) -> DataFrame:
        """One row (per group) holding a struct of statistics per feature column.

        Without groups the row is fetched now, a few numbers per column, and later steps see
        constants instead of nested subqueries.
        """
        by = list(by)
        exact = probs and not accuracy
        sketched = probs if probs and accuracy else {}

        def fields(c):
            x = number(c)
            made = [fn(x).alias(n) for n, fn in (aggs or {}).items()]
            if sketched:
                sketch = F.percentile_approx(x, [float(p) for p in sketched.values()], accuracy)
                made += [sketch[i].alias(n) for i, n in enumerate(sketched)]
            return made

        plain, q = None, None
        if aggs or sketched:
            plain = df.groupBy(*by).agg(*[F.struct(*fields(c)).alias(c) for c in self.columns])
        if exact:
            casts = [f"nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)) AS `{c}`" for c in self.columns]
            melted = df.selectExpr(*[f"`{k}`" for k in by], *casts).unpivot(by, list(self.columns), "__f", "__x")
            q = exact_quantiles(melted, [*by, "__f"], "__x", list(probs.values()), interpolate)
        if not by:
            return self._constants(df, plain, q, aggs, sketched, probs if exact else {})
        if q is None:
            return plain
        q = q.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("__f", "q"))).alias("__q"))
        ready = q if plain is None else attach(plain, q, by)

        def packed(c):
            kept = [f"`{c}`.`{n}` AS `{n}`" for n in aggs or {}]
            return f"struct({', '.join(kept + [f'__q[{c!r}][{i}] AS `{n}`' for i, n in enumerate(probs)])}) AS `{c}`"

        return ready.selectExpr(*[f"`{k}`" for k in by], *[packed(c) for c in self.columns])

    def _constants(self, df, plain, q, aggs, sketched, exact) -> DataFrame:
        names = [*(aggs or {}), *sketched, *exact]
        row = plain.first() if plain is not None else {c: () for c in self.columns}
        found = {r["__f"]: r["q"] for r in q.collect()} if q is not None else {}
        missing = [None] * len(exact)
        values = [tuple(None if v is None else float(v) for v in [*row[c], *found.get(c, missing)]) for c in self.columns]
        struct = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
        return df.sparkSession.createDataFrame([tuple(values)], T.StructType([T.StructField(c, struct) for c in self.columns]))

    def as_rows(self, stats: DataFrame, by=(), feature: str = "feature_id") -> DataFrame:
        """Wide statistics as one row per (group, feature)."""
        return stats.unpivot(list(by), list(self.columns), feature, "__s").select(*by, feature, "__s.*")

    def _with(self, df, stats, by):
        """(rows with the statistics at hand, how to read one): constants, or columns joined per group."""
        if not by:
            row = stats.first()
            return df, lambda c: lambda n: F.lit(row[c][n]).cast("double")
        named = stats.selectExpr(*[f"`{k}`" for k in by], *[f"`{c}` AS `__s_{c}`" for c in self.columns])
        held = attach_checked(df, named, list(by), cells_per_row=8 * len(self.columns))
        return held, lambda c: lambda n: F.expr(f"`__s_{c}`.`{n}`")

    def merge(self, stats, overall) -> DataFrame:
        row = overall.first()
        keys = [c for c in stats.columns if c not in self.columns]

        def joined(c):
            mine = [f"`{c}`.`{n}` AS `{n}`" for n in stats.schema[c].dataType.names]
            theirs = [f"CAST({'NULL' if v is None else repr(v) + 'D'} AS DOUBLE) AS `all_{n}`" for n, v in row[c].asDict().items()]
            return ", ".join(mine + theirs)

        return stats.selectExpr(*[f"`{k}`" for k in keys], *[f"struct({joined(c)}) AS `{c}`" for c in self.columns])

    def apply(self, df, stats, rule, by=(), name=lambda c: c) -> DataFrame:
        held, statistic = self._with(df, stats, by)
        made = {name(c): rule(number(c), statistic(c)) for c in self.columns}
        return held.select(*[made.pop(c).alias(c) if c in made else c for c in df.columns],
                           *[e.alias(n) for n, e in made.items()])

    def keep(self, df, stats, rule, by=()) -> DataFrame:
        held, statistic = self._with(df, stats, by)
        return held.where(all_of(rule(number(c), statistic(c)) for c in self.columns)).select(*df.columns)

    def project(self, df, fn, name=lambda c: c) -> DataFrame:
        return df.withColumns({name(c): fn(number(c)) for c in self.columns})

    def renamed(self, name) -> "Wide":
        return Wide(name(c) for c in self.columns)
