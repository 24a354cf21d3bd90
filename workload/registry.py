"""Query registry and the shared derivation of input shapes from the given tables.

A shape is SQL text in the subset both engines read the same way, so that the operator and its
SQL counterpart start from the same rows.  ``{name}`` refers to a table or another shape;
``<<...>>`` marks the few functions spelled differently.
"""

from collections.abc import Callable
from dataclasses import dataclass
from string import Formatter

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortmill.functions.relate import deal, shares

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

DIALECT = {
    "daytext": ("date_format({}, 'ddMMMyyyy')", "strftime({}, '%d%b%Y')"),
    "days": ("(unix_micros(CAST({} AS TIMESTAMP)) / CAST(86400000000 AS DOUBLE))", "(epoch_us({}) / CAST(86400000000 AS DOUBLE))"),
}

SHAPES = {
    # one averaged value per (sample, feature)
    "long": """
        SELECT l_orderkey AS sample_id, o_custkey AS subject_id, l_partkey % 50 AS feature_id,
               c_nationkey % 5 AS site, o_orderdate AS t, avg(l_extendedprice) AS value
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
        GROUP BY l_orderkey, o_custkey, l_partkey % 50, c_nationkey % 5, o_orderdate""",
    "long_missing": """
        SELECT sample_id, subject_id, feature_id, site, t,
               CASE WHEN feature_id = 7 AND sample_id % 5 < 3 THEN NULL
                    WHEN (sample_id + feature_id) % 11 = 0 THEN NULL
                    WHEN (sample_id + feature_id) % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS value
        FROM {long}""",
    # subject metadata, one row per sample
    "metadata": """
        SELECT o_orderkey AS sample_id, CAST(o_custkey AS STRING) AS orig_id, o_custkey AS subject_id, c_mktsegment AS site,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS visitdt,
               CASE WHEN o_custkey % 17 = 0 THEN 2 ELSE 1 END AS single_twin,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(30 + (o_orderkey * 7) % 240 AS DOUBLE) END AS ga_hdlk_new,
               CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE CAST(200 + (o_custkey * 3) % 100 AS DOUBLE) END AS gagebrth_new,
               CASE WHEN o_custkey % 19 = 0 THEN CAST(-77 AS DOUBLE) ELSE CAST(16 + o_custkey % 30 AS DOUBLE) END AS pw_age,
               c_acctbal AS birth_weight,
               CASE WHEN o_custkey % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(140 + o_custkey % 50 AS DOUBLE) END AS mat_height,
               CAST(45 + o_custkey % 60 AS DOUBLE) AS mat_weight,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS pe_new,
               CASE WHEN o_orderstatus = 'F' THEN 'EOPE' WHEN o_orderstatus = 'O' THEN 'LOPE' ELSE 'TBD' END AS pe_cat,
               CAST(1 + o_orderkey % 3 AS INT) AS pe_priority,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS sb_new,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(1 + o_custkey % 3 AS INT) END AS sb_priority,
               CASE WHEN o_custkey % 31 = 0 THEN -88 ELSE CAST(1 + o_custkey % 2 AS INT) END AS birth_outcome,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS ptb_new,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS very_ptb,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS ext_ptb,
               CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS sga_3,
               CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS sga_10,
               o_totalprice / CAST(5000 AS DOUBLE) AS bwt_centile_new,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_custkey % 13 = 0 THEN 1 ELSE 0 END AS chron_htn,
               CASE WHEN o_orderkey % 4 = 1 THEN NULL WHEN o_custkey % 23 = 0 THEN 1 ELSE 0 END AS diabetes,
               CASE WHEN o_orderkey % 4 = 2 THEN NULL WHEN o_custkey % 37 = 0 THEN 1 ELSE 0 END AS fetal_anomalies,
               CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_custkey % 41 = 0 THEN 1 ELSE 0 END AS cong_anomalies,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_custkey % 43 = 0 THEN 2 WHEN o_custkey % 47 = 0 THEN 1 ELSE 0 END AS syphilis,
               CASE WHEN o_orderkey % 4 = 1 THEN NULL WHEN o_orderkey % 53 = 0 THEN 1 ELSE 0 END AS hiv,
               CASE WHEN o_orderkey % 4 = 2 THEN NULL WHEN o_custkey % 11 = 0 THEN 1 ELSE 0 END AS malaria,
               CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_custkey % 59 = 0 THEN 1 ELSE 0 END AS tb,
               CAST(1 + (o_custkey % 61) % 4 AS INT) AS smoke_hist, CAST(1 + (o_custkey % 7) % 5 AS INT) AS alcohol,
               CAST(1 + o_custkey % 4 AS INT) AS sniff_toba, CAST(o_custkey % 2 AS INT) AS passive_smok,
               CAST(o_custkey % 5 AS INT) AS parity, CAST((o_custkey % 67) % 3 AS INT) AS prev_sb,
               CAST((o_custkey % 71) % 4 AS INT) AS prev_mis, CAST(1 + o_custkey % 6 AS INT) AS wealth_index
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # metadata as the risk model names it, with one outcome
    "curated": """
        SELECT sample_id, subject_id, site, single_twin, ga_hdlk_new AS ga_sample_days, gagebrth_new AS ga_birth_days,
               CASE WHEN pw_age < 0 THEN NULL ELSE pw_age END AS maternal_age, birth_weight, sb_new AS sb,
               chron_htn AS chronic_hypertension, diabetes, fetal_anomalies, cong_anomalies AS congenital_anomalies, syphilis,
               hiv, malaria, tb AS tuberculosis, smoke_hist AS smoking_history, alcohol AS alcohol_history,
               parity AS n_previous_pregnancies, passive_smok AS smoking_exposure, prev_sb AS n_previous_stillbirth,
               prev_mis AS n_previous_miscarriage, wealth_index,
               mat_weight / nullif((mat_height / 100) * (mat_height / 100), 0) AS bmi
        FROM {metadata}""",
    "manifest": """
        SELECT c_mktsegment AS site, CAST(o_custkey AS STRING) AS orig_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS visitdt,
               o_orderkey AS sample_id, CASE WHEN o_orderstatus = 'P' THEN 'Cord Blood' ELSE 'Maternal Plasma' END AS sample_type,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'Duplicate-remove' WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE 'kept' END AS note
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # feature labels per site; one site spells them with a prefix
    "alignment": """
        SELECT DISTINCT site, concat(CASE WHEN site = 3 THEN 'x_' ELSE '' END, 'm', CAST(feature_id AS STRING)) AS feature_label,
               concat('F', CAST(feature_id AS STRING)) AS unique_feature_label
        FROM {long}""",
    "intensity": """
        SELECT sample_id, site, concat('m', CAST(feature_id AS STRING)) AS feature_label, ln(value) AS intensity_fill_log_scaled
        FROM {long}""",
    "annotation": """
        SELECT concat('F', CAST(p_partkey % 50 AS STRING)) AS unique_feature_label,
               CASE WHEN min(p_size) <= 1 AND min(p_retailprice) < 903 THEN min(p_name) END AS compound_id,
               CASE WHEN min(p_size) <= 1 AND min(p_retailprice) < 903 THEN max(p_type) END AS compound_class
        FROM {part} GROUP BY p_partkey % 50""",
    # association results: one per part
    "results": """
        SELECT concat('F', CAST(p_partkey AS STRING)) AS unique_feature_label, p_type AS "type_",
               CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_name END AS compound_id,
               CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_type END AS compound_class,
               concat('sb_', CASE WHEN p_size % 2 = 0 THEN 'control' ELSE 'noncase' END, '_', CASE WHEN p_size < 20 THEN 'lt20' ELSE 'gte20' END) AS "group_",
               CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE u * u * u * u END AS p_value, (p_retailprice - 950) / 50 AS estimate,
               p_size * 10 AS n_observations, p_size % 10 <> 3 AS is_converged, p_size % 25 = 4 AS singular_matrix_error,
               CASE WHEN p_size = 9 THEN 'failed' END AS unexpected_error
        FROM (SELECT *, ((p_partkey * 7919) % 1009) / CAST(1009 AS DOUBLE) AS u FROM {part}) x""",
    # corrected results of a new run, and of an earlier one under other names
    "corrected": """
        SELECT unique_feature_label, group_ AS "group", compound_id, compound_class, estimate, p_value,
               least(p_value * 3, CAST(1 AS DOUBLE)) AS p_value_corrected, p_value * 3 <= 0.05 AS significant, n_observations
        FROM {results} WHERE p_value IS NOT NULL""",
    "previous": """
        SELECT unique_feature_label, concat('OLD_Run_', upper(group_)) AS "group",
               CASE WHEN type_ = 'PROMO' THEN 'meta' ELSE 'pooled' END AS analysis, estimate AS Coefficient_Intensity,
               p_value, p_value * 2 AS FDR
        FROM {results} WHERE p_value * 2 <= 0.08""",
    "series": """
        SELECT event_id, user_id, event_type, <<days:ts>> AS t, value FROM {events}""",
    "scored": """
        SELECT event_id, user_id % 3 AS fold, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label, value AS score FROM {events}""",
}


@dataclass(frozen=True)
class Entry:
    run: Callable
    sql: str | None
    doubles: tuple[str, ...]
    digits: int


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, doubles: str = "", digits: int = 6):
    """Register a query; ``doubles`` lists the columns rounded on both sides."""
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"{name} registered twice")
        REGISTRY[name] = Entry(fn, sql, tuple(doubles.split()), digits)
        return fn
    return register


def _references(text: str) -> list[str]:
    return list(dict.fromkeys(n for _, n, _, _ in Formatter().parse(text) if n))


def _dialect(text: str, engine: int) -> str:
    while "<<" in text:
        start, end = text.index("<<"), text.index(">>")
        name, argument = text[start + 2:end].split(":")
        text = text[:start] + DIALECT[name][engine].format(argument) + text[end + 2:]
    return text


def dealt_long(t: "Inputs") -> DataFrame:
    """The shape ``long`` with lines and orders dealt by order, in as many parts as the lines ask for.

    The site joins the orders, not the lines, and all that follows per sample needs no further exchange.
    """
    lines = t["lineitem"].where("l_orderkey IS NOT NULL").select("l_orderkey", "l_partkey", "l_extendedprice")
    visits = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).where("o_orderkey IS NOT NULL") \
        .select("o_orderkey", "o_custkey", "c_nationkey", "o_orderdate")
    parts = shares(t.spark, t["lineitem"].count())
    rows = deal(lines, "l_orderkey", parts).join(deal(visits, "o_orderkey", parts), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy(
        F.col("l_orderkey").alias("sample_id"), F.col("o_custkey").alias("subject_id"), F.expr("l_partkey % 50").alias("feature_id"),
        F.expr("c_nationkey % 5").alias("site"), F.col("o_orderdate").alias("t")).agg(F.avg("l_extendedprice").alias("value"))


# Shapes that Spark builds by other steps than their SQL, with the same rows.
BUILT = {"long": dealt_long}


class Inputs:
    """Tables and shapes as DataFrames, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._made = spark, folder.rstrip("/"), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in TABLES:
                self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            elif name in BUILT:
                self._made[name] = BUILT[name](self)
            else:
                text = _dialect(SHAPES[name], 0).replace('"', "`")
                self._made[name] = self.spark.sql(text, **{n: self[n] for n in _references(text)})
        return self._made[name]


def oracle_text(entry: Entry) -> str:
    """The SQL with every shape it needs as a common table expression."""
    ordered: list[str] = []

    def need(text):
        for n in _references(text):
            if n in SHAPES and n not in ordered:
                need(SHAPES[n])
                ordered.append(n)

    need(entry.sql)
    names = {n: n for n in [*SHAPES, *TABLES]}
    ctes = [f"{n} AS ({_dialect(SHAPES[n], 1).format(**names)})" for n in ordered]
    body = _dialect(entry.sql, 1).format(**names)
    if entry.doubles:
        replaced = ", ".join(f'round("{c}", {entry.digits}) + 0.0 AS "{c}"' for c in entry.doubles)
        body = f"SELECT * REPLACE ({replaced}) FROM ({body})"
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def spark_query(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        out = entry.run(Inputs(spark, folder))
        return out.select(*[
            (F.round(F.col(f"`{c}`"), entry.digits) + F.lit(0.0)).alias(c) if c in entry.doubles else F.col(f"`{c}`") for c in out.columns])
    return run
