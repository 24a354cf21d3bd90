"""Exact duplicates by skew-safe combining: local, salted, then global, comparing whole texts."""

from pyspark.sql import DataFrame, functions as F

from .common import SMALLEST, Scratch, free_name, lookup, plain_columns, text_or_empty


def exact_dedup(docs: DataFrame, scratch: Scratch | None = None, salts: int = 16, digest=None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are compared as they are.  Rows are first combined where they lie (map-side), per salt of
    their digest; the winners of the salts are then combined per digest.  Every stage groups by
    digest *and* text.  Of equal texts the largest doc_id stays.  Only groups of several rows are looked up by
    the documents, by digest, and by text as well where different texts share a digest.

    Null text is empty.  A null doc_id counts as smallest and stays only in a group of its own
    kind.  Repeated rows count each; those with the kept doc_id are all ``kept``.  ``digest`` makes
    the grouping digest of a text column (SHA-256 by default).
    """
    digest = digest or (lambda text: F.sha2(text, 256))
    scratch = scratch or Scratch(docs.sparkSession)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text"))).withColumn("id", F.coalesce("doc_id", F.lit(SMALLEST)))
    salted = rows.groupBy("digest", "text", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")).agg(F.max("id").alias("keep"), F.count("*").alias("n"))
    merged = salted.groupBy("digest", "text").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"))
    groups = scratch.keep(
        merged.groupBy("digest").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"), F.count("*").alias("texts")).where("n > 1"))
    narrow = scratch.keep(rows.select("doc_id", "id", "digest", F.sha2("text", 256).alias("text_sha256")))
    total = narrow.count()
    found = lookup(narrow, groups, ["digest"], "n", total, "left").withColumn("texts", F.coalesce("texts", F.lit(1)))
    if groups.where("texts > 1").limit(1).count():
        shared = groups.where("texts > 1").select("digest")
        exact = merged.join(shared, "digest", "left_semi")
        found = found.where("texts = 1").unionByName(
            rows.join(exact, ["digest", "text"]).select("doc_id", "id", "digest", F.sha2("text", 256).alias("text_sha256"), "keep", "n", F.lit(1).alias("texts")))
    keep = F.coalesce("keep", "id")
    return found.select("doc_id", F.when(keep != SMALLEST, keep).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                        (keep == F.col("id")).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with one row of each text, all columns unchanged, whatever their names."""
    text, id_, digest = (free_name(docs, stem) for stem in ("text", "kept", "kept_text"))
    kept = exact_dedup(docs, scratch).where("kept").select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(digest)).distinct()
    marked = docs.withColumn(text, F.sha2(text_or_empty(), 256))
    stay = marked.join(kept, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(text) == F.col(digest)), "left_semi")
    return stay.dropDuplicates(["doc_id", text]).select(*plain_columns(docs))
