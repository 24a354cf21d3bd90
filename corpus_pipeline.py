"""The corpus pipeline: language, exact copies, near copies, mixing to target weights, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last
return the columns of documents.  ``run`` writes each stage as Parquet to the shared folder and reads it again.

SQL cannot express the learned stages, so there is no ORACLE_SQL; the tests compare with brute force.
"""

from cohortmill.llm.common import Scratch
from cohortmill.llm.exact_dedup import without_copies
from cohortmill.llm.language import keep_identified
from cohortmill.llm.minhash_dedup import without_near_copies
from cohortmill.llm.mixing import mixed
from cohortmill.llm.packing import pack
from cohortmill.llm.queries import TARGETS, TOKENIZER


def language(spark, docs, sf_dir):
    """Documents whose language cannot be told (no text, no letters) go."""
    return keep_identified(docs)


def exact_copies(spark, docs, sf_dir):
    """Of equal texts the one with the largest doc_id stays."""
    return without_copies(docs)


def near_copies(spark, docs, sf_dir):
    """Of each group of near copies (five-word shingles, similarity 0.8) the one with the smallest doc_id stays."""
    return without_near_copies(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents are repeated or left out by their rates, towards TARGETS of the domains."""
    return mixed(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"), TARGETS)


def packed(spark, docs, sf_dir):
    """Sequences of at most 4096 tokens; one row per piece."""
    return pack(docs, TOKENIZER)


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mix_sources", mix_sources), ("packing", packed)]
ORACLE_SQL = None


def run(spark, sf_dir):
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
