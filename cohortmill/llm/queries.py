"""One registered query per operator, with the SQL it must agree with where SQL can express it."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, language, licences, mixing, packing, pii, quality, runs
from .exact_dedup import exact_dedup
from .minhash_dedup import near_duplicates
from .search import search
from .substring_dedup import remove_repeats
from .vector_dedup import near_vectors

TARGETS = {"good": 0.75, "poor": 0.2, "toxic": 0.05}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def op1_pii(spark, folder):
    found = pii.find_personal_data(_read(spark, folder, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
                        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.concat("base", "added")).alias("spans"))


def op2_mixing(spark, folder):
    return mixing.mix(_read(spark, folder, "documents"), _read(spark, folder, "labels"), TARGETS)


def op3_exact_dedup(spark, folder):
    return exact_dedup(_read(spark, folder, "documents"))


def op4_substring_dedup(spark, folder):
    out = remove_repeats(_read(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_language(spark, folder):
    return language.identify(_read(spark, folder, "documents"))


def op6_licences(spark, folder):
    return licences.scan(_read(spark, folder, "documents")).select("doc_id", "licences", "n_licences")


def op7_vectors(spark, folder):
    return near_vectors(_read(spark, folder, "embeddings"))


def op8_minhash(spark, folder):
    return near_duplicates(_read(spark, folder, "documents"), width=2)


def op9_chat(spark, folder):
    return chat.format_chats(_read(spark, folder, "conversations")).select("conv_id", "n_turns", "n_copies", "part", F.sha2("text", 256).alias("text_sha256"), "text")


def op10_packing(spark, folder):
    return packing.pack(_read(spark, folder, "documents"), TOKENIZER)


def op11_runs(spark, folder):
    found = runs.find_runs(runs.with_planted_runs(_read(spark, folder, "documents"))).withColumn("best", runs.longest(F.col("runs")))
    best = [F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


def op12_search(spark, folder):
    return search(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op13_quality(spark, folder):
    return quality.classify(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def pipeline(spark, folder):
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (op1_pii, op2_mixing, op3_exact_dedup, op4_substring_dedup, op5_language, op6_licences, op7_vectors, op8_minhash, op9_chat, op10_packing, op11_runs, op12_search, op13_quality, pipeline)}

TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL = {
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "op4_substring_dedup": r"""
        WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) AS h FROM w, unnest(range(1, len(words) - 18)) AS u(i)),
        r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM s) WHERE k > 1),
        c AS (SELECT doc_id, list(DISTINCT j) AS gone FROM r, unnest(range(i, i + 20)) AS u(j) GROUP BY doc_id),
        p AS (SELECT w.doc_id, words, coalesce(gone, []) AS gone FROM w LEFT JOIN c USING (doc_id)),
        e AS (SELECT doc_id, u.i AS i, words[u.i] AS word FROM p, unnest(range(1, len(words) + 1)) AS u(i)),
        k AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS kept
              FROM e ANTI JOIN (SELECT doc_id, unnest(gone) AS i FROM c) g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
        SELECT p.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM p LEFT JOIN k USING (doc_id)""",
    "op9_chat": r"""
        WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        p AS (SELECT conv_id, row_number() OVER w AS n, string_agg(turn || ':' || role || ':' || length(text) || ':' || text, '|') OVER w AS code, count(*) OVER (PARTITION BY conv_id) AS n_turns
              FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)),
        e AS (SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies, code FROM p WHERE n = n_turns GROUP BY n_turns, code),
        m AS (SELECT * FROM e ANTI JOIN (SELECT DISTINCT code FROM p WHERE n < n_turns) i USING (code)),
        r AS (SELECT conv_id, any_value(n_turns) AS n_turns, any_value(n_copies) AS n_copies, CAST(0 AS BIGINT) AS part,
                     string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS text
              FROM m JOIN t USING (conv_id) GROUP BY conv_id)
        SELECT conv_id, n_turns, n_copies, part, sha256(text) AS text_sha256, text FROM r""",
    "op12_search": r"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, unnest(TERMS) AS term FROM documents),
        c AS MATERIALIZED (SELECT k, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM d GROUP BY k, term),
        s AS MATERIALIZED (SELECT k, CAST(sum(tf) AS BIGINT) AS n FROM c GROUP BY k),
        t AS (SELECT count(*) AS N_, CAST(sum(n) AS BIGINT) AS L_ FROM s),
        q AS MATERIALIZED (SELECT DISTINCT item_id, unnest(TERMS) AS term FROM benchmark),
        f AS (SELECT term, count(*) AS df FROM c GROUP BY term),
        w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * N_ + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w FROM f, t),
        r AS (SELECT item_id, doc_id, k, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * N_) // L_)))) AS BIGINT) AS score
              FROM q JOIN c USING (term) JOIN s USING (k) JOIN w USING (term), t GROUP BY ALL),
        p AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0)
        SELECT * FROM p WHERE rank <= 50""".replace("TERMS", TERMS),
}
