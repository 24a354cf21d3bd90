"""Periodic runs, ranked search and quality scores, near copies of awkward rows, and stages on awkward tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortmill.llm import quality, runs, search as lexical
from cohortmill.llm.exact_dedup import without_copies
from cohortmill.llm.language import keep_identified
from cohortmill.llm.minhash_dedup import near_duplicates, without_near_copies
from cohortmill.llm.mixing import mixed
from cohortmill.llm.queries import QUERIES
from cohortmill.llm.substring_dedup import remove_repeats
from cohortmill.llm.textcodes import word_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def plain_runs(words, least=24, times=3):
    out, n = set(), len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q) and not any(
                    all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.add((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_agree_with_brute_force_in_the_trees():
    rng = np.random.default_rng(1)
    for trial in range(400):
        n, letters = int(rng.integers(1, 70)), int(rng.integers(1, 4))
        w = rng.integers(1, letters + 1, n)
        if trial % 2:
            p, a = int(rng.integers(1, 8)), int(rng.integers(0, n))
            w = np.array([w[i] if i < a else w[a + (i - a) % p if a + p <= n else i] for i in range(n)])
        least, times = ((4, 2), (6, 3), (24, 3))[trial % 3]
        assert [tuple(r) for r in runs.runs_of(w, least, times).tolist()] == plain_runs(w.tolist(), least, times)


@pytest.fixture(scope="module")
def awkward(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(40)]
    period = [base[i % 9] for i in range(200)]
    texts = [
        None, "", " \t\n", "one", " ".join(["a"] * 23), " ".join(["a"] * 24), " ".join(period), " ".join([*base, *period[:60], "x", *period[:27], "　", *["b"] * 30]),
        " ".join(rng.choice(base, 500)), " ".join([*["l1 l2 l3"] * 9, "z", *["l1 l2 l3"] * 8]), " ".join(base[i % 20] for i in range(20_000)), " ".join(["a"] * 24),
    ]
    return spark.createDataFrame([(None if i == 3 else i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, runs string")


def test_runs_of_awkward_rows(spark, awkward):
    got = {r.doc_id: r for r in runs.find_runs(awkward).withColumn("best", runs.longest(F.col("runs"))).collect()}
    for r in awkward.collect():
        words = WORD.findall(r.text or "")
        found = plain_runs(words) if len(words) < 5000 else [(0, len(words), 20)]
        assert [tuple(x) for x in got[r.doc_id].runs] == found
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        assert got[r.doc_id].text == " ".join(w for i, w in enumerate(words) if i not in gone)
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert (got[r.doc_id].best and tuple(got[r.doc_id].best)) == best
    assert runs.find_runs(awkward.limit(0)).count() == 0


def test_runs_query(spark):
    got = {r.doc_id: r for r in QUERIES["op11_runs"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        words = WORD.findall(d.text or "")
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 600:
            continue
        found = plain_runs(words)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        row = got[d.doc_id]
        assert row.n_runs == len(found)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert (row.start, row.length, row.period, row.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_search(docs, queries, top):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = {}
    wanted = {}
    for item, text in queries:
        wanted.setdefault(item, set()).update(terms(text))
    for item, own in wanted.items():
        scores = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if score > 0:
                scores.append((-score, -1 if i is None else i))
        for rank, (score, i) in enumerate(sorted(scores)[:top], 1):
            out[item, rank] = (None if i < 0 else i, -score)
    return out


def test_search_agrees_with_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = [f"t{k}" for k in range(300)] + ["Été", "Ünder", "naïve"]
    weight = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, int(rng.integers(1, 80)), p=weight / weight.sum())) for _ in range(300)]
    texts += [None, "", "!!! ...", texts[7], texts[7], texts[7].upper(), "t1 " * 4000, " ".join(rng.choice(words, 9000)), "T1-t2_t3"]
    ids = [None if i in (20, 21) else i // 2 if 40 < i < 60 else i for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in zip(ids, texts)], "doc_id long, text string, item string, score int")
    asked = [(k, " ".join(rng.choice(words, 12))) for k in range(15)] + [(None, "t1 t2"), (None, "t200"), (77, None), (78, "-- !"), (79, "absent"), (80, texts[7]), (3, "t250")]
    queries = spark.createDataFrame(asked, "item_id long, text string")
    for block in (1 << 17, 40):
        monkeypatch.setattr(lexical, "ITEM_TERMS", block)
        got = {(r.item_id, r.rank): (r.doc_id, r.score) for r in lexical.search(docs, queries, top=10).collect()}
        assert got == plain_search(zip(ids, texts), asked, 10)
    monkeypatch.setattr(lexical, "PAIRS", 0)
    got = {(r.item_id, r.rank): (r.doc_id, r.score) for r in lexical.search(docs, queries, top=10).collect()}
    assert got == plain_search(zip(ids, texts), asked, 10)
    assert lexical.search(docs.limit(0), queries).count() == 0 and lexical.search(docs, queries.limit(0)).count() == 0


def test_upper_bounds_hold():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"t{k}" for k in rng.integers(0, 200, int(rng.integers(1, 400)))).encode() for _ in range(200)]
    codes, bounds = lexical.term_codes([f"t{k}".encode() for k in range(60)])
    items = lexical.Items(codes, np.arange(60) % 4, 4)
    items.weigh(np.full(len(items.codes), 20.0), 200, sum(len(t.split()) for t in texts))
    blocks = lexical._Blocks()
    import pyarrow as pa
    list(blocks.add(pa.array(range(200)), np.arange(200), texts))
    seen = 0
    for width in list(blocks.waiting):
        _, ids, _, lengths, slices = blocks.take(width)
        upper = items.bounds(width, np.asarray(lengths), np.frombuffer(slices, np.uint8).reshape(width, -1))
        for column, i in enumerate(ids):
            seen += 1
            own, term, often, length = items.found([texts[i]])
            value = 1_000_000_000 * often // (1000 * often + 20 * items.measure(length)[own]) * items.weights[term]
            full = np.zeros(len(items.codes), np.int64)
            full[term] = value
            assert all(upper[k, column] >= full[items.terms[k]].sum() for k in range(4))
    assert seen == 200


def test_quality_is_right_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels)
    rows = got.where("held_out").join(labels.where("quality IS NOT NULL"), "doc_id").toPandas()
    assert len(rows) > 500 and (rows["predicted"] == rows["quality"]).mean() > 0.98
    assert got.count() == docs.count() and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_quality_of_awkward_tables(spark):
    texts = [None, "", " \n", "word " * 3000, "x", "ÄÖ", "a\x00b", "one two. three"]
    docs = spark.createDataFrame([(None if i == 7 else i, t, "en", 0.5, True) for i, t in enumerate(texts)] * 2, "doc_id long, text string, lang string, score double, held_out boolean")
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.classify(docs, empty).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(8)] + [(None, 0), (3, None), (4, 9)], "doc_id long, quality int")
    scores = quality.classify(docs, one).collect()
    assert len(scores) == 16 and all(0 <= r.score <= 1 for r in scores)
    by_text = {}
    for r, t in zip(quality.classify(docs, one).orderBy("doc_id").collect(), docs.orderBy("doc_id").collect()):
        by_text.setdefault(t.text or "", set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert quality.classify(docs.limit(0), one).count() == 0


def test_statistics_do_not_depend_on_neighbours():
    texts = [b"", b"One two, two.\nOne two, two.\n\nTHREE!!", "Äpfel und Öl".encode(), b"   ", b"a a a a a a a a"]
    whole = quality.statistics(texts)
    assert (whole[0] == 0).all() and not np.isnan(whole).any()
    for k, t in enumerate(texts):
        assert quality.statistics([t])[0] == pytest.approx(whole[k])
    assert list(quality.isotonic(np.arange(4.0), np.array([0, 2, 1, 3.0]), np.array([2, 2, 2, 3.0]))[1]) == [0, 0.75, 1]


def test_near_copies_without_ids_and_with_repeated_ids(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(100)) for k in "abc")
    rows = [(1, a), (1, None), (2, a + " x"), (None, b), (None, c), (3, c + " y"), (4, b + " z"), (None, None), (9, ""), (9, c + " q"), (9, "short one"), (10, "short one")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, `a.b` int, __kept_id int")
    got = {}
    for r in near_duplicates(docs).collect():
        got.setdefault((r.doc_id, r.n_shingles), set()).add((r.component_id, r.kept))
    assert got[1, 96] == {(1, True)} and got[2, 97] == {(1, False)} and got[1, 0] == {(1, True)}
    assert got[None, 96] == {(None, True)} and got[3, 97] == {(None, False)} and got[4, 97] == {(None, False)} and got[9, 97] == {(None, False)}
    assert got[9, 1] == {(9, True)} and got[10, 1] == {(9, False)} and got[9, 0] == {(9, True)}
    left = without_near_copies(docs)
    assert left.columns == docs.columns and sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted(
        (i or 0, t or "") for i, t in rows if (i, t) not in ((2, a + " x"), (3, c + " y"), (4, b + " z"), (9, c + " q"), (10, "short one")))


def test_long_words_that_a_polynomial_confuses(spark):
    def folded(n, first):
        return "".join("ab"[(bin(i).count("1") + first) % 2] for i in range(n))

    one, two = folded(1024, 0), folded(1024, 1)
    codes, _ = word_codes([one.encode(), two.encode(), one.encode()])
    assert codes[0] == codes[2] != codes[1]
    rest = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{two} {rest}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()} == {1: 0, 2: 25}
    alone = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(alone).collect()} == {1: 1, 2: 2, 3: 1}


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, __row string, __text string, __p string, kept boolean"


@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_columns_of_awkward_tables(spark, empty):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = [None, "", "eins zwei drei vier fünf sechs", "eins zwei drei vier fünf sechs", long, long + " x", "one two three four five six", "123", "one two three four five six"]
    ids = [0, 1, 2, 2, 4, None, None, 7, 8]
    rows = [] if empty else [(i, t, "de" if k % 2 else None, None, None, "dot", "row", "text", "p", True) for k, (i, t) in enumerate(zip(ids, texts))]
    docs = spark.createDataFrame(rows, AWKWARD)
    labels = spark.createDataFrame([(0, 1, 0), (2, 0, 0), (4, 1, 0), (8, 0, 1), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    told = keep_identified(docs)
    assert told.columns == docs.columns
    assert sorted((r.text for r in told.collect()), key=str) == ([] if empty else sorted(t for t in texts if t and re.search("[a-zäöü]", t)))
    single = without_copies(told)
    assert single.columns == docs.columns and single.count() == (0 if empty else 4)
    apart = without_near_copies(single)
    assert apart.columns == docs.columns and apart.count() == (0 if empty else 3)
    mix = mixed(apart, labels, {"good": 0.5, "poor": 0.3, "toxic": 0.2})
    assert mix.columns == docs.columns and {r["a.b"] for r in mix.collect()} <= {"dot"} and mix.count() >= 0
    assert corpus_pipeline.STAGES[-1][1](spark, mix, FOLDER).count() >= mix.count()
