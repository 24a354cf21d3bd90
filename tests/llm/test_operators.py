"""Each operator on small tables with awkward rows, against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmill.llm import chat, language, licences, mixing, packing, pii
from cohortmill.llm.common import Scratch, components
from cohortmill.llm.exact_dedup import exact_dedup, without_copies
from cohortmill.llm.minhash_dedup import near_duplicates
from cohortmill.llm.queries import TOKENIZER
from cohortmill.llm.substring_dedup import remove_repeats
from cohortmill.llm.vector_dedup import near_vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, id string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def docs(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, None, None, None, "x", "y") for i, t in zip(ids, texts)], DOCS)


def prose(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


LONG = prose(99, 60_000)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (30, 30), *[(100, k) for k in range(101, 200)]]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect())
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20, **{k: 100 for k in range(100, 200)}}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


@pytest.mark.parametrize("digest", [None, lambda t: F.lit("same")])
def test_exact_dedup(spark, digest):
    texts = ["a", "a", None, "", "b", "a ", LONG, LONG, *["hot"] * 60]
    got = {r.doc_id: r for r in exact_dedup(docs(spark, texts), digest=digest).collect()}
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if (u or "") == (t or "")]
        assert got[i][1:] == (max(same), len(same), i == max(same), hashlib.sha256((t or "").encode()).hexdigest())


def test_exact_dedup_repeated_rows_and_null_ids(spark):
    table = docs(spark, ["a", "a", "a", "b"], [1, 1, None, None])
    got = sorted(exact_dedup(table).select("doc_id", "keep_id", "group_size", "kept").collect(), key=str)
    assert [tuple(r) for r in got] == [(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True)]
    assert sorted(r.text for r in without_copies(table).collect()) == ["a", "b"]


def plain_removal(rows, window):
    seen, out = set(), {}
    for i, t in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = set()
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        out[i] = " ".join(w for k, w in enumerate(words) if k not in gone), len(words), len(gone)
    return out


def test_substring_dedup(spark):
    shared = prose(1, 40)
    texts = [None, "", " \t\n", "one two", shared, f"{prose(2, 30)} {shared} {prose(3, 5)}", "a " * 70, " " + shared.replace(" ", "\n"), LONG, LONG[500:], *[f"{shared} {k}" for k in range(30)]]
    got = {r.doc_id: (r.text, r.n_words, r.n_removed) for r in remove_repeats(docs(spark, texts)).collect()}
    assert got == plain_removal(enumerate(texts), 20)
    # a sketch that is far too small prunes less and changes nothing
    small = {r.doc_id: (r.text, r.n_words, r.n_removed) for r in remove_repeats(docs(spark, texts), most_counters=1 << 16).collect()}
    assert small == got


def test_substring_dedup_repeated_row_keeps_its_first_words(spark):
    text = prose(4, 25)
    got = remove_repeats(docs(spark, [text, text, text], [5, 5, 6])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(5, 0), (5, 0), (6, 25)]


def test_minhash(spark):
    base = prose(5, 200).split()
    near = [" ".join(base[:k] + ["new"] + base[k + 1:]) for k in (10, 60, 110, 160)]
    far = " ".join(base[:100]) + " " + prose(6, 100)
    texts = [None, "", "One", "one", "one two", " ".join(base), *near, " ".join(base).upper(), far, prose(7, 200), LONG, *[" ".join(base + [str(k)]) for k in range(40)]]
    got = {r.doc_id: r for r in near_duplicates(docs(spark, texts), width=2).collect()}
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append(set(zip(words, words[1:])) if len(words) > 1 else {tuple(words)} if words else set())
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(s), root[i], root[i] == i) for i, s in enumerate(sets)}


def test_vectors(spark):
    draw = np.random.default_rng(3)
    v = draw.standard_normal((400, 16))
    v[50:120] = v[50] + 0.25 * draw.standard_normal((70, 16))
    v[200] = v[201] = v[202]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    odd = [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [1.0, None] * 8), (504, []), (505, [float("inf")] * 16), (506, [1.0])]
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("key", F.lit(1))).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    found = sum(got[i].n_links for i in range(400))
    assert found >= 0.9 * (link.sum() - 400)
    assert all(got[i].n_links <= link[i].sum() - 1 for i in range(400))
    assert {got[i].component_id for i in (200, 201, 202)} == {200}
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in odd)


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else 0,
                  "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_personal_data(spark):
    texts = [None, "", "a@b.c_d@e.f x@y", "é😀 mail me: joe.x+1@a-b.example.com, or 1.2.3.4.5.6.7.8", "0001.2.3.256 1.2.3.0255 99999999999.1.1.1",
             "card 4111 1111-1111 1111 and 4111111111111112", "+1 (974) 555-3436 +123 +49.30.123456789012345678", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0" * 3,
             "a" * 50_000 + "@", "1" * 30_000, "+" + " " * 30_000, "x.y@" * 5_000, "joe [at] example.com", "1.2.3.4 " * 3_000]
    table = docs(spark, texts + [f"host 10.0.{k}.7 pay 4111111111111111 of {k}@mail.example" for k in range(40)])
    got = {r.doc_id: r for r in pii.find_personal_data(table).select("doc_id", pii.joined(F.col("base")).alias("base"), pii.joined(F.concat("base", "added")).alias("all")).collect()}
    for i, t in enumerate(texts):
        assert got[i].base == plain_spans(t), t[:40]
        assert set(filter(None, got[i].base.split(","))) <= set(got[i]["all"].split(","))


def test_language(spark):
    rows = [(i, " ".join(np.random.default_rng(i).choice(w, 30)), lang, "x") for i, (lang, w) in enumerate(
        [("xx", ["banana", "nana", "anab"]), ("yy", ["kortz", "ortzk", "zzork"])] * 30)]
    odd = [(100, None, "xx", "x"), (101, "123 !!", "yy", "x"), (102, "", None, "x"), (None, "banana", None, "x"), (103, "banana " * 400_000, None, "x")]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang, _ in rows)
    assert [got[i].lang_pred for i in (100, 101, 102, None, 103)] == ["und", "und", "und", "xx", "xx"]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(60))
    unlearned = language.identify(docs(spark, ["banana", None])).collect()
    assert [(r.lang_pred, r.score) for r in unlearned] == [("und", 0.0)] * 2


def test_packing(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    texts = [None, "", "Hello, World. it's 12\x1cb", "Größe É. ★ a★b <|endoftext|>x", LONG, *[prose(k, k * 7 % 300) for k in range(60)], "tie", "tie"]
    out = packing.pack(docs(spark, texts), TOKENIZER, with_ids=True).toPandas()
    want = {}
    for i, t in enumerate(texts):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        want |= {(i, k // 4096): (k, ids[k:k + 4096]) for k in range(0, len(ids), 4096)}
    assert {(r.doc_id, r.piece): (r.start, list(r.ids)) for r in out.itertuples()} == want
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in out.itertuples())
    for _, own in out.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == (own["length"].cumsum() - own["length"]).tolist() and own["length"].sum() <= 4096


def test_plan_is_best_fit_decreasing():
    draw = np.random.default_rng(0)
    for _ in range(100):
        limit = int(draw.integers(5, 70))
        counts = {int(n): int(draw.integers(1, 20)) for n in draw.choice(np.arange(1, limit + 1), min(limit, 6), replace=False)}
        bins = []
        for n in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):
            fit = [i for i, left in enumerate(bins) if left >= n]
            if fit:
                bins[min(fit, key=lambda i: bins[i])] -= n
            else:
                bins.append(limit - n)
        made, fill = packing.plan(counts, limit), {}
        for n, own in made.groupby("length"):
            starts = [*own.sort_values("rank")["rank"], counts[n]]
            for row, stop in zip(own.sort_values("rank").itertuples(), starts[1:]):
                for r in range(row.rank, stop):
                    b = row.bin + (r - row.rank) // row.each
                    fill[b] = fill.get(b, 0) + n
        assert len(fill) == len(bins) and max(fill.values()) <= limit


def test_mixing_meets_targets_and_stays_non_negative(spark):
    draw = np.random.default_rng(1)
    p = draw.dirichlet([0.3, 0.3, 0.3], 500)
    held = spark.createDataFrame([(int(t), [float(x) for x in row]) for t, row in zip(draw.integers(0, 3000, 500), p)], "tokens long, p array<double>")
    for targets in ({"good": 0.8, "poor": 0.15, "toxic": 0.05}, {"good": 1.0}):
        steps, shares = mixing.fit_rates(held, targets)
        rates = [r[0] for r in held.select(mixing.rate(F.col("p"), steps)).collect()]
        assert min(rates) >= 0 and len(steps) <= 60
        if len(targets) == 3:
            assert np.allclose(shares, [0.8, 0.15, 0.05], atol=1e-3)
        else:  # unreachable: no document is wholly good; nearer than without rates
            assert shares[0] > 0.5
    assert mixing.fit_rates(held.limit(0), {"good": 1.0}) == ([], [0.0, 0.0, 0.0])


def test_mixing_awkward_rows(spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = mixing.mix(docs(spark, ["fine words here", "bad bad", None, "", "fine words"]), labels, {"good": 0.6, "toxic": 0.4}).collect()
    assert len(got) == 5 and all(abs(r.p_good + r.p_poor + r.p_toxic - 1) < 1e-9 and r.rate >= 0 for r in got)
    assert [r.tokens for r in sorted(got, key=lambda r: r.doc_id)] == [3, 2, 0, 0, 2]
    assert mixing.mix(docs(spark, []), labels, {"good": 1.0}).count() == 0


def test_licences(spark):
    texts = [None, "", prose(1, 300), "Released under the MIT License.", f"{prose(2, 80)}\nLicensed under CC BY-NC 4.0.\n{prose(3, 80)}",
             "This work is licensed under the GNU General Public License, version 3.", "the license is lost", *[prose(k, 60) for k in range(10, 60)]]
    got = {r.doc_id: r for r in licences.scan(docs(spark, texts)).collect()}
    assert [got[i].licences for i in range(7)] == ["", "", "", "MIT", "CC-BY-NC-4.0", "GPL-3.0", ""]
    assert got[4].found[0].line == 1 and all(got[i].n_licences == 0 for i in range(7, len(texts)))


def test_chat_keeps_maximal_conversations(spark):
    long = [("user", "hi"), ("assistant", "yes"), ("user", "ok"), ("assistant", None)]
    logs = {1: long[:1], 2: long[:2], 3: long, 4: long, 5: [("user", "hi"), ("assistant", "no")], 6: [(None, "")], 7: [("user", str(k)) for k in range(3000)]}
    rows = [(c, t, r, x, "e") for c, turns in logs.items() for t, (r, x) in enumerate(turns)]
    out = chat.format_chats(spark.createDataFrame(rows + rows[:3] + [(None, 0, "user", "null id", "e")], "conv_id long, turn long, role string, text string, n string"))
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == {3, 5, 6, 7, None} and got[3].n_copies == 2 and got[3].n_turns == 4
    assert got[5].text == "<|user|>\nhi\n<|end|>\n<|assistant|>\nno\n<|end|>\n"
    assert got[7].text == "".join(f"<|user|>\n{k}\n<|end|>\n" for k in range(3000))


def test_empty_tables(spark):
    empty = docs(spark, [])
    results = [exact_dedup(empty), remove_repeats(empty), near_duplicates(empty), packing.pack(empty, TOKENIZER), language.identify(empty), licences.scan(empty), pii.find_personal_data(empty),
               near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")), chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))]
    assert [r.count() for r in results] == [0] * len(results)
