"""Registered queries on the smallest tables, and the pipeline against what its stages must do."""

import re

import pytest

import corpus_pipeline
from cohortmill.llm.queries import QUERIES, SQL

from ..agreement import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", SQL)
def test_query_matches_sql(spark, key):
    assert compare(connect(FOLDER), QUERIES[key](spark, FOLDER), SQL[key]) is None


def test_pipeline(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, docs, kept = documents.columns, documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns, name
        kept.append(docs.toPandas())
    whole = documents.toPandas()
    assert set(kept[0]["doc_id"]) == {i for i, t in zip(whole["doc_id"], whole["text"]) if t and any(c.isalpha() for c in t)}
    last = {t: i for i, t in sorted(zip(kept[0]["doc_id"], kept[0]["text"]))}
    assert sorted(kept[1]["doc_id"]) == sorted(last.values())
    sets = {}
    for i, t in zip(kept[1]["doc_id"], kept[1]["text"]):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i, a in sets.items():
            for j, b in sets.items():
                if root[i] != root[j] and 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    assert set(kept[2]["doc_id"]) == {i for i in sets if root[i] == i}
    assert set(kept[3]["doc_id"]) <= set(kept[2]["doc_id"])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096
    assert (packed["piece"] == 0).sum() == len(kept[3])
