"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SMALLEST
from .textcodes import as_bytes, groups_of_texts, mix, spans, word_codes

# Short notices of licence families, as they are commonly written.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
                     "Use of this source code is governed by a BSD-style license."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
FAMILIES = tuple(TEMPLATES)
BUCKETS = 1 << 13
# Words to a paragraph at most; longer lines are cut into overlapping stretches.
LONGEST, STRIDE = 64, 32


def paragraphs(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Lines of the texts, cut where longer than LONGEST words: paragraphs, number of the text, number of the line."""
    out, owner, number = [], [], []
    for i, t in enumerate(texts):
        for k, line in enumerate(t.split(b"\n")):
            words = line.split()
            if len(words) > LONGEST:
                for at in range(0, len(words) - LONGEST + STRIDE, STRIDE):
                    out.append(b" ".join(words[at:at + LONGEST]))
                    owner.append(i)
                    number.append(k)
            elif words:
                out.append(b" ".join(words))
                owner.append(i)
                number.append(k)
    return out, np.array(owner, np.int64), np.array(number, np.int64)


def features(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of word 1- and 2-grams, lower-cased, and the number of the item each is from."""
    codes, bounds = word_codes(items, lower=True)
    owner = np.repeat(np.arange(len(items)), np.diff(bounds))
    two = spans(codes, 2)
    same = owner[1:] == owner[:-1]
    every = np.concatenate((mix(codes), two[same]))
    return (every >> np.uint64(51)).astype(np.int64), np.concatenate((owner, owner[:-1][same]))


def _sets(items: list[bytes]) -> list[set]:
    codes, bounds = word_codes(items, lower=True)
    return [set(spans(codes[a:b], min(2, b - a)).tolist()) if b > a else set() for a, b in zip(bounds[:-1], bounds[1:])]


class LicenceModel:
    """Multinomial logistic regression over FAMILIES and one class for everything else, and the threshold of certainty."""

    def __init__(self, seed: int = 5):
        self.seed, self.weights, self.bias, self.threshold = seed, np.zeros((len(FAMILIES) + 1, BUCKETS)), np.zeros(len(FAMILIES) + 1), 0.5
        self.templates = [(k, s) for k, family in enumerate(FAMILIES) for s in _sets([t.encode() for t in TEMPLATES[family]])]

    def probabilities(self, items: list[bytes]) -> np.ndarray:
        bucket, owner = features(items)
        n = np.maximum(np.bincount(owner, minlength=len(items)), 1)
        z = np.stack([np.bincount(owner, weights=w[bucket], minlength=len(items)) / np.sqrt(n) + b for w, b in zip(self.weights, self.bias)], axis=1)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def likeness(self, item: bytes, family: int) -> float:
        """The largest share of a template's word pairs that the paragraph holds."""
        own = _sets([item])[0]
        return max(len(own & s) / len(s) for k, s in self.templates if k == family)

    def fit(self, others: list[bytes], rounds: int = 120) -> "LicenceModel":
        """Learns from templates with words dropped and with neighbours from ``others``; ``others`` are the class of everything else.

        ``others`` that resemble a template are left out.  A third of all examples calibrates the threshold: the smallest
        certainty above which none of the ``others`` among them is taken for a licence.
        """
        draw = np.random.default_rng(self.seed)
        others = [o for o in others if max((len(s & own) / len(s) for own in [_sets([o])[0]] for _, s in self.templates), default=0) < 0.5]
        items, labels = list(others), [len(FAMILIES)] * len(others)
        for k, family in enumerate(FAMILIES):
            for t in TEMPLATES[family]:
                words = t.encode().split()
                for copy in range(60):
                    own = [w for w in words if copy < 20 or draw.random() > 0.08] or words
                    if copy % 3 == 2 and others:
                        own = others[draw.integers(len(others))].split()[:8] + own + others[draw.integers(len(others))].split()[:8]
                    items.append(b" ".join(own))
                    labels.append(k)
        labels = np.array(labels)
        tests = draw.random(len(items)) < 1 / 3
        learned = [items[i] for i in np.flatnonzero(~tests)]
        bucket, owner = features(learned)
        n = np.sqrt(np.maximum(np.bincount(owner, minlength=len(learned)), 1))
        truth = np.eye(len(FAMILIES) + 1)[labels[~tests]]
        share = truth.mean(axis=0)
        weight = (truth / np.maximum(share, 1e-9)).sum(axis=1, keepdims=True) / len(learned)
        squares = np.full_like(self.weights, 1e-8)
        for _ in range(rounds):
            z = np.stack([np.bincount(owner, weights=w[bucket], minlength=len(learned)) / n + b for w, b in zip(self.weights, self.bias)], axis=1)
            z = np.exp(z - z.max(axis=1, keepdims=True))
            miss = (z / z.sum(axis=1, keepdims=True) - truth) * weight
            for k in range(len(self.weights)):
                slope = np.bincount(bucket, weights=(miss[:, k] / n)[owner], minlength=BUCKETS) + 1e-5 * self.weights[k]
                squares[k] += slope * slope
                self.weights[k] -= 0.3 * slope / np.sqrt(squares[k])
            self.bias -= 0.3 * miss.sum(axis=0)
        held = [items[i] for i in np.flatnonzero(tests) if labels[i] == len(FAMILIES)]
        wrong = self.probabilities(held)[:, :-1].max(axis=1).max() if held else 0.0
        self.threshold = float(min(max(0.5, wrong), 0.9))
        return self


def fit(docs: DataFrame, other_rows: int = 2_000) -> LicenceModel:
    """Learns the class of everything else from one paragraph each of at most ``other_rows`` documents, chosen by a hash of the id.

    Only hashes low enough to hold about four times as many documents are sent to be sorted, so that tasks together send
    a bounded number of rows.  Repeated ids share a hash; with many of them fewer than ``other_rows`` may be learned from.
    """
    share = min(1.0, 4 * other_rows / max(1, docs.where("length(trim(text)) > 0").count()))
    lines = F.filter(F.split("text", "\n"), lambda s: F.length(F.trim(s)) > 0)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("length(trim(text)) > 0").withColumn("h", F.xxhash64(F.coalesce("doc_id", F.lit(SMALLEST)))).where(
        F.col("h") <= int(SMALLEST + share * (2**64 - 1)) if share < 1 else F.lit(True)).select(
        "h", F.get(lines, F.pmod("h", F.greatest(F.size(lines), F.lit(1))).cast("int")).alias("line")).dropna()
    rows = chosen.orderBy("h", "line").limit(other_rows).toPandas()
    return LicenceModel().fit([" ".join(x.split()[:LONGEST]).encode() for x in rows["line"]])


def scan(docs: DataFrame, model: LicenceModel | None = None, likeness: float = 0.6) -> DataFrame:
    """One row per document: doc_id, licences (families, comma-joined), n_licences, found.

    ``found`` lists line, family, certainty and likeness.  A paragraph is a licence of a family if the classifier is more certain
    than the calibrated threshold and a template of the family confirms it, with ``likeness`` of its word pairs
    at least; otherwise it is of the unknown class and not listed.  Null and empty texts have none.  Of the stretches of a line the most certain counts.
    """
    model = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    schema = "doc_id long, licences string, n_licences long, found array<struct<line:int,family:string,certainty:double,likeness:double>>"

    def run(batches):
        m = model.value
        for batch in batches:
            ids, texts, out = batch.column(0).to_pylist(), as_bytes(batch.column(1)), []
            for a, b in groups_of_texts(texts):
                items, owner, line = paragraphs(texts[a:b])
                best: dict[int, dict] = {}
                if items:
                    p = m.probabilities(items)[:, :-1]
                    family, certain = p.argmax(axis=1), p.max(axis=1)
                    for i in np.flatnonzero(certain >= m.threshold):
                        like = m.likeness(items[i], int(family[i]))
                        if like >= likeness:
                            key = int(line[i]), FAMILIES[family[i]]
                            new = (round(float(certain[i]), 6), round(like, 6))
                            found = best.setdefault(int(owner[i]), {})
                            found[key] = max(found.get(key, new), new)
                for k in range(b - a):
                    rows = [{"line": n, "family": f, "certainty": c, "likeness": s} for (n, f), (c, s) in sorted(best.get(k, {}).items())]
                    out.append({"doc_id": ids[a + k], "licences": ",".join(sorted({r["family"] for r in rows})), "n_licences": len(rows), "found": rows})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("doc_id", pa.int64()), ("licences", pa.string()), ("n_licences", pa.int64()),
                ("found", pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("certainty", pa.float64()), ("likeness", pa.float64())])))]))

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)
