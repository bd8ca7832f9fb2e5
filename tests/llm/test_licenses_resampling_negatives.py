"""Licence scans, importance resampling and hard negatives against plain recomputation."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlake.llm import gnat, importance, licenses, negatives
from airlake.llm.license_rules import rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_scan(text):
    """Every rule over every text, every pair of detections compared."""
    words = WORD.findall(lowered(text))
    joined = " " + " ".join(words) + " "
    base = [
        (i, label)
        for phrase, label in licenses.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    found = []
    for n, r in enumerate(rules()):
        for m in re.finditer(r.pattern.pattern.decode(), joined, re.ASCII):
            found.append((joined[: m.start()].count(" "), joined[: m.end()].count(" "), n, r))
    kept = []
    for a in found:
        inside = False
        for b in found:
            wider = (b[0], b[1]) != (a[0], a[1]) or (-b[3].priority, b[2]) < (-a[3].priority, a[2])
            inside |= b is not a and b[0] <= a[0] and a[1] <= b[1] and b[3].priority >= a[3].priority and wider
        if not inside:
            kept.append(a)
    labels = {label for _, label in base}
    score = max([0.9 if base else 0.0, *[k[3].confidence for k in kept]])
    return (
        len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {k[3].label for k in kept})), score,
    )


NOTICES = [
    "Released under the MIT License. " * 3 + "Not under the MIT licence.",
    "// SPDX-License-Identifier: GPL-3.0-or-later\n/* This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version. */",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Licensed under CC BY-NC 4.0. See also CC BY-NC-SA 4.0 and cc-by-nc",
    "Redistribution and use in source and binary forms, with or without modification, are permitted. Neither the name of the X nor "
    "the names of its contributors may be used to endorse or promote products derived from this software. All rights reserved.",
    "Ich fahre mit dem Zug und mit Lizenz; das MIT ist weit.",
    "permission is hereby granted, FREE of charge, to any person obtaining a copy of this software and associated documentation files",
    "Tous droits réservés — under the mit license\x0bapache-license_version2 apache license version 2",
]


def digested(df):
    cols = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return licenses.digest(licenses.scan(df)).select("row", *cols)


def test_licenses_equal_all_rules_run_plainly(spark, documents):
    more = spark.createDataFrame([(10**6 + n, t) for n, t in enumerate(NOTICES)], "doc_id long, text string")
    some = documents.where((F.col("doc_id") % 5 == 0) | F.lower("text").rlike("licen[cs]e|rights"))
    both = some.select("doc_id", "text").unionByName(more)
    got = {r.row.doc_id: tuple(r)[1:] for r in digested(both).collect()}
    texts = {r.doc_id: r.text for r in both.collect()}
    assert len(got) == len(texts)
    licensed = 0
    for doc_id, text in texts.items():
        want = plain_scan(text)
        assert got[doc_id] == want, doc_id
        licensed += bool(want[5])
    assert licensed > len(NOTICES) - 2


def test_rules_are_many_and_their_prefilter_loses_nothing():
    every = rules()
    assert len(every) > 300
    # the keywords of a rule stand in whatever it matches: an example of each name, spelled out
    scanner = licenses.Scanner(every)
    for text in NOTICES:
        words = importance.words_of(text)
        joined = b" ".join([b"", *words, b""])
        able = set(scanner.candidates(words))
        assert {n for n, r in enumerate(every) if r.pattern.search(joined)} <= able


def test_licenses_take_awkward_and_very_long_texts(spark, awkward):
    got = digested(awkward).collect()
    assert len(got) == 10
    long = "GNU General Public License version 3 under the MIT License " * 40_000
    df = spark.createDataFrame([(1, long)], "doc_id long, text string")
    r = digested(df).first()
    assert (r.n_base, r.first_word, r.last_word) == (40_000, 6, 40_000 * 10 - 4) and r.labels == "gpl-3,mit"
    assert digested(df.limit(0)).count() == 0


def plain_draw(docs, aims, plan):
    feats = {d: [zlib.crc32(w.encode()) % plan.buckets for w in WORD.findall(lowered(t))] for d, t in docs}
    s = Counter(b for x in feats.values() for b in x)
    t = Counter(zlib.crc32(w.encode()) % plan.buckets for x in aims for w in WORD.findall(lowered(x)))
    S, T = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + plan.buckets) / ((s[b] + 1) * (T + plan.buckets))))
    rows = {}
    for d, x in feats.items():
        weight = sum(map(gain, x)) // len(x) if x else 0
        h = int(hashlib.sha256(f"{plan.seed}:{d}".encode()).hexdigest()[:8], 16)
        rows[d] = (len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))))
    order = sorted((d for d in rows if rows[d][0] >= plan.least_words), key=lambda d: (-rows[d][2], d))
    drawn = {d: n + 1 for n, d in enumerate(order[: len(order) * plan.percent // 100])}
    return {d: (*r, drawn.get(d)) for d, r in rows.items()}


def test_resampling_equals_plain_recomputation(spark, documents):
    aims = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = importance.Resampling()
    got = importance.resample(documents, aims, plan).collect()
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = plain_draw(docs, [r.text for r in aims.select("text").collect()], plan)
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got} == want
    assert sum(r["rank"] is not None for r in got) == len([1 for x in want.values() if x[0] >= 20]) // 10


def test_resampling_prefers_the_target(spark):
    docs = [(n, " ".join(["wanted" if n % 10 == 0 else "plain"] * 30)) for n in range(1000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    aims = spark.createDataFrame([("wanted words " * 50,)], "text string")
    got = importance.resample(df, aims).where("rank IS NOT NULL").select("doc_id").collect()
    assert len(got) == 100 and sum(r.doc_id % 10 == 0 for r in got) > 90


def test_resampling_takes_awkward_and_empty_tables(spark, awkward):
    aims = spark.createDataFrame([(None,), ("",), ("the cat",)], "text string")
    got = importance.resample(awkward, aims).collect()
    assert len(got) == 10 and all(r.score is not None for r in got)
    assert [r.n_features for r in got if r.row.doc_id == 4] == [20_000]
    assert importance.resample(awkward.limit(0), aims).count() == 0
    assert importance.resample(awkward, aims.limit(0)).count() == 10
    pairs = importance.resample(awkward, aims, importance.Resampling(longest=2)).where("n_words > 0")
    assert pairs.where("n_features <> 2 * n_words - 1").count() == 0


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_radix_ranks_equal_a_sort(spark, hot):
    rng = random.Random(3)
    data = [(n, 7 if rng.random() < hot else rng.randint(-500, 70_000), rng.choice([None, *range(2000)])) for n in range(3000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "n long, a long, b long").repartition(5)
    df = df.withColumn("uid", F.monotonically_increasing_id())
    df.persist()
    places = importance.radix_ranks(df.select("uid", "a", "b"), ["a", "b"], bits=5, block=64)
    got = df.join(places, "uid").select("pos", "a", "b").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(3000))
    key = lambda x: (x[0], x[1] is None, x[1] or 0)
    assert [(r.a, r.b) for r in got] == sorted(((a, b) for _, a, b in data), key=key)
    df.unpersist()


def test_radix_ranks_of_widely_spread_keys(spark):
    data = [(n, v) for n, v in enumerate([-(2**40), 2**40, 0, None, -1, 5, 5])]
    df = spark.createDataFrame(data, "uid long, a long")
    got = importance.radix_ranks(df, ["a"]).join(df, "uid").orderBy("pos").collect()
    assert [r.a for r in got] == [-(2**40), -1, 0, 5, 5, 2**40, None]


def plain_negatives(rows, anchors, m=negatives.Mining()):
    out = {}
    for a, la, va in rows:
        if not anchors(a):
            continue
        ranked = sorted((-int(va @ v), i, lab) for i, lab, v in rows if i != a)
        for s, p, _ in [x for x in ranked if x[2] == la][: m.positives]:
            fit = [(i, -t) for t, i, lab in ranked if lab != la and m.least * -s <= 100 * -t <= m.most * -s]
            for n, (i, t) in enumerate(fit[: m.negatives]):
                out[a, p, n + 1] = (i, -s, t)
    return out


def vectors(spark, data):
    return spark.createDataFrame([(i, [float(x) for x in v], lab) for i, v, lab in data], "vec_id long, embedding array<float>, label int")


def test_hard_negatives_equal_an_exhaustive_search(spark, monkeypatch):
    """Clusters, a vector that a third of the rows share under several labels, ties, leaves and packs of a few rows."""
    monkeypatch.setattr(gnat, "LEAF", 20)
    monkeypatch.setattr(gnat, "BLOCK", 16)
    monkeypatch.setattr(gnat, "PACK", 7)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6))
    data = []
    for n in range(900):
        c = rng.integers(12)
        v = centres[c] + 0.2 * rng.normal(size=6) if n % 3 else centres[0]
        data.append((n, np.round(v, 2), int(c % 4 if rng.random() < 0.7 else rng.integers(4))))
    usable = negatives.usable(vectors(spark, data))
    got = negatives.mine(usable, F.col("vec_id") % 7 == 0).collect()
    assert len(got) == len({(r.anchor_id, r.positive_id, r["rank"]) for r in got})
    rows = [(i, lab, np.floor(256 * np.float32(v).astype(float)).astype(np.int64)) for i, v, lab in data]
    want = plain_negatives(rows, lambda a: a % 7 == 0)
    assert len(want) > 500
    assert {(r.anchor_id, r.positive_id, r["rank"]): (r.negative_id, r.positive_score, r.negative_score) for r in got} == want


def test_the_tree_passes_over_subtrees_and_loses_nothing():
    rng = np.random.default_rng(9)
    centres = 40 * rng.normal(size=(30, 8))
    rows = np.rint(centres[rng.integers(30, size=3000)] + rng.normal(size=(3000, 8)))
    length2 = float((rows * rows).sum(axis=1).max())
    tree = gnat.fit(np.unique(rows[:1000], axis=0), length2, 60, degree=6)
    for node in tree.nodes:
        m = len(node.points)
        node.low, node.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
    seen = []
    leaf = gnat.descend(tree, rows, seen)
    for number, j, least, most in seen:
        node = tree.nodes[number]
        node.low[:, j], node.high[:, j] = np.minimum(node.low[:, j], least), np.maximum(node.high[:, j], most)
    asked = rows[:50]
    scores = asked @ rows.T
    high = np.sort(scores, axis=1)[:, -40][:, None]
    low = np.sort(scores, axis=1)[:, -60][:, None]
    visited = np.zeros((50, leaf.max() + 1), bool)
    for n, which in gnat.reached(tree, asked, low, high):
        visited[which, n] = True
    for q in range(50):
        assert visited[q][np.unique(leaf[(scores[q] >= low[q]) & (scores[q] <= high[q])])].all()
    assert visited.mean() < 0.35
    assert not list(gnat.reached(tree, asked, high + 1, high))


def test_hard_negatives_skip_what_takes_no_part(spark):
    data = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.8, 0.0], 2), (3, None, 2), (4, [float("nan"), 1.0], 2), (5, [None, 1.0], 2),
            (6, [float("inf"), 1.0], 2), (None, [0.8, 0.0], 2), (7, [0.8, 0.0], None), (2, [0.8, 0.0], 2), (8, [], 2), (9, [0.7], 2),
            (10, [0.8, 0.0], 2)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("vector", F.lit("clash"))
    got = negatives.mine(negatives.usable(df), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.positive_id, r["rank"], r.negative_id) for r in got] == [(1, 1, 2), (1, 2, 10), (1, 3, 9)]
    assert negatives.mine(negatives.usable(df.limit(0)), F.col("vec_id") == 0).count() == 0
    assert negatives.mine(negatives.usable(df), F.col("vec_id") == 77).count() == 0


def test_very_large_components_do_not_crash(spark):
    data = [(n, [1e30 * (-1) ** n, float(n)], n % 2) for n in range(6)] + [(n, [1e5, float(n)], n % 2) for n in range(6, 12)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    assert negatives.mine(negatives.usable(df), F.col("vec_id") % 2 == 0).count() >= 0
