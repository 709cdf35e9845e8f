from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import neardup

SCHEMA = "doc_id long, text string"


def shingles(text, words):
    w = (text or "").lower().split()
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())


def brute(docs, words=5, percent=80):
    sets = [(i, shingles(t, words)) for i, t in docs]
    up = {i: i for i, _ in docs if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: root(i) for i in up}


def text_of(rng, n):
    return " ".join(f"w{rng.randrange(500)}" for _ in range(n))


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def family(rng):
    docs = []
    for n in (3, 6, 12, 40, 200, 900):
        base = text_of(rng, n)
        docs += [base, base, base.upper()]
        docs += [edited(rng, base, e) for e in (1, 1, 2, n // 40, n // 25)]
    docs += [text_of(rng, rng.randrange(1, 300)) for _ in range(60)]
    passage = text_of(rng, 60)
    docs += [text_of(rng, 120) + " " + passage for _ in range(40)]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("words", [4, 5])
def test_like_brute_force(spark, words):
    docs = family(random.Random(words))
    got = neardup.near_duplicates(spark.createDataFrame(docs, SCHEMA), words=words).collect()
    want = brute(docs, words)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t, words)) for i, t in docs}


def test_large_groups_are_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BUCKET_BLOCK", 7)
    monkeypatch.setattr(neardup, "GROUP_BLOCK", 5)
    rng = random.Random(3)
    base = text_of(rng, 150)
    docs = [(i, edited(rng, base, rng.randrange(8))) for i in range(60)]
    got = neardup.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(docs)


def test_nulls_repeats_blank_long_and_clashing_columns(spark):
    long = text_of(random.Random(1), 60_000)
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A b"), (5, "A b"), (None, "a b"), (6, long), (7, long + " end")]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"kept": F.lit("x"), "id": F.lit(0), "root": F.lit(0)})
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles > 0, r.component_id, r.kept)
                 for r in neardup.near_duplicates(df).collect())
    assert got == [(-1, True, None, True), (1, False, 1, True), (2, False, 2, True), (3, False, 3, True),
                   (4, True, 4, True), (5, True, 4, False), (5, True, 4, False), (6, True, 6, True), (7, True, 6, False)]
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_corrects_for_chance():
    rng = np.random.default_rng(5)
    n = 20_000
    pairs = []
    for _ in range(20):
        a, b = (neardup.registers(np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))) for _ in range(2))
        pairs.append((a == b).mean())
    assert abs(np.mean(pairs) - neardup.chance(np.array(n), np.array(n))) < 1e-3
    shared = rng.integers(0, 2**64, n, dtype=np.uint64)
    grown = np.unique(np.concatenate([shared, rng.integers(0, 2**64, n // 10, dtype=np.uint64)]))
    one, other = neardup.registers(np.unique(shared)), neardup.registers(grown)
    assert abs((one == other).mean() - 1 / 1.1) < 0.07
    assert neardup.similar(one, n, other[None, :], np.array([len(grown)]), 0.8).all()
