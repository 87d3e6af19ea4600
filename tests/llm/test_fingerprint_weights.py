"""Fingerprints of single texts with uneven weights, or with few words."""

from collections import Counter

import numpy as np

from postings.llm.fingerprints import SAMPLES, fingerprints, likeness
from pyspark.sql import functions as F


def terms(text):
    words = text.split()
    return Counter(zip(words, words[1:], strict=False)) if len(words) != 1 else Counter(words)


def pairs():
    """(kind, trial, text, other text)"""
    for i in range(30):
        heavy, own, other = f"x{i} " * 300, " ".join(f"a{i}_{k}" for k in range(100)), " ".join(f"b{i}_{k}" for k in range(100))
        yield "shared heavy pair", i, heavy + own, heavy + other
        yield "lost heavy pair", i, heavy + own, own
        yield "unequal weights", i, heavy + own, f"x{i} " * 100 + own
        yield "three pairs", i, f"p{i} q{i} r{i} s{i}", f"p{i} q{i} r{i} t{i}"
        yield "one word", i, f"p{i}", f"p{i}"


def test_agreement_is_the_weighted_similarity(spark):
    rows = [(f"{kind} {i}", side, text) for kind, i, *texts in pairs() for side, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "id string, side int, text string").repartition(8, "id")
    prints = fingerprints(df, ["id", "side"])
    own, other = (prints.filter(F.col("side") == s).select("id", F.col("samples").alias(f"s{s}")) for s in (0, 1))
    got = {r.id: r for r in own.join(other, "id").select("*", likeness(F.col("s0"), F.col("s1")).alias("like")).collect()}
    errors = {}
    for kind, i, a, b in pairs():
        row = got[f"{kind} {i}"]
        assert [e >> 24 for e in row.s0] == [e >> 24 for e in row.s1] == list(range(SAMPLES))
        true = sum((terms(a) & terms(b)).values()) / sum((terms(a) | terms(b)).values())
        errors.setdefault(kind, []).append(row.like - true)
    # of 128 samples a share of J has a deviation of 0.044 at most
    for kind, found in errors.items():
        assert abs(np.mean(found)) < 0.03 and np.abs(found).max() < 0.2, (kind, np.mean(found), np.abs(found).max())
