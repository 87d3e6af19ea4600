"""Memory of the driver and of tasks, by what Python itself allocates."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from postings.llm import sentencepieces, suffix_tree_lm


def peak_of(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_level_comes_to_the_driver_as_columns(spark):
    n = 100_000
    pairs = spark.range(n).select((F.lit(n) - F.col("id")).alias("code"), F.col("id").alias("n"))
    level, peak = peak_of(lambda: suffix_tree_lm.level_of(pairs))
    assert level.codes.tolist() == list(range(1, n + 1)) and level.n.tolist() == list(range(n - 1, -1, -1))
    assert peak < 10 * 16 * n


def test_later_segmentations_draw_only_behind_their_fork(spark, monkeypatch):
    vocabulary = sentencepieces.Vocabulary.read(sentencepieces.MODEL)
    held = sentencepieces.Lattices(vocabulary)
    drawn = []
    real = sentencepieces.Lattices.paths
    monkeypatch.setattr(sentencepieces.Lattices, "paths", lambda self, nodes, seeds: drawn.append(len(nodes)) or real(self, nodes, seeds))
    monkeypatch.setattr(sentencepieces, "_loaded", {hash(vocabulary.weights.tobytes()): held})
    monkeypatch.setattr(sentencepieces, "PART_CHARS", 300)
    texts = ["the quick brown fox jumps over the lazy dog " * (i % 5) for i in range(40)]

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, work, schema):  # noqa: N802
            batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], names=["doc_id", "text"])
            return [row for out in work(iter([batch])) for row in out.to_pylist()]

    rows = sentencepieces.sampled_pieces(Docs(), vocabulary)
    units = [sentencepieces.units_of(t, held.unit) for t in texts]
    whole = sum(map(len, units))
    assert len(drawn) > 2 and max(drawn) < whole / 2  # parts, not all texts at once
    assert sum(drawn) < 2 * whole  # twice all units: every path drawn anew from its start
    want = []
    for key, own in enumerate(units):
        nodes, seed = held.nodes(own), sentencepieces.row_seeds([key], 0)
        each = sentencepieces.mixed  # the units' seeds, as the operator numbers them
        seeds = np.repeat(seed, len(own)) + np.arange(len(own)).astype(np.uint64) * sentencepieces.BASE
        fresh = [real(held, nodes, each(seeds + np.uint64(m) * sentencepieces.MULTIPLIERS[2:3])) for m in range(2)]
        for number, s in enumerate(sentencepieces.TopK(held, int(seed[0]), fresh).run(2)):
            want.append((key, number, sentencepieces.ids_of(held, s.edges).tolist(), s.log_prob, s.perturbed, s.inclusion))
    assert [(r["doc_id"], r["sample"], r["ids"], r["log_prob"], r["perturbed"], r["inclusion"]) for r in rows] == want
    assert all(r["decodes"] for r in rows)
