"""Toxicity by compression distance: two zstandard dictionaries compete for each word of a text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, table, text_of

#: Most labelled rows of either class that are learned from, and most code points of each.
MAX_ROWS = 4_000
MAX_CHARS = 20_000
TOXIC_BYTES, ORDINARY_BYTES = 1024, 65_536
#: A word is typical of toxic texts if it is in at least this share of them, in two at least, and in no ordinary one.
TYPICAL_SHARE = 0.003
THRESHOLD = 0.7
#: Blanks before a window. They cost either side the same and keep short windows from being stored as they are.
PADDING = 32
LEVEL = 19
#: Windows whose distance a worker remembers.
CACHE = 400_000

_WORD = re.compile(r"[^\W\d_]+")
_FEATURES = 11


def windows_of(text: str) -> list[str]:
    """The windows of a text: its runs of letters, in small letters."""
    return _WORD.findall(text.lower())


@dataclass
class ToxicityModel:
    """Dictionaries, and the weights that turn a text's distances into a score."""

    toxic: bytes
    ordinary: bytes
    mean: list[float] = field(default_factory=lambda: [0.0] * _FEATURES)
    scale: list[float] = field(default_factory=lambda: [1.0] * _FEATURES)
    weights: list[float] = field(default_factory=lambda: [0.0] * (_FEATURES + 1))

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.ones(len(features)), (features - self.mean) / self.scale]) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Distances:
    """How many bytes shorter a window gets with the toxic dictionary than with the other."""

    def __init__(self, model: ToxicityModel) -> None:
        self.sides = [self._compressor(model.ordinary), self._compressor(model.toxic)]
        self.known: dict[str, int] = {}

    @staticmethod
    def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
        parameters = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS
        )
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        return zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)

    def of(self, window: str) -> int:
        found = self.known.get(window)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            body = (" " * PADDING + window + " ").encode()
            ordinary, toxic = (len(side.compress(body)) for side in self.sides)
            found = self.known[window] = ordinary - toxic
        return found

    def features(self, text: str) -> list[float]:
        """What the distances of a text's windows say: the greatest, shares, mean, and counts."""
        d = np.fromiter(map(self.of, windows_of(text)), dtype=np.int32)
        if not len(d):
            d = np.zeros(1, dtype=np.int32)
        top = np.sort(np.partition(d, len(d) - min(4, len(d)))[len(d) - min(4, len(d)) :])[::-1]
        over = [int((d >= k).sum()) for k in (1, 2, 3, 4)]
        return [top[0], top[:2].mean(), top.mean(), over[0] / len(d), over[1] / len(d), over[2] / len(d), d.mean(), np.log(len(d)), *over[1:]]


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A zstandard dictionary of the samples, or nothing if there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (weight * (p - y)) + 0.1 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learned(texts: list[str], toxic: list[int], class_rows: dict[int, int]) -> ToxicityModel:
    """A model from labelled texts; ``class_rows`` has the rows of each class that they stand for.

    The ordinary dictionary is trained on the ordinary texts, the toxic one on what the toxic
    texts share and no ordinary text has. Weights are fitted to the labels, each class
    counting as it occurs.
    """
    words = [windows_of(t) for t in texts]
    ordinary = [w for w, y in zip(words, toxic, strict=True) if not y]
    bad = [w for w, y in zip(words, toxic, strict=True) if y]
    usual = {w for ws in ordinary for w in ws}
    held_by = Counter(w for ws in bad for w in set(ws) if w not in usual)
    least = max(2, TYPICAL_SHARE * len(bad))
    typical = [(" " + "  ".join(w for w in ws if held_by[w] >= least) + " ").encode() for ws in bad]
    model = ToxicityModel(
        _dictionary(TOXIC_BYTES, [t for t in typical if len(t) > 8]),
        _dictionary(ORDINARY_BYTES, [(" " + " ".join(ws) + " ").encode()[:2000] for ws in ordinary]),
    )
    if not bad or not ordinary:
        model.weights[0] = float(np.log((class_rows.get(1, 0) + 0.5) / (class_rows.get(0, 0) + 0.5)))
        return model
    distances = Distances(model)
    x, y = np.array([distances.features(t) for t in texts]), np.array(toxic)
    model.mean, model.scale = x.mean(0).tolist(), (x.std(0) + 1e-9).tolist()
    share = np.array([class_rows[0] / len(ordinary), class_rows[1] / len(bad)])
    weight = share[y] / (share[y]).mean()
    model.weights = _logistic(np.column_stack([np.ones(len(x)), (x - model.mean) / model.scale]), y, weight).tolist()
    return model


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Learn from the labelled documents whose crc32(key as text) mod 3 is not 1.

    At most ``max_rows`` rows of each class, those with the least hashes of their keys, and
    the first 20,000 code points of each text are brought to the driver; nothing else is.
    """
    marked = labels.filter(F.col(label).isin(0, 1) & (fold(F.col(key), 3) != 1)).groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("toxic"))
    rows = docs.select(F.col(key).alias("id"), F.substring(text_of(text), 1, MAX_CHARS).alias("text"))
    class_rows = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    sample = []
    for y in (0, 1):
        chosen = marked.filter(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(max_rows)
        sample += rows.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id", "text").limit(max_rows).select("text", "toxic").collect()
    return learned([r.text for r in sample], [r.toxic for r in sample], class_rows)


_loaded: dict[bytes, Distances] = {}


def toxicity_scores(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with a ``toxicity`` column from 0 to 1: how likely the label is 1.

    Every word of the whole text is a window, compressed with either dictionary; the score
    is a logistic function of the differences in length. Null and empty texts have no window
    and get the score of a text without signs. The order of rows is kept and other columns
    pass through; a column named ``toxicity`` is replaced.
    """
    passed = docs.drop("toxicity")
    at = passed.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distances = _loaded.get(model.toxic + model.ordinary)
        if distances is None:
            _loaded.clear()
            distances = _loaded[model.toxic + model.ordinary] = Distances(model)
        for batch in batches:
            if not batch.num_rows:
                continue
            features = np.array([distances.features(t.as_py() or "") for t in batch.column(at)], dtype=float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(features))], names=[*batch.schema.names, "toxicity"])

    schema = passed.limit(0).withColumn("toxicity", F.lit(0.0)).schema
    return passed.mapInArrow(score, schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' scores."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity_scores(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(True)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
