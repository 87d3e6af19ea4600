"""Language-model scores by a probabilistic suffix tree over the bytes of a text's words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, kept, table, text_bytes, text_of
from .exchange import bucket_bits, counts_of_shard, dealt, key_counts, replies_to, shard_count
from .hashes import _BLANK, _LOWER, joined_bytes, mixed, word_hashes

#: Longest context, in bytes; with the byte after it, it must fit into 64 bits.
DEPTH = 5
#: Least divergence, in nats, of a context's next bytes from those of the context one byte shorter.
LEAST_DIVERGENCE = 0.003
#: Divergence times occurrences must also be above this for each next byte seen.
EVIDENCE = 1.0
#: Occurrences that the shorter context's distribution counts for.
PRIOR = 8.0
#: The bytes between words and after the last.
SPACE, END = 0x20, 0x0A
#: Bytes that can stand in the stream: all but the blanks that do not part words there.
SYMBOLS = 252
#: Texts whose runs of bytes a task works out at a time, as bits.
TEXT_BITS = 9
TEXTS = 1 << TEXT_BITS
#: Different words and runs of bytes that shards have, for each byte of text.
WORDS_A_BYTE, GRAMS_A_BYTE = 0.02, 0.1


@dataclass
class Streams:
    """Texts as the bytes of their words, a space after each but the last, which has the end.

    A text without words is an end only.
    """

    data: np.ndarray
    starts: np.ndarray


def streams_of(texts: pa.ChunkedArray | pa.Array) -> Streams:
    data, starts = joined_bytes(texts)
    edge = np.flatnonzero(np.diff(_BLANK[data], prepend=True))
    first, last = edge[0::2], edge[1::2]
    n = len(starts) - 1
    owner = np.searchsorted(starts, first, side="right") - 1
    bare = np.setdiff1d(np.arange(n), owner)
    first, last, owner = (np.concatenate(x) for x in ((first, starts[bare]), (last, starts[bare]), (owner, bare)))
    order = np.argsort(owner, kind="stable")
    first, last, owner = first[order], last[order], owner[order]
    lengths = last - first + 1
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total) - np.repeat(ends - lengths - first, lengths)
    out = _LOWER[data[np.minimum(place, max(len(data) - 1, 0))]] if total else np.zeros(0, dtype=np.uint8)
    out[ends - 1] = SPACE
    final = np.ones(len(owner), dtype=bool)
    final[:-1] = owner[1:] != owner[:-1]
    out[ends[final] - 1] = END
    return Streams(out, np.concatenate([[0], ends[final]]).astype(np.int64))


def grams_of(streams: Streams, depth: int) -> np.ndarray:
    """For each byte the ``depth`` bytes before it and itself, as one number.

    Before a text's first byte stand ends.
    """
    n = len(streams.data)
    padded = np.concatenate([np.full(depth, END, dtype=np.uint8), streams.data])
    code = np.zeros(n, dtype=np.uint64)
    for k in range(depth, 0, -1):
        before = padded[depth - k : depth - k + n].copy()
        first = (streams.starts[:-1, None] + np.arange(k)).ravel()
        before[first[first < n]] = END
        code <<= np.uint64(8)
        code |= before
    return (code << np.uint64(8)) | streams.data


def distinct(numbers: np.ndarray) -> np.ndarray:
    """The different numbers, sorted. Asked for counts too, ``unique`` sorts, which is faster here than its hashing."""
    return np.unique(numbers, return_counts=True)[0]


def gram_counts(docs: DataFrame, depth: int) -> DataFrame:
    """(gram, n): each run of depth + 1 bytes of ``docs`` (text, trained) and how often the trained texts have it.

    Summed in each task first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def together() -> tuple[np.ndarray, np.ndarray]:
            grams, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(grams)
            grams = grams[order]
            first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            return grams[first], np.add.reduceat(n[order], first)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                texts, trained = (c.slice(at, TEXTS) for c in batch.columns)
                held.append(np.unique(grams_of(streams_of(texts.filter(trained)), depth), return_counts=True))
                others = distinct(grams_of(streams_of(texts.filter(pc.invert(trained))), depth))
                held.append((others, np.zeros(len(others), dtype=np.int64)))
                if sum(len(h[0]) for h in held[1:]) > max(1_000_000, len(held[0][0])):
                    held = [together()]
        if held:
            grams, n = together()
            for at in range(0, len(grams), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(grams[at : at + 100_000].astype(np.int64)), pa.array(n[at : at + 100_000])], names=["gram", "n"])

    return docs.select("text", "trained").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass
class Automaton:
    """A suffix tree as an automaton: state and byte give the next state and log10 probability.

    A state is the longest stretch just read that a kept context starts with, or ends in.
    """

    class_of: np.ndarray
    follow: np.ndarray
    log_p: np.ndarray
    contexts: int


#: What followed a context: the bytes, sorted, and how often each did.
Following = tuple[np.ndarray, np.ndarray]


@dataclass
class Level:
    """Contexts of one length and what followed them: sorted codes (context, then byte) and counts."""

    codes: np.ndarray
    n: np.ndarray

    def starts(self) -> np.ndarray:
        """Where each context's codes start, and the end."""
        context = self.codes >> np.uint64(8)
        return np.append(np.flatnonzero(np.diff(context, prepend=~context[:1])), len(context))


def low(column: str, size: int) -> Column:
    """The last ``size`` bytes of a code or context."""
    return F.col(column).bitwiseAND(F.lit((1 << 8 * size) - 1)) if size < 8 else F.col(column)


def judged(level: DataFrame, shorter: DataFrame, length: int, divergence: float = LEAST_DIVERGENCE, evidence: float = EVIDENCE) -> DataFrame:
    """(code, n, context, own, diverges): ``level`` (code, n) with each context's occurrences and whether
    its next bytes diverge from those of the context one byte shorter, which ``shorter`` has judged."""
    parents = shorter.select(F.col("code").alias("parent"), F.col("n").alias("parent_n"), F.col("own").alias("parent_own"))
    pairs = level.join(parents, low("code", length) == F.col("parent"))
    gain = F.when(F.col("n") > 0, F.col("n") * (F.ln("n") + F.ln("parent_own") - F.ln("parent_n")))
    # a context is followed by 256 different bytes at most
    contexts = pairs.groupBy(F.shiftrightunsigned("code", 8).alias("context")).agg(
        F.sum("n").alias("own"), F.sum(gain).alias("gain"), F.count_if(F.col("n") > 0).alias("size"), F.collect_list(F.struct("code", "n")).alias("pairs")
    )
    kl = F.when(F.col("own") > 0, F.col("gain") / F.col("own") - F.ln("own"))
    whole = F.lit(True)  # one text's: an end can only be the first byte
    for k in range(length - 1):
        whole &= F.shiftrightunsigned("context", 8 * k).bitwiseAND(F.lit(255)) != END
    diverges = F.coalesce((kl >= divergence) & (kl * F.col("own") >= F.col("size") * evidence) & whole, F.lit(False))
    return contexts.select(F.inline("pairs"), "context", "own", diverges.alias("diverges"))


@dataclass
class SuffixTree:
    """A suffix tree as tables, one for each length of its contexts: (code, n, context, own, kept).

    A code is a context and the byte after it; ``n`` and ``own`` are how often the code and its
    context occur. Contexts are ``kept`` that diverge from the one a byte shorter, and all their ends.
    """

    levels: list[DataFrame]

    def gram_scores(self) -> DataFrame:
        """(gram, log_p): each longest code's log10 probability of its last byte after the longest kept end of its context.

        A kept context's distribution mixes its counts with the one of the context a byte shorter,
        which counts as ``PRIOR`` occurrences; the empty context's, with an even one over all bytes
        that can occur.
        """
        p = self.levels[0].select("code", ((F.col("n") + 0.5) / (F.col("own") + 0.5 * SYMBOLS)).alias("p"))
        for length, level in enumerate(self.levels[1:], 1):
            shorter = p.select(F.col("code").alias("parent"), F.col("p").alias("shorter"))
            mixture = (F.col("n") + PRIOR * F.col("shorter")) / (F.col("own") + PRIOR)
            p = level.join(shorter, low("code", length) == F.col("parent")).select("code", F.when(F.col("kept"), mixture).otherwise(F.col("shorter")).alias("p"))
        return p.select(F.col("code").alias("gram"), F.log10("p").cast("float").alias("log_p"))

    @cached_property
    def automaton(self) -> Automaton:
        """The tree on the driver, to read a text byte by byte; the kept contexts must fit there."""
        counts: dict[bytes, Following] = {}
        for length, table in enumerate(self.levels):
            level = level_of(table.filter("kept and n > 0").select("code", "n"))
            starts = level.starts()
            for a, b in zip(starts, starts[1:], strict=False):
                context = int(level.codes[a] >> np.uint64(8)).to_bytes(length, "big")
                counts[context] = (level.codes[a:b] & np.uint64(255)).astype(np.uint8), level.n[a:b]
        return automaton_of(counts or {b"": (np.array([END], dtype=np.uint8), np.array([1]))})

    @property
    def class_of(self) -> np.ndarray:
        return self.automaton.class_of

    @property
    def follow(self) -> np.ndarray:
        return self.automaton.follow

    @property
    def log_p(self) -> np.ndarray:
        return self.automaton.log_p


def automaton_of(counts: dict[bytes, Following]) -> Automaton:
    """The automaton of the contexts in ``counts``, among them all their ends.

    A context's distribution mixes its counts with the distribution of the context one byte
    shorter, which counts as ``PRIOR`` occurrences; the empty context's, with an even one over
    all bytes that can occur. So each distribution sums to 1 and no byte is impossible.
    """
    keep = set(counts)
    symbols, root = counts[b""]
    seen = sorted({END, SPACE, *symbols.tolist()})
    width = len(seen) + 1  # the last class is for each byte never seen
    class_of = np.full(256, len(seen), dtype=np.int32)
    class_of[seen] = np.arange(len(seen))
    even = np.full(width, 0.5)
    even[class_of[symbols]] += root
    spread = {b"": even / (root.sum() + 0.5 * SYMBOLS)}
    for context in sorted(keep - {b""}, key=len):
        symbols, n = counts[context]
        own = PRIOR * spread[context[1:]]
        own[class_of[symbols]] += n
        spread[context] = (own / (n.sum() + PRIOR)).astype(np.float32)
    states = sorted({context[:i] for context in keep for i in range(len(context) + 1)}, key=lambda s: (len(s), s))
    number = {s: i for i, s in enumerate(states)}
    follow = np.zeros((len(states), width), dtype=np.int32)
    log_p = np.zeros((len(states), width), dtype=np.float32)
    back = {b"": b""}
    for s in states:
        if s:
            # the longest proper end of s that is a state: by the automaton of what lies before
            shorter = s[1:]
            while shorter not in number:
                shorter = shorter[1:]
            back[s] = shorter
            follow[number[s]] = follow[number[shorter]]
        # children are longer, so the row of the state behind is complete
        for a in seen:
            child = s + bytes([a])
            if child in number:
                follow[number[s], class_of[a]] = number[child]
        known = s
        while known not in spread:
            known = back[known]
        log_p[number[s]] = np.log10(spread[known])
    return Automaton(class_of, follow, log_p, len(keep))


def level_of(pairs: DataFrame) -> Level:
    """The level of (code, n), brought to the driver as columns: rows would take many times their two numbers."""
    rows = pairs.toArrow()
    codes = rows["code"].to_numpy().astype(np.uint64)
    order = np.argsort(codes)
    return Level(codes[order], rows["n"].to_numpy()[order])


def fit(docs: DataFrame, depth: int = DEPTH, trained: Column | None = None) -> SuffixTree:
    """A suffix tree of all texts of ``docs`` (text), or of those that ``trained`` is true for.

    Runs of bytes are counted over the whole corpus, and contexts judged level by level, by Spark:
    the tree grows with the corpus and no level comes to the driver. Divergence and its evidence
    alone decide which contexts are kept, so none is lost because the corpus is large. The tables also have
    the codes of texts that nothing is learned from, with no occurrence.
    """
    learned = F.lit(True) if trained is None else F.coalesce(trained, F.lit(False))
    levels = [kept(gram_counts(docs.select("text", learned.alias("trained")), depth)).withColumnRenamed("gram", "code")]
    for length in range(depth - 1, -1, -1):
        levels.insert(0, kept(levels[0].groupBy(low("code", length + 1).alias("code")).agg(F.sum("n").alias("n"))))
    total = levels[0].agg(F.sum("n")).first()[0] or 0
    # without a text to learn from, one end counts as seen
    n = F.col("n") if total else (F.col("code") == END).cast("long")
    found = [levels[0].select("code", n.alias("n"), F.lit(0).cast("long").alias("context"), F.lit(total or 1).cast("long").alias("own"))]
    for length in range(1, depth + 1):
        found.append(kept(judged(levels[length], found[-1], length)))
    tables: list[DataFrame] = []
    longer: DataFrame | None = None
    for length in range(depth, 0, -1):
        wanted = found[length].filter("diverges").select("context")
        if longer is not None:
            wanted = wanted.union(longer.select(low("context", length).alias("context")))
        longer = kept(wanted.distinct())
        marked = found[length].join(longer.withColumn("mark", F.lit(True)), "context", "left")
        tables.insert(0, marked.select("code", "n", "context", "own", F.coalesce("mark", F.lit(False)).alias("kept")))
    return SuffixTree([found[0].withColumn("kept", F.lit(True)), *tables])


def bucket_of(grams: np.ndarray, bits: int) -> np.ndarray:
    """The bucket that answers for each gram. Grams that differ in their last byte only share it."""
    return (mixed(grams >> np.uint64(8)) >> np.uint64(64 - bits)).astype(np.int64)


def planes(grams: np.ndarray, size: int) -> bytes:
    """Numbers of ``size`` bytes as their first bytes, then their second, and so on: sorted ones pack well so."""
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def from_planes(data: bytes, size: int) -> np.ndarray:
    """What ``planes`` was given."""
    grams = np.zeros((len(data) // size, 8), dtype=np.uint8)
    grams[:, :size] = np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T
    return grams.view("<u8").ravel().astype(np.uint64, copy=False)


def gram_replies(dealt_rows: DataFrame, scores: DataFrame, depth: int, bits: int) -> DataFrame:
    """(shard, bucket, logs): for each shard and bucket the 32-bit ``log_p`` of its grams, in their order.

    Each shard sends its different grams once, whatever their number of occurrences; a bucket looks
    them up in its part of ``scores``, which has all of them.
    """
    size = depth + 1

    def send(rows: pa.Table) -> pa.Table:
        texts = rows.column("text")
        grams = distinct(np.concatenate([distinct(grams_of(streams_of(texts.slice(at, TEXTS)), depth)) for at in range(0, len(texts), TEXTS)]))
        bucket = bucket_of(grams, bits)
        order = np.argsort(bucket, kind="stable")
        present, cut = np.unique(bucket[order], return_index=True)
        cut = np.append(cut, len(grams))
        return pa.table(
            {
                "bucket": pa.array(present, pa.int64()),
                "shard": pa.array(np.full(len(present), rows.column("shard")[0].as_py()), pa.int64()),
                "grams": pa.array([planes(grams[order[a:b]], size) for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
            }
        )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = bucket_of(batch.column(0).to_numpy().astype(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), *batch.columns], names=["bucket", "gram", "log_p"])

    def answer(sent: pa.Table, own: pa.Table) -> pa.Table:
        grams = own.column("gram").to_numpy().astype(np.uint64)
        order = np.argsort(grams)
        grams, log_p = grams[order], own.column("log_p").to_numpy()[order]
        logs = [log_p[np.searchsorted(grams, from_planes(x.as_py(), size))].tobytes() for x in sent.column("grams")]
        return pa.table({"shard": sent.column("shard"), "bucket": sent.column("bucket"), "logs": pa.array(logs, pa.binary())})

    sent = dealt_rows.groupBy("shard").applyInArrow(send, "bucket long, shard long, grams binary")
    own = scores.mapInArrow(deal, "bucket long, gram long, log_p float")
    return sent.groupBy("bucket").cogroup(own.groupBy("bucket")).applyInArrow(answer, "shard long, bucket long, logs binary")


def stream_scores(texts: pa.ChunkedArray | pa.Array, replies: pa.Table, depth: int, bits: int) -> np.ndarray:
    """log10 probability of each text of a shard: the sum of its grams' ones, which ``replies`` has."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
    for at in range(0, len(texts), TEXTS):
        streams = streams_of(texts.slice(at, TEXTS))
        grams, n = grams_of(streams, depth), len(streams.starts) - 1
        owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(streams.starts))
        if 8 * (depth + 1) + TEXT_BITS <= 64:  # a gram and its text fit into one number
            both = np.sort((grams << np.uint64(TEXT_BITS)) | owner)
            grams, owner = both >> np.uint64(TEXT_BITS), both & np.uint64(TEXTS - 1)
        else:
            order = np.argsort(grams)
            grams, owner = grams[order], owner[order]
        new = np.append(True, grams[1:] != grams[:-1])
        parts.append((grams[new], np.cumsum(new, dtype=np.int32) - 1, owner.astype(np.int16), n))
    if not parts:
        return np.zeros(0)
    known = distinct(np.concatenate([p[0] for p in parts]))
    logs = replies.column("logs").to_pylist()
    log_p = np.empty(len(known), dtype=np.float32)
    log_p[np.argsort(bucket_of(known, bits), kind="stable")] = np.concatenate([np.frombuffer(logs[i], dtype=np.float32) for i in np.argsort(replies.column("bucket").to_numpy())])
    return np.concatenate([np.bincount(owner, weights=log_p[np.searchsorted(known, grams)][where], minlength=n) for grams, where, owner, n in parts])


def suffix_tree_scores(docs: DataFrame, folds: int = 10, held_fold: int = 0, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    Learned from the rows whose crc32(key as text) mod ``folds`` is not ``held_fold``. A text's
    tokens are its words, A-Z lower-cased and parted by blanks, and one end. ``score`` is the
    suffix tree's log10 probability of the tokens, spelled byte by byte with a space between
    words; ``base_score`` that of the words' own frequencies with 0.1 added, one count for
    all words never seen; ``n_known`` counts the tokens seen in training.

    Null and empty texts have one token, the end. Rows with a null key are held out. Repeated
    rows count each time. An empty table gives no row. Other columns are not read.
    """
    total, _ = text_bytes(docs, text)
    bits, gram_bits = bucket_bits(int(total * WORDS_A_BYTE)), bucket_bits(int(total * GRAMS_A_BYTE) // 4)
    trained = F.coalesce(fold(F.col(key), folds) != held_fold, F.lit(False))
    named = docs.select(F.col(key).cast("long").alias("id"), trained.alias("trained"), text_of(text).alias("text"))
    tree = fit(named, depth, F.col("trained"))
    rows = dealt(named, shard_count(total), F.col("id"), F.col("text"))
    end_key = np.zeros(1, dtype=np.uint64)

    def tokens(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, owner = word_hashes(*joined_bytes(part.column("text")))
        n = part.num_rows
        keys, where = np.unique(np.concatenate([words, np.repeat(end_key, n)]), return_inverse=True)
        return keys, where, np.concatenate([owner, np.arange(n)])

    def keys_of(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys, where, owner = tokens(part)
        return keys, np.bincount(where[part.column("trained").to_numpy()[owner]], minlength=len(keys))

    def score(part: pa.Table, replies: pa.Table) -> pa.Table:
        n = part.num_rows
        if not n:
            none = pa.array([], pa.int64())
            return pa.table({"id": none, "trained": pa.array([], pa.bool_()), "n_tokens": none, "n_known": none, "logs": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
        _, where, owner = tokens(part)
        grams = pc.is_valid(replies.column("logs"))
        counts = counts_of_shard(replies.filter(pc.invert(grams)))[where]
        return pa.table(
            {
                "id": part.column("id"),
                "trained": part.column("trained"),
                "n_tokens": pa.array(np.bincount(owner, minlength=n), pa.int64()),
                "n_known": pa.array(np.bincount(owner[counts > 0], minlength=n), pa.int64()),
                "logs": pa.array(np.bincount(owner, weights=np.log10(counts + 0.1), minlength=n)),
                "score": pa.array(stream_scores(part.column("text"), replies.filter(grams), depth, gram_bits)),
            }
        )

    replies = key_counts(rows, keys_of, bits, whole=True)
    both = replies_to(replies).unionByName(gram_replies(rows, tree.gram_scores(), depth, gram_bits), allowMissingColumns=True)
    scored = rows.groupBy("shard").cogroup(both.groupBy("shard")).applyInArrow(
        score, "id long, trained boolean, n_tokens long, n_known long, logs double, score double"
    )
    sums = replies.filter("shard < 0").agg(F.sum("total").alias("train_tokens"), F.sum("distinct").alias("vocabulary"))
    return scored.withColumn("one", F.lit(1)).join(F.broadcast(sums.withColumn("one", F.lit(1))), "one").select(
        "id",
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        (F.col("logs") - F.col("n_tokens") * F.log10(F.col("train_tokens") + 0.1 * (F.col("vocabulary") + 1))).alias("base_score"),
        "score",
    )


def op8_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' scores, learned from nine tenths of them."""
    return suffix_tree_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
