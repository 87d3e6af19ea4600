"""Which contexts the suffix tree keeps, and scores from its tables, against a plain version."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from postings.llm import suffix_tree_lm as lm

SCHEMA = "doc_id long, text string"


def stream(text):
    return b" ".join((text or "").encode().lower().split()) + b"\n"  # of bytes: A-Z and U+0009 to U+000D only


def held(key):
    return zlib.crc32(str(key).encode()) % 10 == 0


def plain_tree(texts, depth):
    """Next bytes of each context, and the contexts kept, from texts and how often each comes."""
    after = defaultdict(Counter)
    for text, times in texts.items():
        data = b"\n" * depth + stream(text)
        for i in range(depth, len(data)):
            for length in range(depth + 1):
                after[data[i - length : i]][data[i]] += times
    wanted = {b""}
    for context, n in after.items():
        shorter = after[context[1:]]
        own, whole = sum(n.values()), sum(shorter.values())
        kl = sum(x / own * math.log(x / own * whole / shorter[b]) for b, x in n.items())
        if context and 0x0A not in context[1:] and kl >= lm.LEAST_DIVERGENCE and kl * own >= lm.EVIDENCE * len(n):
            wanted.update(context[i:] for i in range(len(context)))
    return after, wanted


def plain_score(text, after, wanted, depth):
    data, total = b"\n" * depth + stream(text), 0.0
    for i in range(depth, len(data)):
        p = (after[b""][data[i]] + 0.5) / (sum(after[b""].values()) + 0.5 * lm.SYMBOLS)
        for length in range(1, depth + 1):
            context = data[i - length : i]
            if context not in wanted:
                break
            p = (after[context][data[i]] + lm.PRIOR * p) / (sum(after[context].values()) + lm.PRIOR)
        total += math.log10(p)
    return total


def contexts_of(tree):
    return {
        r.context.to_bytes(length, "big") for length, level in enumerate(tree.levels) for r in level.filter("kept").select("context").distinct().collect()
    }


@pytest.fixture(scope="module")
def rows():
    """A large corpus of a few words, and a few texts with words that nothing else has."""
    draw = random.Random(8)
    common = " ".join(draw.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(3000))
    rare = [" ".join("".join(draw.choice("qxzvkw") for _ in range(draw.randint(2, 7))) for _ in range(40)) for _ in range(12)]
    return [*enumerate([common] * 300 + [r for r in rare for _ in range(2)]), (9001, None), (9002, ""), (9003, " \n"), (9004, "Żółw é\x01 qxz"), (9004, "Żółw é\x01 qxz"), (None, "zyx alpha")]


@pytest.mark.parametrize("depth", [5, 7])
def test_contexts_are_kept_by_divergence_alone(spark, rows, depth):
    texts = Counter(t for key, t in rows if key is not None and not held(key))
    after, wanted = plain_tree(texts, depth)
    total = sum(after[b""].values())
    assert sum(sum(after[c].values()) < 2e-6 * total for c in wanted) > 100  # the corpus is large enough for a share to matter
    df = spark.createDataFrame(rows, SCHEMA)
    scores = {t: plain_score(t, after, wanted, depth) for t in {t for _, t in rows}}
    got = sorted(((str(r.id), r.held_out, r.score) for r in lm.suffix_tree_scores(df, depth=depth).collect()))
    want = sorted((str(key), key is None or held(key), scores[t]) for key, t in rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-5)
    trained = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) != 0  # null for a null key
    tree = lm.fit(df, depth, trained)
    assert contexts_of(tree) == wanted
    assert tree.automaton.contexts == len(wanted)


def test_more_common_text_loses_no_rare_context(spark):
    rare = ["qxzvk wqxzv kqxzv"] * 8
    some, many = (lm.fit(spark.createDataFrame([(t,) for t in [*rare, *["aaaa bbbb " * 2000] * times]], "text string")) for times in (1, 250))
    own = lambda tree: {c for c in contexts_of(tree) if set(c) & set(b"qxzvkw")}
    assert own(some) and own(some) <= own(many)


def test_deepest_contexts_and_nothing_to_learn_from(spark):
    texts = Counter({"\U0010ffff\U0010ffff\U0010ffffab \U0010ffffab": 3, "ÿÿÿÿab": 2})  # codes of eight bytes, the sign bit among them
    after, wanted = plain_tree(texts, 7)
    tree = lm.fit(spark.createDataFrame([(t,) for t, n in texts.items() for _ in range(n)], "text string"), 7)
    assert contexts_of(tree) == wanted and max(map(len, wanted)) == 7
    keys = [k for k in range(100) if held(k)][:2]
    for row in lm.suffix_tree_scores(spark.createDataFrame([(keys[0], "ab"), (keys[1], "")], SCHEMA)).collect():
        want = {keys[0]: 2 * math.log10(0.5 / 127) + math.log10(1.5 / 127), keys[1]: math.log10(1.5 / 127)}
        assert row.held_out and row.score == pytest.approx(want[row.id], rel=1e-6)
