"""op13: alignment against a plain version with nested loops; galloping against set intersection; odd rows."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postings.llm import token_alignment as ta

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not (Path(FOLDER).is_dir() and Path(ta.PIECE_BPE).is_file()), reason="no tables or vocabularies")


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 3000)), st.sets(st.integers(0, 3000)))
def test_galloping_is_intersection(x, y):
    x, y = sorted(x), sorted(y)
    assert ta.galloping_common(x, y) == sorted(set(x) & set(y))


def plain(texts):
    """Per text (n_a, n_b, n_groups, n_links, groups text, pair links) by direct loops."""
    enc = ta.Vocabularies.read().encoders()
    out = []
    for t in texts:
        t = t or ""
        a = [e.ids for e in enc.a.encode_batch([" " + t], add_special_tokens=False)][0]
        b = enc.b.encode([t])[0]
        whole = (" " + t).encode()
        if not t or b"".join(enc.a_bytes[i] for i in a) != whole or b"".join(enc.b_bytes[i] for i in b) != whole:
            out.append((0, 0, 0, 0, "", Counter()))
            continue
        ends = lambda ids, lengths: [sum(len(lengths[i]) for i in ids[: k + 1]) for k in range(len(ids))]
        ae, be = ends(a, enc.a_bytes), ends(b, enc.b_bytes)
        cuts = sorted(set(ae) & set(be))
        groups = [([x for x, e in zip(a, ae) if lo < e <= hi], [y for y, e in zip(b, be) if lo < e <= hi]) for lo, hi in zip([0, *cuts], cuts)]
        pairs = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(a), len(b), len(groups), sum(pairs.values()), text, pairs))
    return out


@needs_tables
def test_each_unit_is_encoded_once_as_in_whole_texts(monkeypatch):
    enc = ta.Vocabularies.read().encoders()
    rng = random.Random(3)
    signs = [*" \t\n\r\x0b\x0c\x1c\x85\xa0\u180e\u2003\u3000\u200b", "  ", "a", "b", "the", "'s", "'ll", "1", "\u00b2", "\u00e9", "\u65e5\u672c", "\U0001f600", "!", "..", "<|endoftext|>", "\u0301"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 14))) for _ in range(4000)] + ["the same words again and again " * 50] * 20
    want = [e.ids for e in enc.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    given = []
    real = enc._batch
    monkeypatch.setattr(enc, "_batch", lambda part, **kw: given.extend(map(len, part)) or real(part, **kw))
    a, _ = enc.encode(texts)
    assert [x.tolist() for x in a] == want
    assert sum(given) < sum(map(len, texts)) - 19 * len(texts[-1])
    monkeypatch.setattr(ta, "CACHE_CHARS", 10)
    assert [x.tolist() for part in (texts[:100], texts[100:200]) for x in enc.encode(part)[0]] == want[:200]


@needs_tables
def test_query_matches_nested_loops(spark):
    rows = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = plain([r["text"] for r in rows])
    docs_of = Counter(p for w in want for p in w[5])
    top = defaultdict(int)
    for (x, _), c in docs_of.items():
        top[x] = max(top[x], c)
    expected = {}
    for r, (na, nb, ng, nl, text, pairs) in zip(rows, want, strict=True):
        best = sum(n for (x, y), n in pairs.items() if docs_of[(x, y)] == top[x])
        total = sum(n * docs_of[p] for p, n in pairs.items())
        expected[r["doc_id"]] = (na, nb, ng, nl, best, total, hashlib.sha256(text.encode()).hexdigest() if text else "")
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in ta.op13_token_alignment(spark, FOLDER).collect()}
    assert got == expected
    assert sum(1 for v in expected.values() if v[0]) > 0.9 * len(expected)


@needs_tables
def test_salted_join_gives_the_same_rows(spark, monkeypatch):
    want = {r.doc_id: tuple(r) for r in ta.op13_token_alignment(spark, FOLDER).collect()}
    monkeypatch.setattr(ta, "BROADCAST_BYTES", 0)
    assert {r.doc_id: tuple(r) for r in ta.op13_token_alignment(spark, FOLDER).collect()} == want


@needs_tables
def test_odd_rows(spark):
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, "  \n\t"), (4, "<|endoftext|> <s> </s> <unk>"), (5, "same text here"), (5, "same text here"), (None, "no key"), (6, "é😀 " * 20000), (7, "\udcff".encode("utf-8", "surrogatepass").decode("utf-8", "replace"))]
    rows += [(100 + i, " ".join(rng.choice(["a", "bb", "the", "ü", "x1"]) for _ in range(30))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pairs", ta.F.lit(1)).withColumn("rid", ta.F.lit("x"))
    out = ta.alignment_counts(docs, ta.Vocabularies.read()).collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    assert (by[1][0].n_a, by[1][0].groups, by[2][0].n_b, by[2][0].count_sum) == (0, "", 0, 0)
    assert by[4][0].n_a > 5 and by[4][0].n_links >= by[4][0].n_a
    assert by[5][0].count_sum == by[5][1].count_sum > 0
    assert by[6][0].n_groups > 10000
    assert ta.alignment_counts(docs.limit(0), ta.Vocabularies.read()).count() == 0
