"""Each operator against a plain version of what it computes, on the smallest tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import rows_of
from postings.llm import components, jaccard_join, kd_shards, queries, sentencepieces, suffix_arrays, suffix_dedup, suffix_tree_lm
from postings.llm.exchange import packed, unpacked
from postings.llm.line_dedup import chunks_of, dedup_lines
from postings.llm.suffix_tree_lm import streams_of

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(folder=FOLDER):
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return sorted((r["doc_id"], r["text"] or "") for r in table)


def words(text):
    return WORD.findall(text.translate(LOWER))


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_sql(spark, key):
    db = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[key](spark, FOLDER)
    result = db.execute(queries.ORACLES[key])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def removed_bytes(rows):
    """By document (n_bytes, n_removed, n_spans, sha256 of what is left)."""
    owner, out = {}, {}
    for doc, text in rows:
        body = text.encode()
        gone, mine = bytearray(len(body)), []
        for i in range(len(body) - 49):
            s = body[i : i + 50]
            if owner.get(s, doc) < doc:
                gone[i : i + 50] = b"\1" * 50
            else:
                mine.append(s)
        for s in mine:
            owner[s] = doc
        left = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[doc] = (len(body), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("block", [2_000_000, 3_000])
def test_suffix_dedup(spark, block, monkeypatch):
    """Also with blocks so small that many are merged by binary search."""
    monkeypatch.setattr(suffix_dedup, "SHARD_TEXT", 2_000_000)
    got = suffix_dedup.op1_suffix_dedup(spark, FOLDER).collect() if block == 2_000_000 else None
    if got is None:
        rows = [(d, t) for d, t in documents()[:80]]
        sent = []
        import pyarrow as pa

        table = pa.table({"id": pa.array([d for d, _ in rows], pa.int64()), "text": [t for _, t in rows]})
        texts = suffix_dedup.texts_of(table)
        found = suffix_dedup.stretches_of(texts, 6)
        data, _ = suffix_dedup.gathered(texts.data, found.at, found.strings + 49)
        blob = suffix_dedup._packed(key=found.key, owner=texts.ids[found.text], text=found.text, at=found.at - texts.starts[found.text], strings=found.strings, data=data)
        sent.append({"shard": 0, "n": len(found.key), "blob": blob})
        monkeypatch.setattr(suffix_dedup, "SHARD_TEXT", block)
        small = suffix_dedup._judged(sent)[0]
        monkeypatch.setattr(suffix_dedup, "SHARD_TEXT", 2_000_000)
        large = suffix_dedup._judged(sent)[0]
        covered = lambda s: {(t, p) for t, a, b in np.frombuffer(suffix_dedup.zstandard.ZstdDecompressor().decompress(s["spans"]), dtype="<i8").reshape(-1, 3).tolist() for p in range(a, b)}
        assert covered(small) == covered(large) and covered(large)
        return
    assert {r.doc_id: tuple(r)[1:] for r in got} == removed_bytes(documents())


def test_suffix_arrays():
    rng = np.random.default_rng(1)
    lanes, suffix_arrays.LANES = suffix_arrays.LANES, 16
    try:
        for _ in range(120):
            n, width, letters = int(rng.integers(1, 300)), int(rng.integers(2, 20)), int(rng.integers(1, 4))
            data = rng.integers(0, letters, n).astype(np.uint8)
            raw = data.tobytes()
            order = suffix_arrays.suffix_array(data)
            assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(n))
            shared = suffix_arrays.common_prefixes(data, order, width)
            for i in range(1, n):
                a, b = raw[order[i - 1] :], raw[order[i] :]
                same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
                assert shared[i] == min(same, width)
    finally:
        suffix_arrays.LANES = lanes


def test_fingerprints(spark):
    rows = documents()[::-1]
    got = {r.doc_id: r for r in queries.QUERIES["op3_fingerprints"](spark, FOLDER).collect()}
    terms = lambda t: Counter(zip(w, w[1:], strict=False)) if len(w := words(t)) != 1 else Counter(w)
    like = lambda a, b: sum((a & b).values()) / max(1, sum((a | b).values()))
    errors = []
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        row = got[doc]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and row.n_chars == len(text)
        if len(words(text)) >= 500:  # enough terms to fill nearly all slots
            errors += [row.near_edited - like(terms(text), terms(edited)), row.near_next - like(terms(text), terms(following))]
    # of m samples that agree with probability J, the share has a deviation of sqrt(J (1 - J) / m)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 1.25 * math.sqrt(0.25 / 128)
    by_text = defaultdict(set)
    for doc, text in rows:
        by_text[text].add(got[doc].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_line_dedup(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    chunks = {r.doc_id: r.c for r in df.select("doc_id", chunks_of(F.col("text")).alias("c")).collect()}
    seen, want = set(), {}
    for doc, text in rows:
        assert "\n".join("\n".join(c) for c in chunks[doc]) == text
        left = []
        for chunk in chunks[doc]:
            whole = "\n".join(chunk)
            if len(chunk) < 2 or whole not in seen:
                left.append(whole)
            seen.add(whole)
        want[doc] = "\n".join(left)
    assert {r.doc_id: r.kept_text for r in dedup_lines(df).collect()} == want


def test_line_chunks_resist_shifts(spark):
    """A passage that stands in two texts is removed from the second but for its edges."""
    passage = [f"line {i} of a passage that is shared" for i in range(40)]
    texts = [(1, "\n".join(["first text", *passage, "end of one"])), (2, "\n".join(["two", "other", "lines", *passage, "fin"]))]
    got = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1].n_removed_lines == 0 and got[2].n_removed_lines >= 30
    assert got[2].kept_text.startswith("two\nother\nlines")


def segmentations(lattices, unit):
    vocabulary = lattices.vocabulary
    number = {p: i for i, p in enumerate(vocabulary.pieces) if p}
    marked, found = unit.replace(" ", sentencepieces.MARK), {}

    def go(at, ids, weight):
        if at == len(marked):
            found[ids] = weight
            return
        for end in range(at + 1, min(len(marked), at + lattices.longest) + 1):
            piece = marked[at:end]
            if piece in number:
                go(end, (*ids, number[piece]), weight + vocabulary.weights[number[piece]])
            elif end == at + 1:
                raw = piece.encode()
                go(end, (*ids, *(vocabulary.first_byte + b for b in raw)), weight + len(raw) * vocabulary.weights[vocabulary.first_byte])

    go(0, (), 0.0)
    total = np.logaddexp.reduce(list(found.values()))
    return {ids: w - total for ids, w in found.items()}


def test_sampled_segmentations_follow_their_probabilities():
    lattices = sentencepieces.Lattices(sentencepieces.Vocabulary.read(sentencepieces.MODEL))
    units = sentencepieces.units_of("the ☃ban", lattices.unit)
    whole = {}
    for parts in itertools.product(*(segmentations(lattices, u).items() for u in units)):
        whole[tuple(x for p in parts for x in p[0])] = sum(p[1] for p in parts)
    assert abs(sum(map(math.exp, whole.values())) - 1) < 1e-9
    k, n, first, second, mean = 3, 3000, Counter(), Counter(), 0.0
    for key in range(n):
        nodes, seed = lattices.nodes(units), sentencepieces.row_seeds([key], 0)
        each = sentencepieces.mixed(np.repeat(seed, len(units)) + np.arange(len(units)).astype(np.uint64) * sentencepieces.BASE)
        fresh = [lattices.paths(nodes, sentencepieces.mixed(each + np.uint64(m) * sentencepieces.MULTIPLIERS[2:3])) for m in range(k)]
        samples = sentencepieces.TopK(lattices, int(seed[0]), fresh).run(k)
        ids = [tuple(sentencepieces.ids_of(lattices, s.edges).tolist()) for s in samples]
        assert len(set(ids)) == k and all(abs(whole[i] - s.log_prob) < 1e-4 for i, s in zip(ids, samples, strict=True))
        assert samples[0].perturbed > samples[1].perturbed > samples[2].perturbed
        first[ids[0]] += 1
        second[ids[:2][0], ids[1]] += 1
        mean += sum(math.exp(s.log_prob) / s.inclusion * len(i) for i, s in zip(ids, samples, strict=True)) / n
    best = sorted(whole, key=whole.get)[::-1][:3]
    for a in best:
        assert abs(first[a] / n - math.exp(whole[a])) < 0.03
        for b in best:
            if a != b:
                assert abs(second[a, b] / n - math.exp(whole[a] + whole[b]) / (1 - math.exp(whole[a]))) < 0.03
    assert abs(mean - sum(math.exp(p) * len(i) for i, p in whole.items())) < 0.05


def test_segmentations_decode(spark):
    odd = [(1, "  a\tb\n\nc▁d ☃🦉 x"), (2, "　ｆｕｌｌ  width "), (3, "a" * 3000), (4, "..!?  --x_y's"), (5, "▁")]
    got = sentencepieces.sampled_pieces(spark.createDataFrame(odd, "doc_id long, text string"), sentencepieces.Vocabulary.read(sentencepieces.MODEL))
    rows = got.collect()
    assert len(rows) >= 9 and all(r.decodes for r in rows)
    assert queries.QUERIES["op6_sampled_pieces"](spark, FOLDER).filter("not decodes").count() == 0


def test_toxicity_on_held_out_rows(spark):
    scored = {r.doc_id: r for r in queries.QUERIES["op7_toxicity"](spark, LARGER).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{LARGER}/labels.parquet").to_pylist()}
    held = [(scored[d].score, y) for d, y in labels.items() if scored[d].held_out]
    assert all(scored[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d in scored)
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held for b, z in held if y and not z]
    assert np.mean(pairs) > 0.85
    wrong = sum(1 for s, y in held if s >= 0.7 and not y)
    assert wrong <= 0.03 * sum(1 for _, y in held if not y)


def test_suffix_tree_lm(spark):
    rows = documents()
    got = {r.doc_id: r for r in queries.QUERIES["op8_suffix_tree_lm"](spark, FOLDER).collect()}
    tokens = {d: [*words(t), None] for d, t in rows}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    counts = Counter(w for d in tokens if not held[d] for w in tokens[d])
    n, v = sum(counts.values()), len(counts)
    df = spark.createDataFrame([(d, t) for d, t in rows if not held[d]], "doc_id long, text string")
    tree = suffix_tree_lm.fit(df.select("text"))
    spread = 10 ** tree.log_p.astype(float)
    unseen = 256 - 4 - (tree.log_p.shape[1] - 1)  # bytes of the last class
    assert np.allclose(spread[:, :-1].sum(1) + unseen * spread[:, -1], 1, atol=2e-3)
    for doc, text in rows:
        row = got[doc]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[doc])
        assert (row.n_tokens, row.n_known, row.train_tokens, row.held_out) == (len(tokens[doc]), sum(counts[w] > 0 for w in tokens[doc]), n, held[doc])
        assert abs(row.base_score - base) < 1e-6 * max(1, abs(base))
        state, score = int(tree.follow[0, tree.class_of[10]]), 0.0
        for byte in " ".join(tokens[doc][:-1]).encode() + b"\n":
            score += float(tree.log_p[state, tree.class_of[byte]])
            state = int(tree.follow[state, tree.class_of[byte]])
        assert abs(row.score - score) < 1e-3 + 1e-5 * abs(score)


def test_streams():
    import pyarrow as pa

    got = streams_of(pa.array([" A b\n\n c ", None, "", "x"]))
    assert bytes(got.data) == b"a b c\n\n\nx\n" and got.starts.tolist() == [0, 6, 7, 8, 10]


def test_kd_shards(spark):
    got = kd_shards.op9_kd_shards(spark, LARGER).collect()
    texts = dict(documents(LARGER))
    sizes, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[texts[r.doc_id]].add(r.shard)
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) < 1.05 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())
    df = spark.createDataFrame(documents(), "doc_id long, text string")
    assert kd_shards.shard_by_bytes(df, target_bytes=100_000).select("shard").distinct().count() == 5


def linked(sets, percent):
    """The least key of each set's component, every pair with a common shingle being counted."""
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for doc in sorted(sets):
        shared = Counter(e for s in sets[doc] for e in holders[s])
        for other, n in shared.items():
            if 100 * n >= percent * (len(sets[doc]) + len(sets[other]) - n):
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
        for s in sets[doc]:
            holders[s].append(doc)
    return {d: find(d) for d in sets}


@pytest.mark.parametrize("tile_bytes", [jaccard_join.TILE_BYTES, 20_000])
def test_jaccard_join(spark, tile_bytes):
    """Also with tiles so small that components are cut into cells."""
    rows = documents(LARGER)
    sets = {}
    for doc, text in rows:
        w = words(text)
        sets[doc] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.near_duplicates(df, 4, 85, tile_bytes=tile_bytes).collect()
    assert {r.id: (r.n_shingles, r.component) for r in got} == {d: (len(sets[d]), c) for d, c in linked(sets, 85).items()}


def test_chained_near_copies_link(spark):
    """Each text is near the next only; a far chain is one group, and so is a large group of near copies."""
    base = [f"w{i}" for i in range(400)]
    chain = [(i, " ".join(base[8 * i : 8 * i + 200])) for i in range(20)]
    crowd = [(100 + i, " ".join([*base[:300], f"own{i}"])) for i in range(300)]
    df = spark.createDataFrame(chain + crowd, "doc_id long, text string")
    sets = {d: {tuple(words(t)[i : i + 5]) for i in range(len(words(t)) - 4)} for d, t in chain + crowd}
    want = linked(sets, 80)
    for size in (jaccard_join.TILE_BYTES, 30_000):
        assert {r.id: r.component for r in jaccard_join.near_duplicates(df, tile_bytes=size).collect()} == want
    assert len(set(want.values())) == 2


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        before = dict(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: c for x, c in root.items() if x != c}


def test_packed_counts():
    for counts in ([0, 1, 254, 255, 256, 2**31, 3], [], [255] * 5, [7] * 9):
        assert unpacked(packed(np.array(counts, dtype=np.uint32))).tolist() == counts


def test_pipeline(spark):
    """Every stage by itself: what it drops is what it is for, and nothing else goes."""
    docs = corpus_pipeline.table(spark, LARGER, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "sentencepiece"]
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.kept(stage(spark, docs, LARGER))
        assert docs.columns == corpus_pipeline.COLUMNS
        after = {r.doc_id: r.text for r in docs.collect()}
        gone = before.keys() - after.keys()
        split = {d: words(t) for d, t in before.items()}
        if name == "jaccard_join":
            sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()) for d, w in split.items()}
            assert gone == {d for d, c in linked(sets, 80).items() if d != c}
        if name == "decontamination":
            items = [words(r["text"]) for r in pq.read_table(f"{LARGER}/benchmark.parquet").to_pylist()]
            runs = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in items]
            held = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in split.items()}
            assert gone == {d for d in before if any(100 * len(r & held[d]) >= 80 * len(r) for r in runs)}
        assert all(after[d] == before[d] for d in after) or name == "line_dedup"
        before = after
    last = corpus_pipeline.run(spark, LARGER)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == before.keys()
