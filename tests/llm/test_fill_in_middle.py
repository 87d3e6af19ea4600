"""op12: cuts of the block tree against a plain scan, exact restoration, odd rows."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postings.llm import fill_in_middle as fim

ALPHABET = "ab \n\té€😀<>PSM"


def plain_cut(text, unit, u):
    """Code points whose units all end at or before u, by walking the text."""
    width = {"code_point": lambda c: 1, "utf16": lambda c: 2 if ord(c) >= 0x10000 else 1, "byte": lambda c: len(c.encode())}[unit]
    total = 0
    for i, c in enumerate(text):
        total += width(c)
        if total > u:
            return i
    return len(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=700), st.sampled_from(fim.UNITS), st.sampled_from([1, 2, 7, 256]), st.data())
def test_tree_cuts_like_a_scan(text, unit, block, data):
    import numpy as np

    widths = fim.unit_widths(np.frombuffer(text.encode("utf-32-le"), np.uint32), unit)
    tree = fim.BlockTree(widths, block)
    assert tree.total == sum(widths)
    u = data.draw(st.integers(0, tree.total))
    assert tree.cut(u) == plain_cut(text, unit, u)


def test_forms_follow_the_seeds():
    for key in range(300):
        text = f"text number {key} with some words é😀"
        n, form, a, m, out = fim.fim_example(key, text)
        h = [int(hashlib.sha256(f"1:{key}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
        lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        expected = "plain" if h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
        assert (n, form) == (len(text), expected)
        if form != "plain":
            assert (a, m) == (lo, hi - lo)


def test_every_form_restores(spark):
    rng = random.Random(3)
    rows = [(k, "".join(rng.choice(ALPHABET[:7]) for _ in range(rng.randrange(0, 90)))) for k in range(400)]
    rows += [(1000, "has <P> inside"), (1001, None), (1002, ""), (None, "no key"), (5, rows[5][1]), (1003, "long é😀 " * 30000)]
    for unit in fim.UNITS:
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("output", fim.F.lit("clash"))
        out = fim.fill_in_middle(df, unit=unit)
        back = out.select("doc_id", "form", "n", fim.restored(out["output"], out["form"]).alias("back")).collect()
        assert sorted((r.doc_id or -1, r.back) for r in back) == sorted((k or -1, t or "") for k, t in rows)
        forms = {r.form for r in back}
        assert forms == {"plain", "psm", "spm"}
        by = {r.doc_id: r for r in back}
        assert by[1000].form == by[1001].form == by[1002].form == by[None].form == "plain"
        assert by[1003].n == {"code_point": 240000, "utf16": 270000, "byte": 360000}[unit]
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_unknown_unit():
    with pytest.raises(ValueError):
        fim.fim_example(1, "x", unit="word")
