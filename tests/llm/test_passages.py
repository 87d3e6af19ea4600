"""Repeated passages of lines, wherever they stand and however short they are."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest

from postings.llm.line_dedup import dedup_passages, op5_line_dedup

FOLDER = "/root/testdata/sf0.001"


def left_of(rows):
    """By document the lines that stay, for rows in order of their keys."""
    seen, out = set(), {}
    for doc, text in rows:
        lines, gone = text.split("\n"), set()
        full = [i for i, line in enumerate(lines) if line.strip()]
        for a, b in zip(full, full[1:], strict=False):
            window = tuple(lines[a : b + 1])
            if window in seen:
                gone.update(range(a, b + 1))
            seen.add(window)
        out[doc] = ("\n".join(line for i, line in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def outcomes(df):
    return {r.doc_id: (r.kept_text, r.n_lines, r.n_removed_lines) for r in df.collect()}


def test_short_passages_inside_documents_go_whole(spark):
    rows, want = [], {}
    for size in range(2, 7):
        for trial in range(6):
            passage = [f"line {i} of passage {trial} of {size} lines" for i in range(size)]
            first, second = 100 * size + 2 * trial, 100 * size + 2 * trial + 1
            around = lambda doc: ([f"{doc} opens", f"{doc} goes on"], [f"{doc} nears its end", f"{doc} ends"])
            for doc in (first, second):
                before, after = around(doc)
                rows.append((doc, "\n".join([*before, *passage, *after])))
            want[first] = (rows[-2][1], size + 4, 0)
            want[second] = ("\n".join([*before, *after]), size + 4, size)
    assert outcomes(dedup_passages(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_last_lines_blanks_and_single_lines(spark):
    rows = [(1, "a\nb\n\nc\nd"), (2, "x\nb\n\nc"), (3, "a\n\nz"), (4, "c\nd"), (5, "d\nq\nd\nq"), (6, "a\nb\nc"), (7, "")]
    got = outcomes(dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == left_of(rows)
    assert got[2] == ("x", 4, 3) and got[3][2] == 0 and got[4] == ("", 2, 2) and got[5] == ("d\nq", 4, 2) and got[6] == ("c", 3, 2)


@pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no tables")
def test_query_matches_brute_force(spark):
    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert outcomes(op5_line_dedup(spark, FOLDER)) == left_of(sorted((r["doc_id"], r["text"] or "") for r in table))
