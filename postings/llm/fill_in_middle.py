"""Fill-in-the-middle examples: cuts found by a Fenwick tree over fixed blocks of a text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The sentinels that mark the three parts, and the salt before a row's key.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SALT = "1:"
#: Code points in a block of the tree.
BLOCK = 256
#: Percent of rows left plain, and percent of the others in suffix-prefix-middle order.
PLAIN_PERCENT = 10
SPM_PERCENT = 20
#: Code points of text a task holds before it hands over a batch.
CHUNK_CHARS = 4_000_000
UNITS = ("code_point", "utf16", "byte")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def unit_widths(code_points: np.ndarray, unit: str) -> np.ndarray:
    """How many units each code point is: 1; 1 or 2 in UTF-16; 1 to 4 in UTF-8."""
    if unit == "code_point":
        return np.ones(len(code_points), np.int64)
    if unit == "utf16":
        return 1 + (code_points >= 0x10000).astype(np.int64)
    if unit == "byte":
        return 1 + (code_points >= 0x80) + (code_points >= 0x800) + (code_points >= 0x10000).astype(np.int64)
    raise ValueError(f"unit is one of {UNITS}")


class BlockTree:
    """A Fenwick tree over fixed blocks of a text, each holding its units and code points.

    ``cut(u)`` is the number of code points before unit ``u``: binary lifting over the tree finds
    the blocks that end at or before ``u``, then the block after them is searched locally. A cut
    inside a code point goes to its start.
    """

    def __init__(self, widths: np.ndarray, block: int = BLOCK):
        self.widths = widths
        self.block = block
        starts = np.arange(0, len(widths), block)
        units = np.add.reduceat(widths, starts) if len(widths) else np.zeros(0, np.int64)
        points = np.minimum(block, len(widths) - starts)
        self.size = len(starts)
        self.units = np.zeros(self.size + 1, np.int64)
        self.points = np.zeros(self.size + 1, np.int64)
        self.units[1:], self.points[1:] = units, points
        for i in range(1, self.size + 1):  # each node passes its sums up to its parent
            parent = i + (i & -i)
            if parent <= self.size:
                self.units[parent] += self.units[i]
                self.points[parent] += self.points[i]
        self.total = int(units.sum()) if self.size else 0

    def cut(self, unit: int) -> int:
        """Code points whose units all lie before ``unit`` (0 to the text's length)."""
        at, units, points = 0, 0, 0
        step = 1 << self.size.bit_length()
        while step:
            nxt = at + step
            if nxt <= self.size and units + self.units[nxt] <= unit:
                at, units, points = nxt, units + int(self.units[nxt]), points + int(self.points[nxt])
            step >>= 1
        first = at * self.block  # the block after ``at`` full blocks holds the boundary
        inside = np.cumsum(self.widths[first : first + self.block])
        return points + int(np.searchsorted(inside, unit - units, side="right"))


def seeds(key: int | None) -> tuple[int, int, int, int] | None:
    """h1 to h4: the first four groups of eight hex digits of sha256(SALT + key)."""
    if key is None:
        return None
    digest = hashlib.sha256(f"{SALT}{key}".encode()).hexdigest()
    return tuple(int(digest[8 * i : 8 * i + 8], 16) for i in range(4))


def fim_example(key: int | None, text: str, unit: str = "code_point", block: int = BLOCK) -> tuple[int, str, int | None, int | None, str]:
    """(n units, form, prefix and middle code points, output) of one text.

    Prefix ends after min(h1, h2) mod (n + 1) units, middle after the larger. The text stays
    plain if it is empty, holds a sentinel, has no key, or h3 mod 100 >= PLAIN_PERCENT's rest;
    otherwise suffix-prefix-middle if h4 mod 100 < SPM_PERCENT, else prefix-suffix-middle.
    """
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    widths = unit_widths(points, unit)
    tree = BlockTree(widths, block)
    n = tree.total
    h = seeds(key)
    if n == 0 or h is None or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= 100 - PLAIN_PERCENT:
        return n, "plain", None, None, text
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = tree.cut(lo), tree.cut(hi)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < SPM_PERCENT:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restored(output: Column, form: Column) -> Column:
    """The text again, from an example and its form; a sentinel is never inside a part."""
    before = lambda mark: F.substring_index(output, mark, 1)
    after = lambda mark: F.substring_index(output, mark, -1)
    psm = F.concat(F.substring(before(SUFFIX), len(PREFIX) + 1, 1 << 30), after(MIDDLE), F.substring_index(after(SUFFIX), MIDDLE, 1))
    spm = F.concat(F.substring_index(after(PREFIX), MIDDLE, 1), after(MIDDLE), F.substring(before(PREFIX), len(SUFFIX) + 1, 1 << 30))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "code_point", block: int = BLOCK) -> DataFrame:
    """An example for every row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output.

    ``n`` counts ``unit``s (code points, UTF-16 units or UTF-8 bytes); prefix and middle are
    code points, null when plain. A null text is empty and so plain, as is a null key. Repeated
    rows each give their example; other columns, whatever their names, are not carried. An
    empty table gives no row. Texts are whole, however long; a task holds a few MB of them.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}")

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        chars = 0
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                t = t or ""
                rows.append((k, *fim_example(k, t, unit, block)))
                chars += len(t) + 100
                if chars > CHUNK_CHARS:
                    yield pa.RecordBatch.from_pylist([dict(zip(NAMES, r, strict=True)) for r in rows], schema=ARROW)
                    rows, chars = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(NAMES, r, strict=True)) for r in rows], schema=ARROW)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(examples, SCHEMA)


NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())])


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples of all documents by code points, with digests of each output and the text it restores."""
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: The same rows in DuckDB SQL: cuts by substring over code points; the restored text is the text.
OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || doc_id::VARCHAR) AS hx FROM documents),
h AS (
  SELECT doc_id, t, n,
         ('0x' || substr(hx, 1, 8))::UBIGINT AS h1, ('0x' || substr(hx, 9, 8))::UBIGINT AS h2,
         ('0x' || substr(hx, 17, 8))::UBIGINT AS h3, ('0x' || substr(hx, 25, 8))::UBIGINT AS h4
  FROM d),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS lo, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS hi,
         CASE WHEN n = 0 OR doc_id IS NULL OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
o AS (
  SELECT doc_id, t, n, form, lo, hi,
         CASE form WHEN 'plain' THEN t
                   WHEN 'psm' THEN '<P>' || substring(t, 1, lo) || '<S>' || substring(t, hi + 1) || '<M>' || substring(t, lo + 1, hi - lo)
                   ELSE '<S>' || substring(t, hi + 1) || '<P>' || substring(t, 1, lo) || '<M>' || substring(t, lo + 1, hi - lo) END AS output
  FROM c)
SELECT doc_id, n, form,
       CASE WHEN form = 'plain' THEN NULL ELSE lo END AS prefix_chars,
       CASE WHEN form = 'plain' THEN NULL ELSE hi - lo END AS middle_chars,
       sha256(output) AS output_sha256, sha256(t) AS restored_sha256
FROM o
"""
