"""Fill-in-the-middle transformation with a Fenwick tree over text blocks.

A text's UTF-8 bytes fall into blocks of ``BLOCK`` bytes. A Fenwick tree keeps
two counts per block: units (what cuts are counted in) and code points. A
binary-lifting descent finds the block in which a unit starts, with the units
and code points before it; only that block is then searched for the byte. So
a cut costs O(log blocks + BLOCK) after one pass over the bytes, and the text
is never decoded into code points.

Units: ``char`` (code points), ``word`` (a word with the white space before
it; white space at the end of a text goes to the last word), ``line`` (up to
and with its line feed).

The cut places, the choice between prefix-suffix-middle (``psm``),
suffix-prefix-middle (``spm``) and ``plain``, come from the SHA-256 of a seed
and the row's id, so reruns and other cluster sizes agree. Output pieces are
slices of the text's own buffer. No shuffle; a row is the unit of work.

Defined results: a null text counts as empty; an empty text and one that
holds a marker stay ``plain``. A null id counts as an id without digits.
Very long texts need their bytes, their output and one flag a byte. Rows equal
in id and text get equal results. Empty tables give empty results. Other columns, whatever
their names, pass through if named in ``keep``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from fareway.llm.common import small_batches, table

BLOCK = 4096
MARKERS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle

_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))


def unit_starts(data: np.ndarray, unit: str = "char") -> np.ndarray:
    """Per byte, whether a unit starts there. The first byte always starts one."""
    if unit == "char":
        return (data & 0xC0) != 0x80
    out = np.zeros(len(data), bool)
    if unit == "line":
        out[1:] = data[:-1] == 10
    elif unit == "word":
        space = _SPACE[data]
        out[1:] = space[1:] & ~space[:-1]  # white space after a word opens the next unit,
        filled = np.flatnonzero(~space)
        if len(filled):
            out[filled[-1] + 1:] = False  # unless no word follows
            out[:filled[0] + 1] = False  # and what precedes the first word belongs to it
        else:
            out[:] = False
    else:
        raise ValueError(f"unknown unit {unit}; one of char, word, line")
    if len(out):
        out[0] = True
    return out


class BlockTree:
    """Fenwick tree of (units, code points) over fixed blocks of bytes."""

    def __init__(self, data: np.ndarray, unit: str = "char", block: int = BLOCK) -> None:
        self.size, self.block = len(data), block
        self.starts = unit_starts(data, unit)
        self.chars = self.starts if unit == "char" else unit_starts(data)
        cuts = np.arange(0, self.size, block)
        counts = np.zeros((len(cuts) + 1, 2), np.int64)
        if len(cuts):
            counts[1:, 0] = np.add.reduceat(self.starts, cuts, dtype=np.int64)
            counts[1:, 1] = np.add.reduceat(self.chars, cuts, dtype=np.int64)
        before = counts.cumsum(axis=0)
        i = np.arange(len(before))
        self.tree = before - before[i - (i & -i)]  # node i sums its last lowbit(i) blocks
        self.units, self.code_points = (int(x) for x in before[-1])

    def seek(self, unit: int) -> tuple[int, int]:
        """Byte at which the unit starts (the end for ``units``), and the code points before it."""
        if unit >= self.units:
            return self.size, self.code_points
        tree, at, left, chars = self.tree, 0, unit, 0
        step = 1 << (len(tree) - 1).bit_length()
        while step:
            if at + step < len(tree) and tree[at + step, 0] <= left:
                at += step
                left -= int(tree[at, 0])
                chars += int(tree[at, 1])
            step >>= 1
        first = at * self.block
        byte = first + int(np.flatnonzero(self.starts[first:first + self.block])[left])
        return byte, chars + int(np.count_nonzero(self.chars[first:byte]))


@dataclass
class Rule:
    """``plain`` per cent of the texts stay as they are; ``spm`` per cent of the others start with the suffix."""

    seed: str = "1"
    plain: int = 10
    spm: int = 20
    unit: str = "char"
    markers: tuple[str, str, str] = MARKERS
    block: int = BLOCK


def draws(row_id, seed: str) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def transform(buffer, row_id, rule: Rule) -> tuple[int, str, int | None, int | None, list]:
    """Units of the text, form, code points of prefix and middle (None if plain), and the output's pieces in order."""
    view = memoryview(buffer)
    data = np.frombuffer(view, np.uint8)
    tree = BlockTree(data, rule.unit, rule.block)
    h1, h2, h3, h4 = draws(row_id, rule.seed)
    marks = [m.encode() for m in rule.markers]
    whole = bytes(view)
    if not whole or h3 % 100 >= 100 - rule.plain or any(m in whole for m in marks):
        return tree.units, "plain", None, None, [view]
    first, second = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
    a, chars_a = tree.seek(first)
    b, chars_b = tree.seek(second)
    prefix, middle, suffix = view[:a], view[a:b], view[b:]
    p, s, m = marks
    if h4 % 100 < rule.spm:
        return tree.units, "spm", chars_a, chars_b - chars_a, [s, suffix, p, prefix, m, middle]
    return tree.units, "psm", chars_a, chars_b - chars_a, [p, prefix, s, suffix, m, middle]


def restore(output: bytes, form: str, markers: tuple[str, str, str] = MARKERS) -> list:
    """Pieces of the exact text. No marker can arise across a seam, as none ends with how one begins."""
    view = memoryview(output)
    if form == "plain":
        return [view]
    p, s, m = (x.encode() for x in markers)
    if form == "psm":
        at_s = output.index(s, len(p))
        at_m = output.index(m, at_s + len(s))
        prefix, suffix = view[len(p):at_s], view[at_s + len(s):at_m]
    else:
        at_p = output.index(p, len(s))
        at_m = output.index(m, at_p + len(p))
        suffix, prefix = view[len(s):at_p], view[at_p + len(p):at_m]
    return [prefix, view[at_m + len(m):], suffix]


def _sha256(pieces: list) -> str:
    state = hashlib.sha256()
    for piece in pieces:
        state.update(piece)
    return state.hexdigest()


def fill_in_middle(docs: DataFrame, rule: Rule | None = None, id_col: str = "doc_id", text: str = "text",
                   keep: tuple[str, ...] = ("doc_id",), digest: bool = False) -> DataFrame:
    """``keep`` plus ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``, or with ``digest`` the hashes
    of the output and of the text restored from it."""
    rule = rule or Rule()
    last = ["output_sha256", "restored_sha256"] if digest else ["output"]
    names = [*keep, "n", "form", "prefix_chars", "middle_chars", *last]
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[] for _ in names[len(keep):]]
            for row_id, cell in zip(b["_fim_id"].to_pylist(), b["_fim_text"], strict=True):
                n, form, prefix, middle, pieces = transform(cell.as_buffer() or b"", row_id, rule)
                output = b"".join(pieces)
                if digest:
                    end = [hashlib.sha256(output).hexdigest(), _sha256(restore(output, form, rule.markers))]
                else:
                    end = [output.decode()]
                for column, value in zip(rows, [n, form, prefix, middle, *end], strict=True):
                    column.append(value)
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * len(last)]
            yield pa.RecordBatch.from_arrays([*[b[i] for i in range(len(keep))], *[
                pa.array(v, t) for v, t in zip(rows, types, strict=True)]], names)

    return docs.select(*keep, docs[id_col].cast("string").alias("_fim_id"), docs[text].cast("string").alias("_fim_text")).mapInArrow(
        run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return fill_in_middle(table(spark, sf_dir, "documents"), digest=True)


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1, n - b) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
           ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""
