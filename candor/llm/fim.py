"""Fill-in-the-middle transformation of texts, cut at line ends.

A text's UTF-8 bytes stand in blocks of ``BLOCK`` bytes. A Fenwick tree over the blocks stores the line ends and the code
points of each block. The cut after ``k`` lines is found by binary lifting down the tree: the block that holds the ``k``-th line end,
and the code points before it, in a logarithm of the number of blocks; the boundary is then located inside that one block.
Documents are independent, so there is no shuffle, and a task holds one chunk of texts at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.llm import common as C

BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE = 100  # of 100 documents, those that are transformed
SPM = 50  # of 100 transformed ones, those with the suffix first
_NEWLINE = 10


class BlockTree:
    """Fenwick tree over the fixed blocks of a UTF-8 text: line ends and code points of the blocks below each node."""

    def __init__(self, raw: np.ndarray, block: int = BLOCK):
        self.raw, self.block = raw, block
        starts = np.arange(0, len(raw), block)
        self.blocks = len(starts)
        self.tree = np.zeros((self.blocks + 1, 2), dtype=np.int64)
        if self.blocks:
            self.tree[1:, 0] = np.add.reduceat((raw == _NEWLINE).astype(np.int64), starts)
            self.tree[1:, 1] = np.add.reduceat(_leads(raw).astype(np.int64), starts)
        self.line_ends, self.chars = self.tree[1:].sum(axis=0).tolist()
        # Of node i's parent i + (i & -i), children come in rising steps: a step adds all nodes of one lowest bit at once.
        step = 1
        while step < self.blocks:
            child = np.arange(step, self.blocks + 1, 2 * step)
            child = child[child + step <= self.blocks]
            self.tree[child + step] += self.tree[child]
            step *= 2

    @property
    def lines(self) -> int:
        """Line ends, and one more for a last line without one."""
        return self.line_ends + int(len(self.raw) > 0 and self.raw[-1] != _NEWLINE)

    def add(self, block: int, line_ends: int, chars: int) -> None:
        """Change the counts of one block (from 0), as after an edit of its bytes."""
        i = block + 1
        while i <= self.blocks:
            self.tree[i] += (line_ends, chars)
            i += i & -i

    def cut(self, k: int) -> tuple[int, int]:
        """Byte offset and number of code points of the first ``k`` lines."""
        if k <= 0:
            return 0, 0
        if k > self.line_ends:
            return len(self.raw), self.chars
        at, ends, chars = 0, 0, 0
        step = 1 << (self.blocks.bit_length() - 1)
        while step:
            if at + step <= self.blocks and ends + self.tree[at + step, 0] < k:
                at += step
                ends, chars = ends + int(self.tree[at, 0]), chars + int(self.tree[at, 1])
            step >>= 1
        begin = at * self.block
        own = self.raw[begin:begin + self.block]
        end = int(np.flatnonzero(own == _NEWLINE)[k - ends - 1]) + 1
        return begin + end, chars + int(_leads(own[:end]).sum())


def _leads(raw: np.ndarray) -> np.ndarray:
    """Bytes that begin a code point."""
    return (raw & 0xC0) != 0x80


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers of a document; a NULL id counts as the empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4)]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: each text cut at two line ends and put in another order.

    ``n`` is the number of lines. ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``
    (unchanged; lengths NULL): empty texts, texts with one of the marks, and those beyond ``rate`` of 100. Cuts and form depend on
    ``doc_id`` and ``seed`` only. NULL texts count as empty, a NULL id draws as the empty string; repeated rows are each answered. An empty table
    gives no rows; other columns are ignored, whatever their names.
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    marks = {x: x.encode() for x in (PREFIX, SUFFIX, MIDDLE)}

    def one(doc: int | None, raw: np.ndarray) -> tuple:
        tree = BlockTree(raw)
        n = tree.lines
        h1, h2, h3, h4 = draws(doc, seed)
        own = raw.tobytes()
        if not own or h3 % 100 >= rate or any(m in own for m in marks.values()):
            return n, "plain", None, None, own
        (a, before), (b, upto) = (tree.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
        prefix, middle, suffix = marks[PREFIX] + own[:a], marks[MIDDLE] + own[a:b], marks[SUFFIX] + own[b:]
        form, order = ("spm", (suffix, prefix, middle)) if h4 % 100 < spm else ("psm", (prefix, suffix, middle))
        return n, form, before, upto - before, b"".join(order)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off, _ = C.text_buffers(batch.column("text"))
            for lo, hi in C.row_chunks(np.diff(off)):
                ids = batch.column("doc_id").slice(lo, hi - lo)
                cols = list(zip(*(one(d, raw[off[lo + i]:off[lo + i + 1]]) for i, d in enumerate(ids.to_pylist()))))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
                arrays = [ids, *(pa.array(c, k) for c, k in zip(cols, kinds)), pa.array(cols[4], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return src.mapInArrow(rows, "doc_id LONG, n LONG, form STRING, prefix_chars LONG, middle_chars LONG, output STRING")


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` was given, from its output and form. Marks occur once each in a transformed text."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
