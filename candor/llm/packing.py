"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

Packing: every piece goes where the sum, over all residual gaps, of the squared number of open
bins with that gap becomes smallest (new bins compete with open ones). The state is one count for
each gap. Pieces are dealt by row number to shards of about ``SHARD_PIECES`` pieces (repeated rows spread like others),
each packed on its own, so tasks stay small at any input size. A shard is packed longest piece
first; then the bins that are not full are emptied and their pieces packed again, in mixed and in
falling order by turns, while that saves bins.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm import common as C

CAPACITY = 1024
END_ID = 2
SHARD_PIECES = 1 << 16
PASSES = 4


class Encoder:
    """Ids of the tokenizer file ``path``. ``ranks``, the same vocabulary as ranks, encodes most texts faster.

    Texts that the rank encoder refuses (its pattern search gives up on huge runs of white space)
    go to the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens=self.special)

    def encode(self, text: str) -> np.ndarray:
        try:
            ids = self.fast.encode(text, allowed_special="all")
        except (ValueError, RuntimeError):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=np.uint32)


def cut_pieces(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: all full but the first."""
    first = n % capacity or capacity
    return [(0, first), *((a, capacity) for a in range(first, n, capacity))]


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length, placed in the given order.

    Moving a bin from gap ``g`` to ``g - s`` changes the sum of squares by
    ``2 * (count[g - s] - count[g]) + 2``; filling it by ``1 - 2 * count[g]``; a new bin adds
    ``2 * count[capacity - s] + 1``. Ties go to the smallest gap, an open bin before a new one.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    held = np.full(capacity + 1, -(1 << 40), dtype=np.int64)  # count, or very few where there is none
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bin_of = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        gap = capacity
        if s < capacity:
            change = 2 * (count[:capacity - s] - held[s:capacity]) + 2
            change[0] -= 1
            best = int(change.argmin())
            if change[best] <= 2 * count[capacity - s] + 1:
                gap = best + s
        if gap == capacity:
            b, made = made, made + 1
        else:
            b = bins[gap].pop()
            count[gap] -= 1
            held[gap] = count[gap] or -(1 << 40)
        bin_of[i], offset[i] = b, capacity - gap
        rest = gap - s
        if rest:
            bins[rest].append(b)
            count[rest] += 1
            held[rest] = count[rest]
    return bin_of, offset


def pack_shard(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length: falling order first, then repeated packing of open bins."""
    falling = np.argsort(-lengths, kind="stable")
    mixed = np.argsort(C.mix(np.arange(len(lengths), dtype=np.uint64)), kind="stable")
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    bin_of[falling], offset[falling] = sum_of_squares(lengths[falling], capacity)
    for k in range(PASSES if len(lengths) else 0):
        fill = np.bincount(bin_of, weights=lengths)
        loose = fill[bin_of] < capacity
        order = (mixed, falling)[k % 2]
        again = order[loose[order]]
        new_bin, new_offset = sum_of_squares(lengths[again], capacity)
        closed = np.flatnonzero(fill == capacity)
        rank = np.zeros(len(fill), np.int64)
        rank[closed] = np.arange(len(closed))
        if len(again) and new_bin.max() + 1 + len(closed) <= len(fill):
            bin_of[~loose] = rank[bin_of[~loose]]
            bin_of[again], offset[again] = new_bin + len(closed), new_offset
    return bin_of, offset


def tokenised_pieces(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
                     capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of each document's ids, ``END_ID`` last."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks, pattern)
        for batch in batches:
            sizes = np.diff(C.text_buffers(batch.column("text"))[1])
            for lo, hi in C.row_chunks(sizes):
                rows = batch.slice(lo, hi - lo)
                out: list[tuple] = []
                for doc, ids in zip(rows.column("doc_id").to_pylist(), map(encoder.encode, rows.column("text").to_pylist())):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    for k, (start, length) in enumerate(cut_pieces(len(ids), capacity)):
                        own = ids[start:start + length]
                        out.append((doc, k, start, length, zlib.crc32(own.tobytes()), own))
                cols = list(zip(*out))
                arrays = [pa.array(c, t) for c, t in zip(cols[:5], (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in cols[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG" + ", ids ARRAY<INT>" * with_ids
    return src.mapInArrow(pieces, schema)


def pack(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         with_ids: bool = False) -> DataFrame:
    """Pieces with their place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    A document's ids are those of its text followed by ``END_ID``; only documents of more than
    ``capacity`` ids are cut. Sequences hold at most ``capacity`` ids without gaps.
    NULL and empty texts are the one id ``END_ID``. Repeated rows and NULL ``doc_id`` are packed row
    by row. An empty table gives no rows. Other columns are ignored.
    """
    pieces = C.cut(tokenised_pieces(docs, tokenizer, ranks, pattern, doc_id, text, capacity, with_ids))
    n = pieces.count()
    shards = max(1, round(n / SHARD_PIECES))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def place(part: pa.Table) -> pa.Table:
        part = part.sort_by([(c, "ascending") for c in ("ids_crc32", "doc_id", "piece")])
        bin_of, offset = pack_shard(part.column("length").to_numpy(), capacity)
        shard = part.column("shard")[0].as_py()
        return part.drop_columns(["shard"]).append_column("sequence_id", pa.array(bin_of * shards + shard)).append_column("offset", pa.array(offset))

    fields = ", ".join(f"{c} {t}" for c, t in pieces.dtypes) + ", sequence_id LONG, offset LONG"
    return dealt.groupBy("shard").applyInArrow(place, fields)
