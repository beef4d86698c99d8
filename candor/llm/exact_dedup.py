"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every row gets the fingerprint and the SHA-256 of its text without white space; only these, the id and the length are kept.
2. Senders are blocks of at most ``BLOCK_ROWS`` rows of a partition. A sender sorts its distinct fingerprints, cuts them by range to
   their owners, and Golomb-codes the gaps (Rice's form: quotients in unary, remainders in a fixed number of bits). Fingerprints are cut to
   ``log2(rows) + SPARE_BITS`` bits, so a gap costs few bits and about one unique text in a thousand is suspected by chance.
3. An owner decodes the lists of its range, finds the fingerprints that several senders hold or one holds twice, and answers every list
   with a bitmap. A fingerprint is in a sender's list once, so an owner gets at most one entry of a text from each sender.
4. Senders read off their suspects. These set bits of a filter of 2^26 bits, held as at most 2^20 rows of 64 bits: that is the proven
   bound of what is broadcast. The texts are read again; those that miss the filter are unique and are never shuffled.
5. The remaining texts are verified byte by byte: they are grouped by the text itself, combined inside each task before the shuffle,
   so copies cost one row a task however many there are. With more suspects than the filter can tell apart, more unique texts come here;
   the result stays exact.

The verified groups then join the rows of step 1. Groups with a thousandth of all rows or more (at most a thousand groups) are broadcast, and so are all others while
they are few; beyond that the others join by a shuffle in which no key has more than a thousandth of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.llm import common as C

SPARE_BITS = 10
BLOCK_ROWS = 1 << 20
OWNER_KEYS = 1 << 22  # of one owner, at most
SMALL_OWNER_KEYS, SMALL_OWNERS = 1 << 14, 64  # smaller tables are dealt to up to so many owners
FILTER_BITS = 26
MAX_BROADCAST_GROUPS = 200_000  # rows of about 80 bytes
HOT_SHARE = 1000  # a group with one row in so many or more is hot
BLANK = r"[\x20\x09-\x0D]+"


def golomb_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Rice parameter and code of rising distinct numbers under 2^63."""
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    if not len(gaps):
        return 0, b""
    mean = float(gaps.mean()) + 1
    k = max(0, int(np.floor(np.log2(mean * np.log(2)))))
    quotient = gaps >> k
    zeros = np.cumsum(quotient + 1) - 1
    unary = np.ones(int(zeros[-1]) + 1, dtype=np.uint8)
    unary[zeros] = 0
    rest = (gaps[:, None] >> np.arange(k - 1, -1, -1)) & 1
    return k, np.packbits(unary).tobytes() + np.packbits(rest.astype(np.uint8).ravel()).tobytes()


def golomb_decode(n: int, k: int, code: bytes) -> np.ndarray:
    """The ``n`` numbers that ``golomb_encode`` was given."""
    if not n:
        return np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(code, dtype=np.uint8)
    tail = -(-n * k // 8)  # bytes of the remainders
    zeros = np.flatnonzero(np.unpackbits(raw[:len(raw) - tail]) == 0)[:n]
    quotient = np.diff(zeros, prepend=-1) - 1
    rest = np.unpackbits(raw[len(raw) - tail:])[:n * k].reshape(n, k).astype(np.int64) @ (np.int64(1) << np.arange(k - 1, -1, -1))
    return np.cumsum((quotient << k) + rest + 1) - 1


_MESSAGE = "owner INT, sender INT, block INT, n INT, k INT, code BINARY, own BINARY"
_NAMES = [f.split()[0] for f in _MESSAGE.split(", ")]
_TYPES = [pa.int32()] * 5 + [pa.binary()] * 2


def _send(bits: int, owner_bits: int):
    """Messages of a partition of fingerprints: for each block and owner the coded list, and which of them the block holds more than once."""

    def messages(keys: np.ndarray, block: int) -> pa.RecordBatch:
        keys, counts = np.unique(keys, return_counts=True)
        span = bits - owner_bits
        owners = np.arange((1 << owner_bits) + 1, dtype=np.int64) << span
        at = np.searchsorted(keys, owners)
        sender = TaskContext.get().partitionId()
        out = []
        for o in np.flatnonzero(np.diff(at)).tolist():
            own = slice(at[o], at[o + 1])
            k, code = golomb_encode(keys[own] - owners[o])
            out.append((o, sender, block, at[o + 1] - at[o], k, code, np.packbits(counts[own] > 1).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, block = [], 0, 0
        for batch in batches:
            key = batch.column("fp").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            while len(key):
                some = key[:BLOCK_ROWS - rows].astype(np.int64)
                key, rows = key[len(some):], rows + len(some)
                held.append(some)
                if rows == BLOCK_ROWS:
                    yield messages(np.concatenate(held), block)
                    held, rows, block = [], 0, block + 1
        if rows:
            yield messages(np.concatenate(held), block)

    return send


def _answer(part: pa.Table) -> pa.Table:
    """The owner's side: for each list a bitmap of the fingerprints that are held elsewhere, or more than once."""
    n = part.column("n").to_pylist()
    lists = [golomb_decode(*x) for x in zip(n, part.column("k").to_pylist(), part.column("code").to_pylist())]
    own = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8))[:m] for x, m in zip(part.column("own").to_pylist(), n)])
    _, place, held = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    twice = ((held > 1) | (np.bincount(place, weights=own, minlength=len(held)) > 0))[place]
    ends = np.cumsum([0, *n]).tolist()
    bitmap = pa.array([np.packbits(twice[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())
    return part.select(["owner", "sender", "block"]).append_column("bitmap", bitmap)


def _suspects(bits: int, owner_bits: int):
    """The sender's side: the suspected fingerprints of each answered list."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for o, n, k, code, bitmap in zip(*(batch.column(c).to_pylist() for c in ("owner", "n", "k", "code", "bitmap"))):
                keys = golomb_decode(n, k, code) + (o << (bits - owner_bits))
                yield pa.RecordBatch.from_arrays([pa.array(keys[np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n] == 1])], names=["key"])

    return read


def suspected(fingerprints: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """``key`` (repeated across senders) of all fingerprints held more than once, and their number of bits.

    ``fingerprints(fp)`` must be materialised, so that a repeated task numbers its blocks alike.
    """
    bits = min(62, max(1, rows).bit_length() + SPARE_BITS)
    owners = max(rows / OWNER_KEYS, min(SMALL_OWNERS, rows / SMALL_OWNER_KEYS), 1)
    owner_bits = int(np.ceil(np.log2(owners)))
    sent = C.cut(fingerprints.select("fp").mapInArrow(_send(bits, owner_bits), _MESSAGE))
    answers = sent.groupBy("owner").applyInArrow(_answer, "owner INT, sender INT, block INT, bitmap BINARY")
    received = sent.join(answers, ["owner", "sender", "block"])
    return received.mapInArrow(_suspects(bits, owner_bits), "key LONG"), bits


def normalised(text: Column) -> Column:
    """The text without white space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def _slot(fp: str, bits: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - bits).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def _filtered(df: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """``df(fp, ...)`` with ``hit``: whether the fingerprint's bit is set in the filter."""
    slot = _slot("fp", bits)
    bit = F.expr("shiftright(word, cast(slot & 63 as int)) & 1 = 1")
    joined = df.withColumn("slot", slot).withColumn("at", F.shiftright("slot", 6)).join(F.broadcast(words), "at", "left")
    return joined.withColumn("hit", F.coalesce(bit, F.lit(False))).drop("slot", "at", "word")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical without the characters U+0009 to U+000D and U+0020. Of equal texts, the row with the most code points in
    the original text stays, then the smallest ``doc_id`` (NULL last); of rows that repeat id and length too, exactly one stays. NULL texts
    count as empty; all empty and blank texts are equal. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    measured = src.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), normalised(F.col("text")).alias("norm"))
    rows = C.cut(measured.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", F.xxhash64("norm").alias("fp"),
                                 F.unhex(F.sha2("norm", 256)).alias("sha")))
    n_rows = rows.count()
    keys, bits = suspected(rows, n_rows)
    slots = keys.select(F.col("key").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("slot"))
    words = C.cut(slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("word")), narrow=True)

    texts = _filtered(src.select(normalised(F.col("text")).alias("norm")).withColumn("fp", F.xxhash64("norm")), words, bits).where("hit")
    verified = texts.groupBy("norm").agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    named = verified.select(F.xxhash64("norm").alias("fp"), F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size")

    marked = _filtered(rows, words, bits)
    hits = marked.where("hit").drop("hit")
    # The complement of a number falls as the number rises, without overflow.
    order = F.struct("n_chars", F.col("doc_id").isNotNull().alias("named"), F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row"))
    leaders = hits.groupBy("fp", "sha").agg(F.max(order).alias("best"))
    groups = C.cut(named.join(leaders, ["fp", "sha"]).select("fp", "sha", "group_size", F.bitwise_not("best.id").alias("keep_id"), F.bitwise_not("best.row").alias("keep_row")), narrow=True)

    def shown(df: DataFrame) -> DataFrame:
        grouped = F.col("group_size").isNotNull()
        return df.select("doc_id", F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                         F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))

    none = [F.lit(None).cast("long").alias(c) for c in ("group_size", "keep_id", "keep_row")]
    alone = shown(marked.where("not hit").select("row", "doc_id", "sha", *none))
    if groups.count() <= MAX_BROADCAST_GROUPS:
        return alone.unionByName(shown(hits.join(F.broadcast(groups), ["fp", "sha"], "left")))
    hot = F.broadcast(groups.where(F.col("group_size") * HOT_SHARE >= n_rows))
    usual = hits.join(hot.select("fp", "sha"), ["fp", "sha"], "left_anti")
    return alone.unionByName(shown(hits.join(hot, ["fp", "sha"]))).unionByName(
        shown(usual.join(groups.where(F.col("group_size") * HOT_SHARE < n_rows), ["fp", "sha"], "left")))
