"""Near-duplicate detection with HyperMinHash sketches.

A document is its set of distinct five-word shingles (see ``shingle_sets``). The work runs on
distinct sets ("nodes"), so that copies cost one row however many there are:

1. Each set is reduced to ``N_BUCKETS`` registers. A shingle hash picks a bucket; the bucket keeps
   the smallest second hash, stored as its leading-zero count (6 bits) and the ``MANTISSA`` bits
   after the leading one. Empty buckets copy another bucket chosen by a fixed probe sequence.
2. Registers are banded: 32 bands of 7 for a similarity of 0.85 and more, 37 of 6 for 0.8. Two sets just at
   the threshold miss each other in all bands with probability (1 - 0.85^7)^32 = 4e-6 or (1 - 0.8^6)^37 = 1e-5.
3. Within a bucket of equal bands, all sets are first compared with the bucket's smallest node
   (a star, linear in the bucket). Links that hold contract the graph; afterwards only sets of one
   bucket that are still in different components are compared with one another: as pairs in buckets
   of at most ``FEW`` sets, else block by block, where a task compares two blocks of bounded size
   and returns only links that join components. No row is made for a pair of a large bucket, and
   no link between components is lost.
4. A candidate pair first passes the sketches: matching registers, corrected for the registers
   that agree by chance (``chance_matches``), give an estimate of the similarity. Pairs whose estimate
   is more than five standard errors under the threshold are left out; all others are confirmed
   on the full shingle sets (integer arithmetic, 64-bit shingle hashes).

Components are found by alternating star contractions on tables; every iteration is cut by a
reliable checkpoint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.llm import common as C

SHINGLE = 5
N_BUCKETS = 224
MANTISSA = 10
PROBES = 64
PERCENT = 85  # 100 * intersection >= 85 * union
SIGMAS = 5.0
FEW = 32
BLOCK_SETS, BLOCK_SHINGLES = 256, 100_000
BLOCK_ROWS = 4  # block pairs in an Arrow batch
COLUMNS = 4096  # shingles compared at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BYTE_HASH = C.constants(256, 3)[_LOWER]
_SLOT = C.constants(SHINGLE, 4)
_BAND = C.constants(16, 5)
_BAND_SEED = C.constants(N_BUCKETS, 6)
_PROBE = (C.mix(np.arange(PROBES * N_BUCKETS, dtype=np.uint64) + np.uint64(1 << 40)) % np.uint64(N_BUCKETS)).astype(np.int64).reshape(PROBES, N_BUCKETS)
_FREE = np.uint64((1 << 64) - 1)


# ---------------------------------------------------------------------------------------------
# Shingle sets and sketches (numpy over the bytes of a batch)
# ---------------------------------------------------------------------------------------------

def shingle_sets(raw: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    Words are maximal runs of bytes other than space and 0x09-0x0D, A-Z in lower case. A shingle is
    five words in a row; a text of one to four words is one shingle; a text without words has none.
    """
    if len(raw) == 0:
        return [np.zeros(0, np.uint64)] * (len(off) - 1)
    word = ~_SPACE[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[off] = True
    begins = word & (first[:-1] | np.concatenate(([True], ~word[:-1])))
    stops = word & (first[1:] | np.concatenate((~word[1:], [True])))
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    wh = C.span_hashes(_BYTE_HASH[raw], starts, ends)
    bounds = np.searchsorted(starts, off)
    n_words = np.diff(bounds)
    last = np.repeat(bounds[1:], n_words)
    pos = np.arange(len(wh))
    full = pos + SHINGLE <= last
    keep = np.flatnonzero(full | ((pos == np.repeat(bounds[:-1], n_words)) & ~full))
    acc = np.zeros(len(keep), dtype=np.uint64)
    padded = np.concatenate((wh, np.zeros(SHINGLE, np.uint64)))
    for i in range(SHINGLE):
        inside = keep + i < last[keep]
        acc += np.where(inside, padded[keep + i] * _SLOT[i], np.uint64(0))
    sh = C.mix(acc)
    cuts = np.searchsorted(keep, bounds)
    return [np.unique(sh[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """``(len(sets), N_BUCKETS)`` registers; rows of empty sets are zero."""
    sizes = np.array([len(s) for s in sets])
    h = np.concatenate(sets) if sizes.sum() else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), sizes)
    bucket = ((h >> np.uint64(32)) * np.uint64(N_BUCKETS)) >> np.uint64(32)
    low = np.full(len(sets) * N_BUCKETS, _FREE, dtype=np.uint64)
    np.minimum.at(low, row * N_BUCKETS + bucket.astype(np.int64), C.mix(h ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(1))
    own = low.reshape(len(sets), N_BUCKETS)
    out = own.copy()
    some = sizes > 0
    for probe in [*_PROBE, *((np.arange(N_BUCKETS) + k) % N_BUCKETS for k in range(1, N_BUCKETS))]:
        r, c = np.nonzero((out == _FREE) & some[:, None])
        if not len(r):
            break
        out[r, c] = own[r, probe[c]]
    top = out >> np.uint64(12)  # 51 significant bits: exact as float64
    bits = np.frexp(top.astype(np.float64))[1].astype(np.int64)
    zeros = 51 - bits
    mantissa = (top >> np.maximum(bits - 1 - MANTISSA, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    reg = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    reg[~some] = 0
    return reg


def band_rows(percent: int) -> int:
    """Registers of a band."""
    return 7 if percent >= 85 else 6 if percent >= 80 else 4


def band_keys(reg: np.ndarray, rows: int) -> np.ndarray:
    bands = N_BUCKETS // rows
    parts = reg[:, :rows * bands].reshape(len(reg), bands, rows).astype(np.uint64) + np.uint64(1)
    return C.mix((parts * _BAND[:rows]).sum(axis=2, dtype=np.uint64) + _BAND_SEED[:bands])


def chance_matches(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that registers of unrelated sets agree: equal zero counts, then equal mantissas."""
    level = np.arange(52)
    def at(n):
        rate = np.asarray(n, dtype=np.float64)[:, None] / N_BUCKETS
        return np.exp(-rate * 2.0 ** -(level + 1)) - np.exp(-rate * 2.0 ** -level)
    return (at(n_a) * at(n_b)).sum(axis=1) / (1 << MANTISSA)


def _lists(values: np.ndarray) -> pa.Array:
    longs = np.ascontiguousarray(values).view(np.int64)
    rows, width = longs.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(longs.ravel()))


SKETCHED = "h1 LONG, h2 LONG, doc_id LONG, n LONG, set_key BINARY, sketch ARRAY<LONG>, bands ARRAY<LONG>"


def _sketcher(rows_of_band: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off, _ = C.text_buffers(batch.column("text"))
            for lo, hi in C.row_chunks(np.diff(off)):
                sets = shingle_sets(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                reg = registers(sets)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("h1"), rows.column("h2"), rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.binary()), _lists(reg), _lists(band_keys(reg, rows_of_band))],
                    names=["h1", "h2", "doc_id", "n", "set_key", "sketch", "bands"])

    return sketch


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off, _ = C.text_buffers(batch.column("text"))
        for lo, hi in C.row_chunks(np.diff(off)):
            sets = shingle_sets(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if at[-1] else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.slice(lo, hi - lo).column("node"), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                                             names=["node", "shingles"])


# ---------------------------------------------------------------------------------------------
# Links and components (tables)
# ---------------------------------------------------------------------------------------------

def row_keys(text: Column, doc_id: Column) -> list[Column]:
    """128 bits that name a (doc_id, text) row, as two longs."""
    return [F.xxhash64(doc_id, text).alias("h1"), F.xxhash64(text, F.lit("row"), doc_id).alias("h2")]


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of sets from rows of registers and set sizes, corrected for chance matches."""
    chance = chance_matches(n_a, n_b)
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def likely(est: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether set sizes and estimate leave the threshold possible.

    Few shingles fill many registers: the spread follows the smaller number of the two.
    """
    t = percent / 100
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    spread = np.sqrt(t * (1 - t) / np.minimum(low, N_BUCKETS))
    return (100 * low >= percent * high) & (est >= t - SIGMAS * spread)


def _registers_of(packed: pa.Array) -> np.ndarray:
    return packed.flatten().to_numpy().view(np.uint16).reshape(-1, N_BUCKETS)


def _estimated(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(u, v)`` whose corrected estimate does not rule the threshold out."""
    a = sketches.select(F.col("node").alias("u"), F.col("sketch").alias("su"), F.col("n").alias("nu"))
    b = sketches.select(F.col("node").alias("v"), F.col("sketch").alias("sv"), F.col("n").alias("nv"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nu, nv = (batch.column(c).to_numpy() for c in ("nu", "nv"))
            est = estimate(_registers_of(batch.column("su")), _registers_of(batch.column("sv")), nu, nv)
            yield batch.select(["u", "v", "nu", "nv"]).filter(pa.array(likely(est, nu, nv, percent)))

    sized = pairs.join(a, "u").join(b, "v").where(
        100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")).select("u", "v", "nu", "nv", "su", "sv")
    return sized.mapInArrow(keep, "u LONG, v LONG, nu LONG, nv LONG")


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets in ``a`` with all in ``b``."""
    def coded(sets):
        return np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets)
    (row_a, h_a), (row_b, h_b) = coded(a), coded(b)
    shared = np.intersect1d(h_a, h_b)
    out = np.zeros((len(a), len(b)), dtype=np.float64)
    for lo in range(0, len(shared), COLUMNS):
        part = shared[lo:lo + COLUMNS]
        sides = []
        for rows, h, n in ((row_a, h_a, len(a)), (row_b, h_b, len(b))):
            at = np.minimum(np.searchsorted(part, h), len(part) - 1)
            hit = part[at] == h
            x = np.zeros((n, len(part)), dtype=np.float32)
            x[rows[hit], at[hit]] = 1
            sides.append(x)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def block_links(a: pa.StructArray, b: pa.StructArray, percent: int) -> list[tuple[int, int]]:
    """Links between members of two blocks that join different components, as few as it takes."""
    (node_a, comp_a, n_a, reg_a, set_a), (node_b, comp_b, n_b, reg_b, set_b) = (
        (x[0].to_numpy(), x[1].to_numpy(), x[2].to_numpy(), _registers_of(x[3]), x[4]) for x in (a.flatten(), b.flatten()))
    able = np.zeros((len(node_a), len(node_b)), dtype=bool)
    for i in range(len(node_a)):
        same = np.broadcast_to(reg_a[i], reg_b.shape)
        able[i] = likely(estimate(same, reg_b, np.full(len(n_b), n_a[i]), n_b), n_a[i], n_b, percent) & (comp_b != comp_a[i])
    rows, cols = np.flatnonzero(able.any(axis=1)), np.flatnonzero(able.any(axis=0))
    if not len(rows):
        return []
    both = intersections([set_a[i].values.to_numpy() for i in rows.tolist()], [set_b[j].values.to_numpy() for j in cols.tolist()])
    union = n_a[rows][:, None] + n_b[cols][None, :] - both
    linked = able[np.ix_(rows, cols)] & (100 * both >= percent * union)
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while x in above:
            x = above[x]
        return x

    out = []
    for i, j in np.argwhere(linked).tolist():
        i, j = rows[i], cols[j]
        p, q = root(int(comp_a[i])), root(int(comp_b[j]))
        if p != q:
            above[p] = q
            out.append((int(node_a[i]), int(node_b[j])))
    return out


def _across_blocks(rest: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Links between components within each bucket of ``rest(band, node, comp, n, size, total)``."""
    blocks = F.ceil(F.greatest(F.col("size") / F.lit(BLOCK_SETS), F.col("total") / F.lit(BLOCK_SHINGLES)))
    members = (rest.select("band", "node", "comp", "n", F.pmod(F.xxhash64("node"), blocks).alias("block"))
               .join(sketches.select("node", "sketch"), "node").join(sets, "node"))
    packed = members.groupBy("band", "block").agg(F.collect_list(F.struct("node", "comp", "n", "sketch", "shingles")).alias("members"))
    a = packed.select("band", F.col("block").alias("p"), F.col("members").alias("a"))
    b = packed.select("band", F.col("block").alias("q"), F.col("members").alias("b"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("a"), batch.column("b"))
            links = [x for p, q in pairs for x in block_links(p.values, q.values, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"])

    return a.join(b, "band").where("p <= q").select("a", "b").mapInArrow(compared, "u LONG, v LONG")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets meet the threshold."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("xu"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("xv"))
    both = F.size(F.array_intersect("xu", "xv")).cast("long")
    return (pairs.join(a, "u").join(b, "v").select("u", "v", "nu", "nv", both.alias("both"))
            .where(100 * F.col("both") >= percent * (F.col("nu") + F.col("nv") - F.col("both")))
            .select("u", "v"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` with ``comp`` the smallest node reachable, for every node of ``edges(u, v)``.

    Large-star and small-star steps in turn. A node's neighbours are only aggregated (minimum) and
    joined, never gathered, so a node with very many links is no burden for one task.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = C.cut(small.select("u", F.col("m").alias("v"))
                      .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), narrow=True)
        # Done when all edges are stars: one centre for each node, and no centre is a node of another.
        chained = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
        torn = edges.groupBy("u").count().where("count > 1").select("u")
        if chained.unionByName(torn).isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``h1, h2, doc_id, n_shingles, component_id, kept, is_rep``.

    Sets are linked where ``100 * intersection >= percent * union``.

    ``component_id`` is the smallest ``doc_id`` reachable over links; ``kept`` says that it is the row's
    own. ``h1, h2`` name the row by its content (``row_keys``); ``is_rep`` marks the one content of each
    component that stays (the smallest ``doc_id``, then ``h1, h2``).

    NULL, empty and blank texts have no shingles, are linked with nothing, keep their own
    ``doc_id`` and are kept. A NULL ``doc_id`` sorts last; a component of such rows only has a NULL
    ``component_id`` and its rows are kept. Repeated rows are each returned. An empty table
    gives an empty result. Other columns are ignored.
    """
    src = docs.select(*row_keys(F.col(text), F.col(doc_id)), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = C.cut(src.mapInArrow(_sketcher(band_rows(percent)), SKETCHED))
    last = F.lit((1 << 63) - 1)
    nodes = C.cut(
        sketched.where("n > 0").groupBy("set_key")
        .agg(F.min(F.struct(F.coalesce("doc_id", last).alias("d"), "h1", "h2")).alias("label"),
             F.first(F.struct("n", "sketch", "bands")).alias("x"))
        .select(F.monotonically_increasing_id().alias("node"), "set_key", "label", "x.n", "x.sketch", "x.bands"))

    banded = nodes.select("node", "n", F.explode("bands").alias("band"))
    full = banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where("hub <> other").select("band", "hub")
    shared = C.cut(banded.join(full, "band").select("band", "node", "n", "hub"), narrow=True)

    wanted = nodes.select("node", "label").join(shared.select("node").distinct(), "node", "left_semi")
    reps = C.cut(wanted.select("node", F.col("label.h1").alias("h1"), F.col("label.h2").alias("h2")), narrow=True)
    sets = C.cut(C.join_keys(src.select("h1", "h2", "text"), reps, ["h1", "h2"]).select("node", "text")
                 .mapInArrow(_sets, "node LONG, shingles ARRAY<LONG>").dropDuplicates(["node"]))
    sketches = nodes.select("node", "n", "sketch").join(shared.select("node").distinct(), "node", "left_semi")

    star = shared.where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    found = C.cut(_confirmed(_estimated(star, sketches, percent), sets, percent), narrow=True)
    comp = components(found)

    placed = C.cut(shared.join(comp, "node", "left").select("band", "node", "n", "hub", F.coalesce("comp", "node").alias("comp")), narrow=True)
    parted = placed.groupBy("band").agg(F.min("comp").alias("p"), F.max("comp").alias("q"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    # The hub has been compared with all others.
    rest = placed.where("node <> hub").join(parted.where("p <> q").drop("p", "q"), "band")
    few = rest.where(F.col("size") <= FEW)
    a = few.select("band", F.col("node").alias("u"), F.col("comp").alias("cu"))
    b = few.select("band", F.col("node").alias("v"), F.col("comp").alias("cv"))
    across = a.join(b, "band").where("u < v and cu <> cv").select("u", "v").distinct()
    more = C.cut(_confirmed(_estimated(across, sketches, percent), sets, percent), narrow=True)
    with C.arrow_rows(docs.sparkSession, BLOCK_ROWS):
        most = C.cut(_across_blocks(rest.where(F.col("size") > FEW), sets, sketches, percent), narrow=True)
    comp = components(found.unionByName(more).unionByName(most))

    labelled = nodes.select("node", "set_key", "label").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = labelled.groupBy("comp").agg(F.min("label").alias("rep"))
    named = labelled.join(lowest, "comp").select("set_key", "rep")
    own = F.coalesce("doc_id", last)
    out = sketched.select("h1", "h2", "doc_id", "n", "set_key").join(named, "set_key", "left")
    alone = F.col("rep").isNull()
    component = F.when(alone, own).otherwise(F.col("rep.d"))
    return out.select(
        "h1", "h2", "doc_id", F.col("n").alias("n_shingles"), F.nullif(component, last).alias("component_id"),
        (own == component).alias("kept"),
        (alone | ((F.col("rep.h1") == F.col("h1")) & (F.col("rep.h2") == F.col("h2")))).alias("is_rep"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near copies: one row of each component, all columns.

    Rows without words all stay. Of repeated rows (same ``doc_id`` and text) one stays.
    """
    rows = C.cut(near_duplicates(docs, doc_id, text, percent).where("n_shingles > 0").groupBy("h1", "h2")
                 .agg(F.max("is_rep").alias("is_rep"), F.count(F.lit(1)).alias("times")), narrow=True)
    keys = F.struct(*row_keys(F.col(text), F.col(doc_id)))
    keyed = docs.select(F.struct("*").alias("row"), keys.alias("k")).select("row", "k.*")
    # Nearly all rows stay as they are: only keys to leave out, and repeated rows, are looked up.
    rest = C.join_keys(keyed, C.cut(rows.where("not is_rep or times > 1").select("h1", "h2"), narrow=True), ["h1", "h2"], "left_anti")
    again = C.join_keys(keyed, C.cut(rows.where("is_rep and times > 1").select("h1", "h2"), narrow=True), ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])
    return rest.select("row.*").unionByName(again.select("row.*"))
