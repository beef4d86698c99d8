"""Alignment of two tokenizers' tokens over the same text.

Both token sequences cover the same bytes. A cut is a byte offset where a token of each ends; the cuts part the tokens into groups. They are
found by divide and conquer: in an interval that begins and ends at cuts, the end of tokenizer A's middle token is looked up among B's ends by
bisection, then its neighbours' outwards, until a common end is found; both halves are intervals again. An interval without an inner cut is a group. All
intervals of one depth, over the documents of a chunk, are halved at once in numpy.

Every A token of a group is linked with every B token of it. Of each id pair, the corpus count is the number of documents that hold it linked:

1. A document becomes its distinct pairs, each with the number of its links; large groups are reduced to distinct ids before pairs are made. These rows, not the tokens, are
   written to the checkpoint folder.
2. Counts are summed inside tasks before the shuffle; the highest count of each A id is one row of its vocabulary.
3. The most frequent pairs, at most ``MAX_PAIRS`` (a whole number of powers of two of the count), are broadcast, and documents look up their pairs inside the row. Only the
   rare rest is exploded and joined; no such pair is frequent, so no key is hot.
"""

from __future__ import annotations

import array
import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm import common as C

MAX_PAIRS = 1 << 20
NEAR = 8  # tokens on each side of the middle that all intervals try together; beyond, an interval is searched on its own
LARGE = 256  # links of a group from which ids are made distinct first


class Tokenizers:
    """The byte-level tokenizer A (rank file; the tokenizer file where that refuses a text) and the piece model B, with their tokens' bytes."""

    def __init__(self, path_a: str, ranks_a: str, pattern_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken

        with open(ranks_a, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.path_a, self.slow = path_a, None
        self.fast = tiktoken.Encoding("own", pat_str=pattern_a, mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max(table.values()) + 1)
        for token, i in table.items():
            self.bytes_a[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        self.flat_a, self.flat_b = (np.frombuffer(b"".join(x), dtype=np.uint8) for x in (self.bytes_a, self.bytes_b))
        # An id as it is written in a group list, with what follows it: a comma, the bar after A's ids, the semicolon after B's.
        self.written = [f"{i}{mark}".encode() for i in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in ",|;"]

    def ids_a(self, whole: str) -> np.ndarray:
        try:
            return np.array(self.fast.encode_to_numpy(whole, disallowed_special=()), dtype=np.int32)
        except (ValueError, RuntimeError):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path_a)
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(whole, add_special_tokens=False).ids, dtype=np.int32)

    def spelled(self, ids: list[np.ndarray], texts: list[bytes], size: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Whether the tokens' bytes are the text, for each text."""
        own = np.concatenate([np.zeros(0, np.int32), *ids])
        bounds = np.cumsum([0, *map(len, ids)])
        ends = np.concatenate(([0], np.cumsum(size[own])))
        length = np.array([len(t) for t in texts], dtype=np.int64)
        equal = ends[bounds[1:]] - ends[bounds[:-1]] == length
        if equal.all():  # as nearly always
            begin = (np.cumsum(size) - size)[own]
            shown = flat[np.repeat(begin - ends[:-1], size[own]) + np.arange(ends[-1])]
            wrong = np.concatenate(([0], np.cumsum(shown != np.frombuffer(b"".join(texts), dtype=np.uint8))))
            at = np.concatenate(([0], np.cumsum(length)))
            return wrong[at[1:]] == wrong[at[:-1]]
        some = np.flatnonzero(equal).tolist()
        equal[some] = self.spelled([ids[i] for i in some], [texts[i] for i in some], size, flat)
        return equal

    def pairs(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of ``" " + text`` by A and of ``text`` by B; none where a text is NULL or empty, or either does not give its bytes back."""
        none = np.zeros(0, dtype=np.int32)
        out = [(none, none)] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        if some:
            whole = [" " + texts[i] for i in some]
            raw = [t.encode() for t in whole]
            a = list(map(self.ids_a, whole))
            b = [np.frombuffer(array.array("i", x), dtype=np.int32) for x in self.b.encode([texts[i] for i in some], num_threads=1)]
            good = self.spelled(a, raw, self.size_a, self.flat_a) & self.spelled(b, raw, self.size_b, self.flat_b)
            for i, x, y, ok in zip(some, a, b, good.tolist()):
                if ok:
                    out[i] = (x, y)
        return out


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, bounds_a: np.ndarray, bounds_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks just after each cut, among A's and B's tokens, in rising order.

    ``ends`` are byte offsets that rise over all documents of a chunk; document ``i`` has the tokens ``bounds[i]`` to ``bounds[i + 1]``, and
    its last two tokens end alike.
    """
    some = bounds_a[1:] > bounds_a[:-1]
    lo, hi, lo_b, hi_b = bounds_a[:-1][some], bounds_a[1:][some], bounds_b[:-1][some], bounds_b[1:][some]
    cuts = [(hi, hi_b)]
    while True:
        inner = (hi - lo > 1) & (hi_b - lo_b > 1)
        lo, hi, lo_b, hi_b = (x[inner] for x in (lo, hi, lo_b, hi_b))
        if not len(lo):
            break
        middle = (lo + hi - 2) // 2
        cut = np.zeros(len(lo), dtype=np.int64)  # rank after the cut; 0 while none is found
        cut_b = np.zeros(len(lo), dtype=np.int64)
        left = np.arange(len(lo))
        for d in (0, *(s * i for i in range(1, NEAR + 1) for s in (1, -1))):
            at = middle[left] + d
            who = left[(at >= lo[left]) & (at <= hi[left] - 2)]
            at = middle[who] + d
            j = np.searchsorted(ends_b, ends_a[at])
            hit = ends_b[j] == ends_a[at]
            cut[who[hit]], cut_b[who[hit]] = at[hit] + 1, j[hit] + 1
            left = left[cut[left] == 0]
            if not len(left):
                break
        for i in left[hi[left] - lo[left] > 2 * NEAR].tolist():
            at = np.arange(lo[i], hi[i] - 1)
            j = lo_b[i] + np.searchsorted(ends_b[lo_b[i]:hi_b[i]], ends_a[at])
            hit = np.flatnonzero(ends_b[j] == ends_a[at])
            if len(hit):
                best = hit[np.abs(at[hit] - middle[i]).argmin()]
                cut[i], cut_b[i] = at[best] + 1, j[best] + 1
        got = cut > 0
        lo, hi, lo_b, hi_b, cut, cut_b = (x[got] for x in (lo, hi, lo_b, hi_b, cut, cut_b))
        cuts.append((cut, cut_b))
        lo, hi, lo_b, hi_b = np.concatenate((lo, cut)), np.concatenate((cut, hi)), np.concatenate((lo_b, cut_b)), np.concatenate((cut_b, hi_b))
    after, after_b = (np.concatenate(x) for x in zip(*cuts))
    return np.sort(after), np.sort(after_b)


class Aligned:
    """Tokens and groups of a chunk of texts."""

    def __init__(self, tokenizers: Tokenizers, texts: list[str | None]):
        pairs = tokenizers.pairs(texts)
        self.written = tokenizers.written
        self.n_a, self.n_b = (np.array([len(p[k]) for p in pairs], dtype=np.int64) for k in (0, 1))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in pairs)]) for k in (0, 1))
        del pairs
        self.bounds_a, self.bounds_b = (np.concatenate(([0], np.cumsum(n))) for n in (self.n_a, self.n_b))
        self.end_a, self.end_b = shared_cuts(np.cumsum(tokenizers.size_a[self.a]), np.cumsum(tokenizers.size_b[self.b]), self.bounds_a, self.bounds_b)
        self.begin_a, self.begin_b = (np.concatenate(([0], x[:-1])) if len(x) else x for x in (self.end_a, self.end_b))
        self.bounds = np.searchsorted(self.end_a, self.bounds_a, side="right")  # groups of each document
        self.bounds[0] = 0

    def listed(self) -> list[bytes]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        group_a = np.repeat(np.arange(len(self.end_a)), self.end_a - self.begin_a)
        group_b = np.repeat(np.arange(len(self.end_b)), self.end_b - self.begin_b)
        codes = np.zeros(len(self.a) + len(self.b), dtype=np.int64)
        at_a = np.arange(len(self.a)) + self.begin_b[group_a]
        at_b = np.arange(len(self.b)) + self.end_a[group_b]
        codes[at_a], codes[at_b] = 3 * self.a, 3 * self.b
        codes[at_a[self.end_a - 1]] += 1
        codes[at_b[self.end_b - 1]] += 2
        parts = list(map(self.written.__getitem__, codes.tolist()))
        ends = (self.bounds_a + self.bounds_b).tolist()
        return [b"".join(parts[a:b])[:-1] for a, b in zip(ends[:-1], ends[1:])]

    def links(self) -> np.ndarray:
        """Number of links of each document."""
        total = np.concatenate(([0], np.cumsum((self.end_a - self.begin_a) * (self.end_b - self.begin_b))))
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def id_pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair number ``a * width + b`` and links of each document's distinct pairs, in this order."""
        n_a, n_b = self.end_a - self.begin_a, self.end_b - self.begin_b
        doc = np.repeat(np.arange(len(self.n_a)), np.diff(self.bounds))
        few = n_a * n_b < LARGE
        size = (n_a * n_b)[few]
        group = np.repeat(np.flatnonzero(few), size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        found = [(doc[group], self.a[self.begin_a[group] + k // n_b[group]] * width + self.b[self.begin_b[group] + k % n_b[group]], np.ones(len(k), dtype=np.int64))]
        for g in np.flatnonzero(~few).tolist():
            ids_a, times_a = np.unique(self.a[self.begin_a[g]:self.end_a[g]], return_counts=True)
            ids_b, times_b = np.unique(self.b[self.begin_b[g]:self.end_b[g]], return_counts=True)
            own = (ids_a[:, None] * width + ids_b).ravel()
            found.append((np.full(len(own), doc[g]), own, (times_a[:, None] * times_b).ravel()))
        docs, pairs, times = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((pairs, docs))
        docs, pairs, times = docs[order], pairs[order], times[order]
        first = np.flatnonzero(np.concatenate(([True], (docs[1:] != docs[:-1]) | (pairs[1:] != pairs[:-1])))) if len(docs) else np.zeros(0, dtype=np.int64)
        return docs[first], pairs[first], np.add.reduceat(times, first) if len(first) else times


def _chunks(batches: Iterator[pa.RecordBatch], files: tuple[str, str, str, str]) -> Iterator[tuple[pa.RecordBatch, Tokenizers, Aligned]]:
    tokenizers = Tokenizers(*files)
    for batch in batches:
        for lo, hi in C.row_chunks(np.diff(C.text_buffers(batch.column("text"))[1])):
            rows = batch.slice(lo, hi - lo)
            yield rows, tokenizers, Aligned(tokenizers, rows.column("text").to_pylist())


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def align(docs: DataFrame, files: tuple[str, str, str, str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, a_ids, b_ids, a_ends, b_ends``: both token sequences, and the ranks after each group's last token in them.

    ``files`` are tokenizer file, rank file and pattern of A and the model file of B. Empty lists for texts without tokens (see ``Tokenizers.pairs``).
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, own in _chunks(batches, files):
            first_a, first_b = (np.repeat(x[:-1], np.diff(own.bounds)) for x in (own.bounds_a, own.bounds_b))
            lists = (own.a, own.bounds_a), (own.b, own.bounds_b), (own.end_a - first_a, own.bounds), (own.end_b - first_b, own.bounds)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(_lists(v, e, pa.int32()) for v, e in lists)], names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    return src.mapInArrow(rows, "doc_id LONG, a_ids ARRAY<INT>, b_ids ARRAY<INT>, a_ends ARRAY<INT>, b_ends ARRAY<INT>")


def link_statistics(docs: DataFrame, files: tuple[str, str, str, str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document.

    ``n_best`` counts the links whose pair has the highest corpus count of its A id, ties included; ``count_sum`` adds the counts of all links. Texts that are NULL
    or empty, or that a tokenizer does not give back byte by byte, have zeros and an empty ``groups_sha256``. Repeated rows are documents of their own, in
    the counts too. An empty table gives no rows; other columns are ignored, whatever their names. A task holds the distinct pairs of one chunk of texts.
    """
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    given = Tokenizers(*files)
    width = len(given.bytes_b)
    kind, arrow_kind = ("INT", pa.int32()) if len(given.bytes_a) * width < 1 << 31 else ("LONG", pa.int64())
    del given
    plain = "row LONG, doc_id LONG, n_a LONG, n_b LONG, n_groups LONG, n_links LONG"
    names = [f.split()[0] for f in plain.split(", ")]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, own in _chunks(batches, files):
            doc, pairs, times = own.id_pairs(width)
            many = times > 1
            every = np.arange(len(part) + 1)
            sha = [hashlib.sha256(s).hexdigest() if s else "" for s in own.listed()]
            arrays = [part.column("row"), part.column("doc_id"), *(pa.array(x) for x in (own.n_a, own.n_b, np.diff(own.bounds), own.links())), pa.array(sha, pa.string()),
                      _lists(pairs[~many], np.searchsorted(doc[~many], every), arrow_kind), _lists(pairs[many], np.searchsorted(doc[many], every), arrow_kind),
                      _lists(times[many], np.searchsorted(doc[many], every), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "groups_sha256", "once", "many", "times"])

    held = C.cut(src.mapInArrow(measured, f"{plain}, groups_sha256 STRING, once ARRAY<{kind}>, many ARRAY<{kind}>, times ARRAY<LONG>"))
    counted = held.select(F.explode(F.concat("once", "many")).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = C.cut(counted.select(F.col("pair").cast("long").alias("pair"), "n"), narrow=True)
    id_a = F.floor(F.col("pair") / width).alias("a")
    highest = counts.groupBy(id_a).agg(F.max("n").alias("highest"))  # a row of A's vocabulary at most
    judged = counts.withColumn("a", id_a).join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))

    sizes = {r.power: r.rows for r in counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count(F.lit(1)).alias("rows")).collect()}  # 64 rows at most
    least, rows = 64, 0
    while least and rows + sizes.get(least - 1, 0) <= MAX_PAIRS:
        least -= 1
        rows += sizes.get(least, 0)
    top = judged.where(F.col("n") >= F.lit(1 << min(least, 62))).sort("pair").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            lists = [batch.column(c) for c in ("once", "many", "times")]
            size = [np.diff(x.offsets.to_numpy()) for x in lists]
            doc = np.concatenate([np.repeat(np.arange(len(batch)), s) for s in size[:2]])
            pair = np.concatenate([x.flatten().to_numpy() for x in lists[:2]]).astype(np.int64)
            times = np.concatenate([np.ones(size[0].sum(), dtype=np.int64), lists[2].flatten().to_numpy()])
            order = np.argsort(doc, kind="stable")
            doc, pair, times = doc[order], pair[order], times[order]
            at = np.searchsorted(known, pair)
            hit = at < len(known)
            hit[hit] = known[at[hit]] == pair[hit]
            bounds = np.searchsorted(doc[hit], np.arange(len(batch) + 1))
            sums = [np.concatenate(([0], np.cumsum(times[hit] * x[at[hit]])))[bounds] for x in (best.astype(np.int64), n)]
            rest = np.searchsorted(doc[~hit], np.arange(len(batch) + 1))
            arrays = [*(batch.column(c) for c in names), *(pa.array(np.diff(s)) for s in sums), batch.column("groups_sha256"),
                      _lists(pair[~hit], rest, pa.int64()), _lists(times[~hit], rest, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_best", "count_sum", "groups_sha256", "rest", "rest_times"])

    out = held.mapInArrow(looked_up, f"{plain}, n_best LONG, count_sum LONG, groups_sha256 STRING, rest ARRAY<LONG>, rest_times ARRAY<LONG>")
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if not least:
        return out.select(*shown)
    out = C.cut(out)
    link = F.explode(F.arrays_zip(F.col("rest").alias("pair"), F.col("rest_times").alias("times"))).alias("link")
    rare = out.select("row", link).select("row", "link.pair", "link.times").join(judged.where(F.col("n") < F.lit(1 << min(least, 62))), "pair")
    more = rare.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    mended = out.where(F.size("rest") > 0).join(more, "row").withColumns({"n_best": F.col("n_best") + F.col("more_best"), "count_sum": F.col("count_sum") + F.col("more_sum")})
    return out.where(F.size("rest") == 0).select(*shown).unionByName(mended.select(*shown))
