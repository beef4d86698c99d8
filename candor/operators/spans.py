"""Copied spans: the longest word run that a text shares with its source, and all maximal runs shared with a reference corpus.

* ``longest_copied`` works inside a row: a suffix automaton of the source, over word numbers, is walked along the output.
* ``shared_spans`` works on tables. Word n-grams of ``min_words`` are the seeds: only positions of a document whose seed occurs in the reference go
  on, and consecutive ones form a segment, which holds every shared span that begins in it. Reference rows are dealt to shards of bounded size;
  a segment visits the shards that hold one of its seeds, in batches of bounded size. A task builds a suffix array over its shard and segments by
  prefix doubling in numpy, finds each position's longest match among the neighbouring reference suffixes, and returns it. A position's longest
  match over all shards is kept; spans that another span of the document covers are left out.

Documents are independent of each other beyond the seeds; the seeds of a row are made distinct inside it, and a frequent seed is joined once for each
shard it stands in, never with its occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candor.functions import text as T
from candor.plans.joins import join_bounded
from candor.session import ensure_checkpoint_dir

MIN_WORDS = 4
SHARD_WORDS = 500_000  # words of the reference in a shard (a longer row is a shard of its own)
BATCH_WORDS = 500_000  # words of segments that meet a shard in one task
MAX_BROADCAST_SEEDS = 300_000  # rows of an n-gram and a shard: about 50 MB


class SuffixAutomaton:
    """Minimal automaton of all runs of a word sequence, with the end of each state's first occurrence."""

    def __init__(self, words: list):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first_end = [-1], [0], [0]
        last = 0
        for i, w in enumerate(words, 1):
            cur = self._state(self.length[last] + 1, i, {}, 0)
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                if self.length[p] + 1 == self.length[q]:
                    self.link[cur] = q
                else:
                    clone = self._state(self.length[p] + 1, self.first_end[q], dict(self.next[q]), self.link[q])
                    while p >= 0 and self.next[p].get(w) == q:
                        self.next[p][w] = clone
                        p = self.link[p]
                    self.link[q] = self.link[cur] = clone
            last = cur

    def _state(self, length: int, first_end: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first_end.append(first_end)
        return len(self.length) - 1

    def longest(self, words: list) -> tuple[int, int, int]:
        """``(words, start in words, start in the source)`` of the longest shared run; the first of several, and its first place in the source."""
        state = run = best = end = where = 0
        for i, w in enumerate(words, 1):
            while state and w not in self.next[state]:
                state = self.link[state]
                run = self.length[state]
            if w in self.next[state]:
                state, run = self.next[state][w], run + 1
                if run > best:
                    best, end, where = run, i, self.first_end[state]
        return best, end - best, where - best


def longest_copied(df: DataFrame, source_col: str, output_col: str, out_col: str = "copied") -> DataFrame:
    """Add ``out_col`` = ``struct(words, output_start, source_start)``: the longest run of words of the output that is a run of the source.

    Words are lower-cased runs without white space; starts count words from 0. Without a shared word, or with a NULL text, all are 0.
    """

    @F.pandas_udf("words INT, output_start INT, source_start INT")
    def copied(sources: pd.Series, outputs: pd.Series) -> pd.DataFrame:
        rows = []
        for a, b in zip(sources, outputs):
            none = a is None or b is None or not len(a) or not len(b)
            rows.append((0, 0, 0) if none else SuffixAutomaton(list(a)).longest(list(b)))
        return pd.DataFrame([(n, i, j) if n else (0, 0, 0) for n, i, j in rows], columns=["words", "output_start", "source_start"])

    return df.withColumn(out_col, copied(T.ws_tokens(source_col, lower=True), T.ws_tokens(output_col, lower=True)))


def prefix_names(words: np.ndarray, longest: int) -> list[np.ndarray]:
    """Names of the runs of 1, 2, 4, ... words at each place, in the order of the runs; until all differ or a run has ``longest`` words."""
    names = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
    size, n = 1, len(words)
    while size < longest and n and names[-1].max() + 1 < n:
        second = np.zeros(n, dtype=np.int64)
        second[:n - size] = names[-1][size:] + 1
        names.append(np.unique(names[-1] * (n + 1) + second, return_inverse=True)[1].astype(np.int64))
        size *= 2
    return names


def longest_matches(reference: list[np.ndarray], segments: list[np.ndarray]) -> list[np.ndarray]:
    """For each place of each segment, the words of the longest run from there that is a run of a reference text.

    Words are non-negative numbers. Every text ends with a number of its own, so no run crosses an end.
    """
    texts = [*reference, *segments]
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes) - 1
    words = np.empty(ends[-1] + 1, dtype=np.int64)
    inside = np.ones(len(words), dtype=bool)
    inside[ends] = False
    words[inside] = np.concatenate(texts)
    words[ends] = -1 - np.arange(len(texts))
    names = prefix_names(words, int(min(sizes[:len(reference)].max(), sizes[len(reference):].max())))
    order = np.argsort(names[-1], kind="stable")
    split = int(sizes[:len(reference)].sum())
    ours = order < split
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = np.arange(len(words))
    at = np.arange(len(words))
    before = np.maximum.accumulate(np.where(ours, at, -1))
    after = np.minimum.accumulate(np.where(ours, at, len(words))[::-1])[::-1]
    place = np.arange(split, len(words))
    best = np.zeros(len(place), dtype=np.int64)
    for near, known in ((before, lambda x: x >= 0), (after, lambda x: x < len(words))):
        i = near[rank[place]]
        some = np.flatnonzero(known(i))
        a, b = place[some], order[i[some]]
        run = np.zeros(len(a), dtype=np.int64)
        for k in range(len(names) - 1, -1, -1):  # no run is as long as twice the last size
            same = (a < len(words)) & (b < len(words))
            same[same] = names[k][a[same]] == names[k][b[same]]
            more = same.astype(np.int64) << k
            a, b, run = a + more, b + more, run + more
        best[some] = np.maximum(best[some], run)
    begins = np.concatenate(([0], np.cumsum(sizes[len(reference):])))
    return [best[x:y - 1] for x, y in zip(begins[:-1], begins[1:])]


def _matches(keys: list[str]):
    """A task's part: one shard's reference texts and one batch of segments."""

    def match(key, reference: pd.DataFrame, segments: pd.DataFrame) -> pd.DataFrame:
        columns = [*keys, "pos", "words"]
        if reference.empty or segments.empty:
            return pd.DataFrame(columns=columns)
        numbers: dict[str, int] = {}
        texts = [[np.fromiter((numbers.setdefault(w, len(numbers)) for w in t), np.int64, len(t)) for t in df["words"]] for df in (reference, segments)]
        found = longest_matches(*texts)
        size = [len(f) for f in found]
        out = {k: segments[k].repeat(size).to_numpy() for k in keys}
        starts = segments["start"].to_numpy()
        out["pos"] = np.concatenate([np.arange(n) + s for n, s in zip(size, starts)])
        out["words"] = np.concatenate(found)
        return pd.DataFrame(out, columns=columns)

    return match


def shared_spans(docs: DataFrame, reference: DataFrame, keys: list[str], min_words: int = MIN_WORDS, text_col: str = "text", ref_text_col: str = "text") -> DataFrame:
    """``keys, start, words``: every maximal run of at least ``min_words`` words of a document that is a run of one reference text.

    Words are lower-cased runs without white space, numbered from 0. A run is maximal if no other shared run of the document covers it. ``keys`` must be
    unique and not NULL. NULL texts have no words; an empty table on either side gives no rows. A run that occurs in several reference texts is one row.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    sized = reference.select(T.ws_tokens(ref_text_col, lower=True).alias("words")).where(F.size("words") >= min_words)
    total = sized.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    dealt = sized.distinct().select(F.pmod(F.xxhash64("words"), F.lit(shards)).cast("int").alias("shard"), "words").checkpoint(eager=True)
    joined = F.array_join("words", " ")
    seeds = dealt.select("shard", F.explode(F.array_distinct(T.ngrams(joined, min_words, lower=False, collapsed=True))).alias("seed")).distinct().checkpoint(eager=True)

    grams = docs.select(*keys, F.posexplode(T.ngrams(text_col, min_words)).alias("pos", "seed"))
    known = seeds.select("seed").distinct()
    hits = join_bounded(grams, known, "seed", "left_semi", MAX_BROADCAST_SEEDS)
    w = Window.partitionBy(*keys).orderBy("pos")
    islands = hits.withColumn("island", F.col("pos") - F.row_number().over(w))
    first, last = F.transform("m", lambda x: F.substring_index(x["seed"], " ", 1)), F.split(F.element_at("m", -1)["seed"], " ")
    segments = (islands.groupBy(*keys, "island").agg(F.sort_array(F.collect_list(F.struct("pos", "seed"))).alias("m"))
                .select(*keys, F.col("m")[0]["pos"].alias("start"), F.concat(first, F.slice(last, 2, min_words - 1)).alias("words"),
                        F.array_distinct(F.transform("m", lambda x: x["seed"])).alias("seeds")).checkpoint(eager=True))
    visits = join_bounded(segments.select(*keys, "start", F.explode("seeds").alias("seed")), seeds, "seed", max_rows=MAX_BROADCAST_SEEDS).select(*keys, "start", "shard").distinct()
    visits = segments.drop("seeds").join(visits, [*keys, "start"]).checkpoint(eager=True)
    load = visits.groupBy("shard").agg(F.sum(F.size("words")).alias("n")).select("shard", F.ceil(F.col("n") / BATCH_WORDS).cast("int").alias("batches"))  # a row a shard
    sent = join_bounded(visits, load, "shard", max_rows=MAX_BROADCAST_SEEDS).withColumn("batch", F.pmod(F.xxhash64(*keys, "start"), F.col("batches")).cast("int"))
    copied = join_bounded(dealt, load, "shard", max_rows=MAX_BROADCAST_SEEDS).select(
        F.col("shard").alias("own_shard"), F.explode(F.sequence(F.lit(0), F.col("batches") - 1)).alias("own_batch"), "words")
    kinds = dict(segments.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", pos INT, words INT"
    found = copied.groupBy("own_shard", "own_batch").cogroup(sent.select("shard", "batch", *keys, "start", "words").groupBy("shard", "batch")).applyInPandas(_matches(keys), schema)
    longest = found.groupBy(*keys, "pos").agg(F.max("words").alias("words")).where(F.col("words") >= min_words)
    reach = F.max(F.col("pos") + F.col("words")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    ends = longest.withColumn("reach", F.coalesce(reach, F.lit(-1)))
    return ends.where(F.col("pos") + F.col("words") > F.col("reach")).select(*keys, F.col("pos").alias("start"), "words")
