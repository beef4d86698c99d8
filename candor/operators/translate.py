"""Word substitutions learned from text pairs: IBM model 1 (Brown et al. 1993) by expectation maximisation.

A pair is a source text and its simpler, or answering, target text. A target word is shared among the source words of its pair, whatever the other target words are;
so pairs are dealt by target word once, and a task holds all that the probabilities of its target words need. What an iteration moves is one sum a task and source word,
by which the probabilities are normalised: a task starts from equal shares each time and repeats the iterations so far with the sums that are known. No row of a
(pair, source word, target word) is ever shuffled or written; a task makes them for a few target words at a time, as columns. The words and the sums, one number a source word
and iteration, are sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candor.functions import text as T
from candor.plans.joins import MAX_BROADCAST_TOKENS, join_bounded
from candor.session import ensure_checkpoint_dir, kept

ITERATIONS = 5
NULL_WORD = ""  # a source word that every pair has: target words of no particular origin
CHUNK = 1 << 21  # rows of a (pair, source word, target word) that a task makes at once; a target word of more is taken alone
PART = 1 << 26  # such rows of a task, where the session's shuffle partitions would get more
_OUT_ROWS = 1 << 16


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any column; true for the first."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The indices ``begin, begin + 1, ..`` of each run, one run after the other."""
    return np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)


def _counts(col: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word number and count of the distinct words of each row, by row and number."""
    values, size = col.flatten(), np.diff(col.offsets.to_numpy())
    ids = pc.index_in(values, value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)
    both, n = np.unique(np.repeat(np.arange(len(col)), size) * len(words) + ids, return_counts=True)
    return both // len(words), (both % len(words)).astype(np.int32), n.astype(np.int32)


def _lists(begin: np.ndarray, count: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), pa.array(values[_spread(begin, count)]))


def _bags(pairs: DataFrame, keys: list[str], source_col: str, target_col: str) -> tuple[pa.Array, DataFrame]:
    """The words, sorted (a word's number is its place), and ``pair, s, n_s, t, n_t``: the numbers and counts of a text pair's source words, and of those target words that a task has."""
    spark = pairs.sparkSession
    rows = pairs.select(*keys, T.regex_words(source_col).alias("_s"), T.regex_words(target_col).alias("_t")).where((F.size("_s") > 0) & (F.size("_t") > 0))
    rows = kept(rows.withColumn("_s", F.array_append("_s", F.lit(NULL_WORD))).withColumn("row", F.monotonically_increasing_id()))
    named = rows.groupBy(*keys).agg(F.min("row").alias("pair"))
    own = rows.select(*keys, "row").join(named, keys, "left").select("row", "pair")
    words = rows.select(F.explode(F.concat("_s", "_t")).alias("word")).distinct().toArrow().column("word").combine_chunks().cast(pa.string())
    words = words.take(pc.sort_indices(words))
    made = rows.agg(F.sum(F.size("_s").cast("long") * F.size("_t"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-made // PART))
    known = spark.sparkContext.broadcast(words)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            s_row, s, n_s = _counts(batch.column("_s"), known.value)
            t_row, t, n_t = _counts(batch.column("_t"), known.value)
            order = np.lexsort((t % parts, t_row))
            t_row, t, n_t = t_row[order], t[order], n_t[order]
            at = np.flatnonzero(_starts(t_row, t % parts))
            row, n = t_row[at], np.diff(np.append(at, len(t)))
            first = np.searchsorted(s_row, np.arange(len(batch) + 1))
            begin, size = first[row], np.diff(first)[row]
            yield pa.RecordBatch.from_arrays([pa.array(t[at] % parts, pa.int32()), batch.column("pair").take(pa.array(row)), _lists(begin, size, s), _lists(begin, size, n_s), _lists(at, n, t), _lists(at, n, n_t)],
                                             names=["part", "pair", "s", "n_s", "t", "n_t"])

    texts = join_bounded(rows.select("row", "_s", "_t"), own, "row", max_rows=MAX_BROADCAST_TOKENS).select("pair", "_s", "_t")
    bags = texts.mapInArrow(dealt, "part INT, pair LONG, s ARRAY<INT>, n_s ARRAY<INT>, t ARRAY<INT>, n_t ARRAY<INT>").repartitionById(parts, F.col("part")).drop("part")
    ensure_checkpoint_dir(spark)
    return words, bags.checkpoint(eager=True)


def _numbered(pairs: DataFrame, keys: list[str], source_col: str, target_col: str) -> tuple[DataFrame, DataFrame]:
    """``vocabulary(word, id)`` and ``seen(pair, s, t, n_s, n_t)`` with numbers for keys and words; a repeated key is one ``pair``, one with a NULL has none."""
    words, bags = _bags(pairs, keys, source_col, target_col)
    vocabulary = pairs.sparkSession.createDataFrame(pa.table({"word": words, "id": pa.array(np.arange(len(words)), pa.int64())}))
    seen = bags.select("pair", "t", "n_t", F.explode(F.arrays_zip("s", "n_s")).alias("_s")).select("pair", "_s", F.explode(F.arrays_zip("t", "n_t")).alias("_t"))
    return vocabulary, seen.select("pair", F.col("_s.s").cast("long").alias("s"), F.col("_t.t").cast("long").alias("t"), F.col("_s.n_s").alias("n_s"), F.col("_t.n_t").alias("n_t"))


class _Chunk:
    """A few target words with all text pairs that have them: a row for each of a pair's source words, grouped by target word and pair."""

    def __init__(self, pair: np.ndarray, t: np.ndarray, n_t: np.ndarray, size: np.ndarray, s: np.ndarray, n_s: np.ndarray, n_words: int):
        begin = np.cumsum(size) - size
        word, group = _starts(t), _starts(t, pair)
        key = np.repeat(np.cumsum(word) - 1, size) * n_words + s
        order = np.argsort(key)
        key = key[order]
        new = _starts(key)
        self.entry = np.empty(len(key), dtype=np.int32)  # the (source word, target word) of each row
        self.entry[order] = np.cumsum(new) - 1
        key = key[new]
        self.s, self.t = key % n_words, t[word][key // n_words]
        self.n_s, self.n_t = n_s, np.repeat(n_t, size)
        self.at, self.of = begin[group], np.repeat(np.cumsum(group) - 1, size)
        # Rows without a pair have no share, and go once their entries have none.
        self.loose = np.repeat(pair < 0, size) if (pair < 0).any() else None
        self.some = np.ones(len(key), dtype=bool) if self.loose is None else np.bincount(self.entry, weights=~self.loose, minlength=len(key)) > 0

    def shares(self, p: np.ndarray, step: int) -> tuple[np.ndarray, float]:
        """The shares of each entry under probabilities ``p``, and the rows' part of the log-likelihood."""
        n_s, one = self.n_s, None
        if self.loose is not None:
            one = self.some[self.entry].astype(float) if step else np.ones(len(self.entry))
            n_s = n_s * one
        w = n_s * p[self.entry]
        z = np.add.reduceat(w, self.at)
        with np.errstate(divide="ignore", invalid="ignore"):
            loss = np.log(z / np.add.reduceat(n_s, self.at))
            loss /= np.diff(np.append(self.at, len(w))) if one is None else np.add.reduceat(one, self.at)
            w *= self.n_t / z[self.of]
        loss = loss[self.of] * self.n_t
        if self.loose is not None:
            loss, w = loss[one > 0], np.where(self.loose, 0.0, w)
        return np.bincount(self.entry, weights=w, minlength=len(self.s)), float(loss.sum())


def _chunks(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[_Chunk]:
    """The rows of a task, a few target words at a time."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    table = pa.Table.from_batches(held)
    pair = pc.fill_null(table.column("pair"), -1).to_numpy()
    s, n_s, t, n_t = (np.concatenate([c.flatten().to_numpy() for c in table.column(name).chunks]) for name in ("s", "n_s", "t", "n_t"))
    s_size, t_size = (pc.list_value_length(table.column(name)).to_numpy() for name in ("s", "t"))
    del held, table
    row = np.repeat(np.arange(len(pair)), t_size)
    order = np.lexsort((pair[row], t))
    row, t, n_t = row[order], t[order], n_t[order]
    begin, size = (np.cumsum(s_size) - s_size)[row], s_size[row].astype(np.int64)
    at = np.flatnonzero(_starts(t))
    done, first = 0, 0
    made = np.append(np.cumsum(size)[np.append(at[1:], len(t)) - 1], 0)
    for i in range(1, len(at) + 1):
        # Up to the word that would pass the bound.
        if i == len(at) or made[i] - done > CHUNK:
            a, b = at[first], at[i] if i < len(at) else len(t)
            here = _spread(begin[a:b], size[a:b])
            yield _Chunk(pair[row[a:b]], t[a:b], n_t[a:b], size[a:b], s[here], n_s[here], n_words)
            done, first = made[i - 1], i


def train(pairs: DataFrame, keys: list[str], source_col: str, target_col: str, iterations: int = ITERATIONS) -> tuple[DataFrame, list[float]]:
    """``(s, t, p)``: probability that source word ``s`` becomes ``t``, and the log-likelihood before each iteration and after the last.

    Starts from equal shares. ``keys`` must be unique. Without pairs the table is empty and all likelihoods are 0.
    """
    words, bags = _bags(pairs, keys, source_col, target_col)
    n_words, sc = len(words), pairs.sparkSession.sparkContext
    known = sc.broadcast(words)
    sums: list[np.ndarray] = []  # of each source word: its target words, then its shares in each iteration

    def probabilities(chunk: _Chunk, below: list[np.ndarray]) -> np.ndarray:
        p = 1.0 / below[0][chunk.s]
        for step, total in enumerate(below[1:]):
            with np.errstate(divide="ignore", invalid="ignore"):
                p = chunk.shares(p, step)[0] / total[chunk.s]
            p[~chunk.some] = 0.0
        return p

    def summed(last: bool):
        """A source word's next sum by task, and under -1 the log-likelihood."""
        sent = sc.broadcast(list(sums))

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            below, total, loss = sent.value, np.zeros(n_words), 0.0
            for chunk in _chunks(batches, n_words):
                given = None
                if below:
                    given, more = chunk.shares(probabilities(chunk, below), len(below) - 1)
                    loss += more
                if not last:
                    total += np.bincount(chunk.s, weights=given, minlength=n_words)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(total[some], loss))], names=["s", "c"])

        found = bags.mapInArrow(part, "s INT, c DOUBLE").groupBy("s").agg(F.sum("c").alias("c")).toArrow()
        sent.unpersist()
        s, c = found.column("s").to_numpy(), found.column("c").to_numpy()
        out = np.zeros(n_words)
        out[s[s >= 0]] = c[s >= 0]
        return out, float(c[s < 0].sum())

    likelihood = []
    for step in range(iterations + 1):
        more, loss = summed(False)
        sums.append(more)
        if step:
            likelihood.append(loss)
    likelihood.append(summed(True)[1])
    sent = sc.broadcast(sums)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, n_words):
            p, some = probabilities(chunk, sent.value), chunk.some if iterations else np.ones(len(chunk.s), dtype=bool)
            s, t, p = chunk.s[some], chunk.t[some], p[some]
            for a in range(0, len(p), _OUT_ROWS):
                b = a + _OUT_ROWS
                yield pa.RecordBatch.from_arrays([known.value.take(pa.array(s[a:b])), known.value.take(pa.array(t[a:b])), pa.array(p[a:b])], names=["s", "t", "p"])

    return bags.mapInArrow(table, "s STRING, t STRING, p DOUBLE"), likelihood


def substitutions(table: DataFrame, texts: DataFrame, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """``word, simpler, p``: the most probable other word of each source word with at least ``least``, where it is the commoner one in ``texts``.

    Frequency stands for simplicity: a word is only replaced by one that more texts use. Usable as the dictionary of ``rewrite.simplify_words``.
    """
    used = texts.select(F.explode(F.array_distinct(T.regex_words(text_col))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    moved = table.where((F.col("s") != NULL_WORD) & (F.col("s") != F.col("t")) & (F.col("p") >= least))
    both = moved.join(used.select(F.col("w").alias("s"), F.col("n").alias("_own")), "s").join(used.select(F.col("w").alias("t"), F.col("n").alias("_other")), "t")
    w = Window.partitionBy("s").orderBy(F.col("p").desc(), "t")  # at most 1 / least rows
    best = both.where(F.col("_other") > F.col("_own")).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return best.select(F.col("s").alias("word"), F.col("t").alias("simpler"), "p")
