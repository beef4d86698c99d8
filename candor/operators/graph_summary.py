"""Graph-ranked sentences: the sentences of a text weigh one another by the words they share (TextRank, Mihalcea and Tarau 2004).

The weight of two sentences is the sum over shared words of the squared inverse sentence frequency ``ln(1 + S / s_w)``, where ``s_w`` of the text's ``S``
sentences have the word. Scores are the fixed point of ``r_i = (1 - d) / S + d * sum_j r_j * w_ij / W_j`` (``W_j``: all weights of ``j``; the score of sentences without
shared words goes to all alike). The iteration runs over (sentence, word) entries, from sentences to words and back, and takes a sentence's own part off: a word of
all sentences costs one entry each, never a pair. A text is one row, so there is no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.functions import text as T
from candor.operators.summarize import sentences

DAMPING, TOLERANCE, ROUNDS = 0.85, 1e-12, 1000
DIGITS = 9


def rank(words: list[list[str]], damping: float = DAMPING) -> np.ndarray:
    """The scores of one text's sentences, given their distinct words."""
    numbers: dict[str, int] = {}
    word = np.array([numbers.setdefault(x, len(numbers)) for w in words for x in w], np.int64)
    return rank_entries(np.array([len(w) for w in words], np.int64), word, damping)


def rank_entries(sizes: np.ndarray, word: np.ndarray, damping: float = DAMPING) -> np.ndarray:
    """The scores of one text's sentences, given the number of distinct words of each and the words' numbers, sentence by sentence."""
    n = len(sizes)
    sent = np.repeat(np.arange(n), sizes)
    if not n or not len(word):
        return np.full(n, 1.0 / n if n else 0.0)
    held = np.bincount(word)
    square = (np.log1p(n / held) ** 2)[word]
    own = np.bincount(sent, weights=square, minlength=n)
    degree = np.bincount(sent, weights=square * (held[word] - 1), minlength=n)
    linked = degree > 1e-15
    over = np.divide(1.0, degree, out=np.zeros(n), where=linked)
    r = np.full(n, 1.0 / n)
    for _ in range(ROUNDS):
        flow = r * over
        to_words = np.bincount(word, weights=flow[sent], minlength=len(held))
        back = np.bincount(sent, weights=square * to_words[word], minlength=n) - own * flow
        new = (1 - damping) / n + damping * (back + r[~linked].sum() / n)
        moved, r = np.abs(new - r).sum(), new
        if moved < TOLERANCE:
            break
    return r


def ranked_sentences(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys, cand_id, score`` of every non-blank sentence, numbered as in ``summarize``; NULL and blank texts have none.

    Usable as the scores of ``select.choose``, so all decoding strategies apply.
    """

    @F.arrow_udf("array<double>")
    def scores(texts: pa.Array) -> pa.Array:
        # Words become numbers in Arrow, so no string of them is ever a Python object.
        every = texts.values
        at, ends = np.asarray(texts.offsets, np.int64), np.asarray(every.offsets, np.int64)
        number = every.values.dictionary_encode().indices.to_numpy()
        out = [rank_entries(np.diff(ends[a:b + 1]), np.unique(number[ends[a]:ends[b]], return_inverse=True)[1]).round(DIGITS) for a, b in zip(at[:-1], at[1:])]
        return pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(np.concatenate(out) if out else np.zeros(0)))

    every = F.transform(sentences(F.coalesce(F.col(text_col), F.lit(""))), lambda s: F.btrim(s))
    split = docs.select(*keys, F.filter(F.transform(every, lambda s, i: F.struct((i + 1).alias("cand_id"), s.alias("s"))), lambda x: x["s"] != "").alias("_s"))
    words = split.select(*keys, "_s.cand_id", F.transform("_s", lambda x: F.array_distinct(T.regex_words(x["s"]))).alias("_w"))
    scored = words.select(*keys, F.arrays_zip("cand_id", scores("_w").alias("score")).alias("_z"))
    # A filter on the arrays, also the one that a plain explode brings, would be pushed below and split and rank every text again.
    return scored.select(*keys, F.explode_outer("_z").alias("_e")).where(F.col("_e").isNotNull()).select(*keys, F.col("_e.cand_id").alias("cand_id"), F.col("_e.score").alias("score"))
