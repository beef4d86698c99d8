"""Extractive summaries: sentence candidates of each document scored by mean TF-IDF.

Candidates are the sentences of a text (a run of non-terminators plus its terminator run);
a sentence's score is the mean ``ln(N / df)`` over its regex-word tokens (``df`` = documents
holding the token, ``N`` = documents with candidates), rounded to 9 digits so that engines that
sum in different orders agree. The chosen sentence goes through the first-sentence
post-processing like a model summary would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions import text as T
from candor.plans.joins import token_sums
from candor.session import ensure_checkpoint_dir

SENTENCE = r"[^.!?]+[.!?]*"
SCORE_DIGITS = 9
COUNTED = " counted"  # holds a space, so no word equals it


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def sentence_candidates(docs: DataFrame, key: str | list[str] = "doc_id", text_col: str = "text",
                        keep: list[str] | None = None) -> DataFrame:
    """``(keys, keep..., cand_id, text)``: non-empty sentences in order, ``cand_id`` 1-based."""
    keep = keep or []
    key = _keys(key)
    parts = docs.select(*key, *keep, F.posexplode(sentences(F.col(text_col))).alias("pos", "raw"))
    return parts.select(*key, *keep, (F.col("pos") + 1).alias("cand_id"), F.btrim("raw").alias("text")).where(
        F.col("text") != ""
    )


def sentences(text: Column) -> Column:
    """All sentences of a text in order, as ``cand_id`` counts them (not trimmed)."""
    return F.regexp_extract_all(T.collapse_ws(text), F.lit("(" + SENTENCE + ")"), 1)


def sentence_scores(docs: DataFrame, key: str | list[str] = "doc_id", text_col: str = "text") -> DataFrame:
    """``(keys, cand_id, score)``: mean idf of each candidate's tokens (0.0 without tokens). ``keys`` must be unique.

    Only tokens are shuffled, never texts. A document's distinct tokens are taken inside its row, so the document
    frequencies need one aggregate with partial counts and no distinct. Candidates without words carry
    an empty token of weight 0, always among the frequent ones. Frequent tokens meet their weight inside the task (``token_sums``).
    """
    key = _keys(key)
    rows = docs.select(*key, F.posexplode(sentences(F.col(text_col))).alias("pos", "raw")).where(F.btrim("raw") != "")
    words = rows.select(*key, (F.col("pos") + 1).alias("cand_id"), T.regex_words("raw").alias("w"))
    toks = words.select(*key, "cand_id", F.explode(F.when(F.size("w") == 0, F.array(F.lit(""))).otherwise(F.col("w"))).alias("tok"))
    # One pass for document frequencies and the number of texts with candidates, counted as a token that no text has.
    clean = T.collapse_ws(text_col)
    marked = F.when(clean.rlike("[^.!?]"), F.array(F.lit(COUNTED))).otherwise(F.array().cast("array<string>"))
    own = docs.select(F.explode(F.concat(F.array_distinct(T.regex_words(clean)), marked)).alias("tok"))
    ensure_checkpoint_dir(docs.sparkSession)
    dfreq = own.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).checkpoint(eager=True)
    n_docs = dfreq.where(F.col("tok") == COUNTED).agg(F.coalesce(F.max("df"), F.lit(0))).first()[0]
    idf = dfreq.where(F.col("tok") != COUNTED).select("tok", F.log(F.lit(float(n_docs)) / F.col("df")).alias("idf"), "df")
    idf = idf.unionByName(docs.sparkSession.createDataFrame([("", 0.0, 1 << 40)], "tok STRING, idf DOUBLE, df LONG"))
    sums = token_sums(toks, idf, [*key, "cand_id"], "tok", "idf", "df")
    return sums.select(*key, "cand_id", F.round(F.col("total") / F.col("n"), SCORE_DIGITS).alias("score"))


def scored_sentences(docs: DataFrame, key: str | list[str] = "doc_id", text_col: str = "text",
                     keep: list[str] | None = None) -> DataFrame:
    """Every candidate with its text and score."""
    return sentence_candidates(docs, key, text_col, keep).join(sentence_scores(docs, key, text_col), [*_keys(key), "cand_id"])
