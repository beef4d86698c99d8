"""Binary text classification as relational training and scoring (multinomial naive Bayes).

Training: regex-word tokens of labelled texts -> per-token class counts (partial aggregation) ->
Laplace-smoothed log-ratio per token. Scoring: tokens of each text meet the weight table (the
frequent ones inside the task) -> sum per text (partial sums first) -> ``z``; the label is the sign of
``z`` and the score the winning-class probability ``1/(1+exp(-|z|))``. Texts with no known token
get ``z = prior`` (left join). ``z`` is rounded to 9 digits before any threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import text as T
from candor.plans.joins import token_sums
from candor.session import ensure_checkpoint_dir

Z_DIGITS = 9


def train_naive_bayes(texts: DataFrame, label_col: str = "y", text_col: str = "text") -> tuple[DataFrame, float]:
    """``texts(text, y in {0,1})`` -> ``(weights(tok, w, n), prior)``; ``n`` is the token's number of occurrences.

    Token counts are materialised once; their totals come from that table. Counts and prior are smoothed by one, so a class
    without texts (or no texts at all) has a finite weight everywhere. Rows with another label or a NULL are not used.
    """
    known = texts.select(F.col(label_col).alias("y"), F.col(text_col).alias("text")).where("y in (0, 1) and text is not null")
    spark = texts.sparkSession
    ensure_checkpoint_dir(spark)
    toks = known.select("y", F.explode(T.regex_words("text")).alias("tok"))
    counts = toks.groupBy("tok").agg(F.count_if(F.col("y") == 1).alias("c1"), F.count_if(F.col("y") == 0).alias("c0")).checkpoint(eager=True)
    n1, n0, v = counts.agg(F.sum("c1"), F.sum("c0"), F.count(F.lit(1))).first()
    d1, d0 = known.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    s1, s0 = float((n1 or 0) + v) or 1.0, float((n0 or 0) + v) or 1.0
    w = F.log((F.col("c1") + 1.0) / F.lit(s1)) - F.log((F.col("c0") + 1.0) / F.lit(s0))
    return counts.select("tok", w.alias("w"), (F.col("c1") + F.col("c0")).alias("n")), math.log((d1 + 1.0) / (d0 + 1.0))


def score_naive_bayes(docs: DataFrame, keys: list[str], weights: DataFrame, prior: float, text_col: str = "text") -> DataFrame:
    """Add ``z``, ``label`` (POSITIVE if z >= 0) and ``score`` (winning-class probability)."""
    toks = docs.select(*keys, F.explode(T.regex_words(text_col)).alias("tok"))
    sums = token_sums(toks, weights, keys, "tok", "w", "n").select(*keys, F.col("total").alias("_s"))
    z = F.round(F.lit(float(prior)) + F.coalesce(F.col("_s"), F.lit(0.0)), Z_DIGITS)
    out = docs.join(sums, keys, "left").withColumn("z", z).drop("_s")
    return out.withColumn(
        "label", F.when(F.col("z") >= 0, F.lit(K.LABEL_POSITIVE)).otherwise(F.lit(K.LABEL_NEGATIVE))
    ).withColumn("score", F.round(1.0 / (1.0 + F.exp(-F.abs(F.col("z")))), Z_DIGITS))


def neutralize(df: DataFrame, band: float | None = K.NEUTRAL_BAND, label_col: str = "label",
               score_col: str = "score", out_col: str = "neutralized") -> DataFrame:
    """NEUTRAL when the score lies within ``band`` of 0.5 (inclusive); NULL band keeps labels."""
    return df.withColumn(out_col, T.neutral_label(label_col, score_col, band))
