"""Choosing one candidate per key from scored candidates ``(keys..., cand_id, score)``.

* Deterministic decoding: highest score, lowest ``cand_id`` on ties.
* Sampling decoding: temperature -> top-k -> top-p (nucleus) -> a seeded weighted draw (exponential race: the
  candidate minimising ``-ln(u)/p`` wins, ``u`` from ``strategies.uniform``), reproducible under any partitioning.
  ``top_k`` None or 0 and ``top_p`` None cut nothing; ``temperature`` None is 1, and it must be above 0.

``choose`` selects for any number of strategies in one pass over narrow rows: one shuffle by key, one sort,
one aggregate. Texts are not part of it; ``with_texts`` fetches the winners' texts from the source with one join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor import constants as K
from candor.operators.strategies import uniform

# Digits kept when comparing floating sums that two engines may add in different orders.
CUM_DIGITS = 9


def sampling_parameters(params: dict) -> tuple[float, float | None, int | None]:
    """``(temperature, top_p, top_k)`` of a strategy row, None where nothing is cut."""
    t, p, k = params.get("temperature"), params.get("top_p"), params.get("top_k")
    t = 1.0 if t is None else float(t)
    if t <= 0:
        raise ValueError("temperature must be above 0")
    return t, None if p is None else float(p), int(k) if k else None


def choose(scores: DataFrame, keys: list[str], strategies: list[dict], seed: int = K.DEFAULT_SEED,
           cand: str = "cand_id", score: str = "score") -> DataFrame:
    """``(keys, choices)``: per key an array of ``(strategy_rank, decoding, cand_id, score, prob)``, one per strategy.

    Of a strategy row only ``do_sample``, ``temperature``, ``top_p`` and ``top_k`` choose; the n-gram, penalty and length
    columns are audited on the outputs (``rewrite.length_bounds``, ``text.has_repeated_ngram``). ``prob`` is NULL
    for deterministic strategies.
    """
    w_key = Window.partitionBy(*keys)
    df = scores.select(*keys, F.col(cand).alias("cand_id"), F.col(score).alias("score"))
    w_rank = w_key.orderBy(F.col("score").desc(), F.col("cand_id").asc())
    w_before = w_rank.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_rn", F.row_number().over(w_rank))
    aggs = [F.expr("min_by(struct(cand_id, score), _rn) AS _best")]
    picked = []
    for i, s in enumerate(strategies):
        name = [F.lit(i).alias("strategy_rank"), F.lit(s["strategy"]).alias("decoding")]
        if not s.get("do_sample"):
            picked.append(F.struct(*name, F.col("_best.cand_id"), F.col("_best.score"), F.lit(None).cast("double").alias("prob")))
            continue
        t, p, k = sampling_parameters(s)
        logit = F.col("score") / F.lit(t)
        z = F.exp(logit - F.max(logit).over(w_key))
        df = df.withColumn(f"_z{i}", F.when(F.col("_rn") <= k, z) if k else z)
        df = df.withColumn(f"_p{i}", F.col(f"_z{i}") / F.sum(f"_z{i}").over(w_key))
        if p is not None:
            before = F.round(F.coalesce(F.sum(f"_p{i}").over(w_before), F.lit(0.0)), CUM_DIGITS)
            df = df.withColumn(f"_p{i}", F.when(before < F.lit(p), F.col(f"_p{i}")))
        race = -F.log(uniform(seed, *keys, F.lit(s["strategy"]), "cand_id")) / F.col(f"_p{i}")
        df = df.withColumn(f"_r{i}", race)
        aggs.append(F.expr(f"min_by(struct(cand_id, score, _p{i} AS prob), struct(_r{i}, cand_id)) FILTER (WHERE _p{i} IS NOT NULL) AS _s{i}"))
        picked.append(F.struct(*name, F.col(f"_s{i}.cand_id"), F.col(f"_s{i}.score"), F.col(f"_s{i}.prob")))
    return df.groupBy(*keys).agg(*aggs).select(*keys, F.array(*picked).alias("choices"))


def with_texts(choices: DataFrame, source: DataFrame, keys: list[str], texts: Callable[[Column], Column], text_col: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """``(keys, keep, choices)`` with each choice's ``text``, taken from the array ``texts(text)`` at ``cand_id``.

    The source's text passes one exchange, however many strategies there are.
    """
    keep = keep or []
    joined = source.select(*keys, *keep, texts(F.col(text_col)).alias("_texts")).join(choices, keys)
    filled = F.transform("choices", lambda c: F.struct(*[c[f].alias(f) for f in ("strategy_rank", "decoding", "cand_id", "score", "prob")],
                                                       F.btrim(F.get("_texts", c["cand_id"] - 1)).alias("text")))
    return joined.select(*keys, *keep, filled.alias("choices"))


def best_candidate(cands: DataFrame, keys: list[str], cand: str = "cand_id", score: str = "score",
                   cols: list[str] | None = None) -> DataFrame:
    """Argmax of ``score`` per key (ties: smallest ``cand``) with ``cols`` of the chosen row."""
    return _one(cands, keys, {"strategy": "best"}, K.DEFAULT_SEED, cand, score, cols).drop("prob")


def sample_candidate(cands: DataFrame, keys: list[str], strategy: str, temperature: float | None = 1.0,
                     top_p: float | None = 1.0, top_k: int | None = None, seed: int = K.DEFAULT_SEED,
                     cand: str = "cand_id", score: str = "score", cols: list[str] | None = None) -> DataFrame:
    """One seeded draw per key among its candidates, with temperature, top-k and top-p."""
    params = {"strategy": strategy, "do_sample": True, "temperature": temperature, "top_p": top_p, "top_k": top_k}
    return _one(cands, keys, params, seed, cand, score, cols)


def _one(cands, keys, params, seed, cand, score, cols) -> DataFrame:
    cols = ["text"] if cols is None else cols
    win = choose(cands, keys, [params], seed, cand, score).select(*keys, F.col("choices")[0].alias("_c"))
    win = win.select(*keys, F.col("_c.cand_id").alias(cand), F.col("_c.prob").alias("prob"))
    out = win.join(cands.select(*keys, cand, score, *cols), [*keys, cand]) if cols else win
    return out.select(*keys, cand, *cols, *([score] if cols else []), "prob")
