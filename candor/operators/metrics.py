"""Aggregations over candidate tables: strategy evaluation, mini report, guardrail metrics,
label distributions, reason histograms, failure listings.

All are ``groupBy`` aggregates (partial aggregation before the shuffle), so a strategy or label
holding most rows never lands whole in one task. Rates are 0.0 on empty input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import rules as R
from candor.functions import text as T


def _pct(cond: Column) -> Column:
    return F.coalesce(100.0 * F.avg(F.when(cond, 1.0).otherwise(0.0)), F.lit(0.0))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _fill_groups(agg: DataFrame, group: str, names: list[str] | None, zeros: dict[str, object]) -> DataFrame:
    """Left-join the aggregate onto a fixed list of group names so empty groups report zeros."""
    if not names:
        return agg
    spark = agg.sparkSession
    base = spark.createDataFrame([(n, i) for i, n in enumerate(names)], f"{group} STRING, _rank INT")
    out = base.join(agg, group, "left")  # both sides hold one row per group
    for c, z in zeros.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(z)))
    return out.drop("_rank")


def strategy_eval(df: DataFrame, text_col: str = "output", group: str | list[str] = "decoding",
                  names: list[str] | None = None) -> DataFrame:
    """Pass %, mean and population std of whitespace word counts, repetition % per strategy."""
    groups = [group] if isinstance(group, str) else list(group)
    v = _eval_features(df, text_col)
    agg = v.groupBy(*groups).agg(*_eval_aggs())
    if isinstance(group, str):
        agg = _fill_groups(agg, group, names, {"pass_pct": 0.0, "avg_wc": 0.0, "std_wc": 0.0, "repeat_pct": 0.0})
    return agg


def family_rollup(df: DataFrame, text_col: str = "output", family: str = "family", group: str = "decoding") -> DataFrame:
    """Strategy evaluation broken down by family, with per-family and grand totals (ROLLUP)."""
    v = _eval_features(df, text_col)
    return v.rollup(family, group).agg(F.count(F.lit(1)).alias("n"), *_eval_aggs())


def _eval_features(df: DataFrame, text_col: str) -> DataFrame:
    """Per row, once: strategy-eval pass (= no failing reason), word count, repetition flag."""
    v = R.validate_df(df, "failure_reason", text_col, passed="_ok", notes="_reason", words="_wc")
    return v.withColumn("_rep", F.col("_reason").contains(K.REASON_REPEAT))


def _eval_aggs() -> list[Column]:
    return [
        _pct(F.col("_ok")).alias("pass_pct"),
        _zero(F.avg("_wc").cast("double")).alias("avg_wc"),
        _zero(F.stddev_pop("_wc")).alias("std_wc"),
        _pct(F.col("_rep")).alias("repeat_pct"),
    ]


def reflection(mode: Column) -> Column:
    return F.when(mode == "beam", F.lit(K.REFLECTION_BEAM)).otherwise(F.lit(K.REFLECTION_SAMPLING))


def mini_report(df: DataFrame, modes: list[str] | None = ("beam", "sampling"), group: str = "decoding",
                passed_col: str = "constraint_passed", tokens_col: str = "tokens_out") -> DataFrame:
    """Per mode: rows, pass %, average tokens_out and the fixed reflection; "No rows." if empty."""
    agg = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"),
        _pct(F.col(passed_col)).alias("pass_pct"),
        _zero(F.avg(F.col(tokens_col)).cast("double")).alias("avg_tokens"),
    )
    agg = _fill_groups(agg, group, list(modes) if modes else None, {"rows": 0, "pass_pct": 0.0, "avg_tokens": 0.0})
    return agg.withColumn(
        "reflection", F.when(F.col("rows") == 0, F.lit(K.NO_ROWS)).otherwise(reflection(F.col(group)))
    )


def guardrail_metrics(df: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Beam/sampling pass %, average words, retry count and retry fix-rate (0.0 without retries).

    Input columns: ``passed, words, sampled_passed, sampled_words, retried, retry_passed``.
    """
    retried = F.count_if(F.col("retried"))
    fixed = F.count_if(F.col("retried") & F.coalesce(F.col("retry_passed"), F.lit(False)))
    aggs = [
        F.count(F.lit(1)).alias("n"),
        _pct(F.col("passed")).alias("beam_pass_pct"),
        _pct(F.col("sampled_passed")).alias("sampling_pass_pct"),
        _zero(F.avg("words").cast("double")).alias("avg_words_beam"),
        _zero(F.avg("sampled_words").cast("double")).alias("avg_words_sampling"),
        retried.alias("retry_triggered"),
        _zero(F.try_divide(100.0 * fixed, retried)).alias("retry_fix_pct"),
    ]
    return df.groupBy(*(group or [])).agg(*aggs)


def label_distribution(df: DataFrame, label_col: str = "label", neutral_col: str = "neutralized",
                       group: list[str] | None = None) -> DataFrame:
    """Zero-filled raw (POSITIVE/NEGATIVE) and neutralised (+NEUTRAL) counts; NULL and other labels count as unknown."""
    lab, neu = F.col(label_col), F.col(neutral_col)
    return df.groupBy(*(group or [])).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(lab == K.LABEL_POSITIVE).alias("raw_pos"),
        F.count_if(lab == K.LABEL_NEGATIVE).alias("raw_neg"),
        F.count_if(neu == K.LABEL_POSITIVE).alias("pos"),
        F.count_if(neu == K.LABEL_NEGATIVE).alias("neg"),
        F.count_if(neu == K.LABEL_NEUTRAL).alias("neu"),
        F.count_if(~F.coalesce(lab.isin(K.LABEL_POSITIVE, K.LABEL_NEGATIVE), F.lit(False))).alias("unknown_labels"),
    )


def reason_histogram(df: DataFrame, notes_col: str = "notes", group: str | list[str] = "decoding",
                     sep: str = K.NOTES_SEP) -> DataFrame:
    """How often each reason occurs per group (reasons split from joined notes)."""
    groups = [group] if isinstance(group, str) else list(group)
    exploded = df.where(F.col(notes_col) != "").select(
        *groups, F.explode(F.split(F.col(notes_col), _regex_quote(sep))).alias("reason")
    )
    return exploded.groupBy(*groups, "reason").agg(F.count(F.lit(1)).alias("n"))


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in s)


def reasons(df: DataFrame, text_col: str = "output", keys: list[str] | None = None, group: str = "decoding", keep_text: bool = True) -> DataFrame:
    """Every row's failure reason; without the text where only the reason is wanted."""
    v = R.validate_df(df.select(*(keys or []), group, text_col), "failure_reason", text_col, notes="reason").drop("passed")
    return v if keep_text else v.drop(text_col)


def failing(df: DataFrame) -> DataFrame:
    """Rows of ``reasons`` whose reason is not "passes"."""
    return df.where(F.col("reason") != K.REASON_NONE)


def failures_listed(df: DataFrame, text_col: str = "output", keys: list[str] | None = None,
                    group: str = "decoding") -> DataFrame:
    """Rows whose failure reason is not "passes", with the reason; keyed by the input ordinal."""
    return failing(reasons(df, text_col, keys, group))


def all_passed_strategies(strategies: DataFrame, failures: DataFrame, group: str = "decoding") -> DataFrame:
    """Strategies with no listed failure (anti join), marked "(all passed)"."""
    return strategies.select(group).join(failures.select(group), group, "left_anti").withColumn(
        "status", F.lit(K.ALL_PASSED)
    )


def skipped_rows(df: DataFrame, known: list[str], group: str = "decoding") -> DataFrame:
    """Rows kept vs skipped because their strategy is not one of ``known``."""
    ok = F.col(group).isin(*known)
    return df.agg(F.count_if(ok).alias("kept"), F.count_if(~ok | F.col(group).isNull()).alias("skipped"))


def repeated_ngram_positions(df, keys: list[str], text_col: str = "text", n: int = 2):
    """Exploded form of the repetition check: per text, the 0-based position of the first n-gram
    that was already seen, and how many repeated occurrences there are (texts with repeats only).

    Row-local: a text's n-grams are sorted with their positions inside the row; equal neighbours are repeats.
    """
    ordered = F.array_sort(F.transform(T.ngrams(text_col, n), lambda g, i: F.struct(g.alias("g"), i.alias("pos"))))
    rows = df.select(*keys, ordered.alias("_s"))
    again = F.zip_with("_s", F.slice("_s", 2, F.size("_s") + 1), lambda x, y: F.when(x["g"] == y["g"], y["pos"]))
    out = rows.select(*keys, F.filter(again, lambda x: x.isNotNull()).alias("_r")).where(F.size("_r") > 0)
    return out.select(*keys, F.array_min("_r").alias("first_repeat_pos"), F.size("_r").cast("long").alias("n_repeats"))
