"""End-to-end jobs (the reference's entry points, as DataFrame jobs with keyword parameters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import rules as R
from candor.functions import text as T
from candor.sources.lines import documents_lines, load_table


def validated_lines(lines: DataFrame, text_col: str = "text", profile: str = "split_words") -> DataFrame:
    """Attach ``norm``, ``words``, ``passed``, ``notes`` to each line under a rule profile."""
    return R.validate_df(lines, profile, text_col, words="words")


def lines_report(spark: SparkSession, sf_dir: str, profile: str = "split_words") -> DataFrame:
    """Documents -> lines -> validation -> per-language pass rate, word average, reason counts."""
    lines = documents_lines(load_table(spark, sf_dir, "documents"), keep=["lang"])
    v = validated_lines(lines, profile=profile)
    has = lambda msg: F.col("notes").contains(msg)  # noqa: E731  (the four messages are not substrings of each other)
    return v.groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("passed").alias("passed"),
        F.coalesce(100.0 * F.avg(F.col("passed").cast("double")), F.lit(0.0)).alias("pass_pct"),
        F.coalesce(F.avg("words").cast("double"), F.lit(0.0)).alias("avg_words"),
        F.count_if(has(K.MSG_NO_PERIOD)).alias("no_period"),
        F.count_if(has(K.MSG_MULTI)).alias("multi_sentence"),
        F.count_if(has(K.MSG_TOO_SHORT)).alias("too_short"),
        F.count_if(has(K.MSG_TOO_LONG)).alias("too_long"),
    )


# ---------------------------------------------------------------------------------------------
# Strategy comparison (input x strategy candidates) and guarded generation with one retry
# ---------------------------------------------------------------------------------------------

def chosen_sentences(docs: DataFrame, keys: list[str], strategies: list[dict], seed: int = K.DEFAULT_SEED,
                     keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``(keys, keep, choices)``: per text the sentence each strategy chooses (``select.choose``). ``keys`` must be unique."""
    from candor.operators.select import choose, with_texts
    from candor.operators.summarize import sentence_scores, sentences

    choices = choose(sentence_scores(docs, keys, text_col), keys, strategies, seed)
    return with_texts(choices, docs, keys, sentences, text_col, keep)


def strategy_candidates(docs: DataFrame, keys: list[str], strategies: list[dict], seed: int = K.DEFAULT_SEED,
                        keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """Long table ``(keys, keep, decoding, strategy_rank, cand_id, output)``: one chosen candidate per input and strategy."""
    keep = keep or []
    # ``choices`` is never empty; the outer form spares the filter that the planner would infer by taking the texts twice.
    rows = chosen_sentences(docs, keys, strategies, seed, keep, text_col).select(*keys, *keep, F.explode_outer("choices").alias("_c"))
    return rows.select(*keys, *keep, "_c.decoding", "_c.strategy_rank", "_c.cand_id", F.col("_c.text").alias("output"))


def wide_candidates(long: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Side-by-side view: one column per strategy (pivot over a fixed value list)."""
    return long.groupBy(*keys).pivot("decoding", names).agg(F.max("output"))


def guarded_choices(docs: DataFrame, keys: list[str], beam: dict, sampling: dict, retry: dict, post, check,
                    keep: list[str] | None = None, seed: int = K.DEFAULT_SEED, text_col: str = "text", out: str = "output") -> DataFrame:
    """Beam choice, independent sampling baseline, and the retry draw where the beam fails.

    ``post(text)`` turns a chosen candidate into an output, ``check(output)`` gives ``(passed, notes)``. Columns:
    ``keys, keep, {out}, passed, notes, words, sampled_{out}, sampled_passed, sampled_words, retried, retry_{out}, retry_passed``.
    All draws are made on narrow rows; the retry's text is only taken and checked where the beam failed.
    """
    keep = keep or []
    won = chosen_sentences(docs, keys, [beam, sampling, retry], seed, keep, text_col)
    names = ["", "sampled_", "retry_"]
    texts = won.select(*keys, *keep, *[post(F.col("choices")[i]["text"]).alias(f"{n}{out}") for i, n in enumerate(names)])
    passed, notes = check(F.col(out))
    first = texts.select("*", passed.alias("passed"), notes.alias("notes"), T.ws_word_count(out).alias("words"),
                         check(F.col(f"sampled_{out}"))[0].alias("sampled_passed"), T.ws_word_count(f"sampled_{out}").alias("sampled_words"))
    again = F.when(~F.col("passed"), F.col(f"retry_{out}"))
    second = first.withColumn("retried", ~F.col("passed")).withColumn(f"retry_{out}", again)
    return second.withColumn("retry_passed", F.coalesce(F.when(F.col("retried"), check(F.col(f"retry_{out}"))[0]), F.lit(False)))


def guarded_summaries(docs: DataFrame, keys: list[str], beam: dict, sampling: dict, retry: dict,
                      clean: bool = False, seed: int = K.DEFAULT_SEED, keep: list[str] | None = None) -> DataFrame:
    """``guarded_choices`` of one-sentence summaries under the summary rules."""
    return guarded_choices(docs, keys, beam, sampling, retry, lambda t: T.first_sentence(t, clean=clean), R.validate_summary,
                           keep, seed, out="summary")


def guarded_rewrites(lines: DataFrame, keys: list[str], beam: dict, sampling: dict, retry: dict,
                     seed: int = K.DEFAULT_SEED, text_col: str = "text") -> DataFrame:
    """``guarded_choices`` of line rewrites: white space collapsed, rewrite rules, and ``unchanged`` fails as well.

    The line itself is kept as ``input``.
    """
    src = lines.select(*keys, F.col(text_col).alias("text"), F.col(text_col).alias("input"))
    return guarded_choices(src, keys, beam, sampling, retry, T.collapse_ws, lambda c: R.validate_guarded(F.col("input"), c),
                           ["input"], seed)


def sentiment_job(lines: DataFrame, keys: list[str], labelled: DataFrame, band: float | None = K.NEUTRAL_BAND) -> tuple[DataFrame, DataFrame]:
    """Train on ``labelled(text, y)``, score ``lines``, apply the neutral band: ``(lines with report line, distributions)``."""
    from candor.operators.classify import neutralize, score_naive_bayes, train_naive_bayes
    from candor.operators.metrics import label_distribution
    from candor.operators.report import sentiment_lines

    weights, prior = train_naive_bayes(labelled)
    scored = neutralize(score_naive_bayes(lines, keys, weights, prior), band)
    return sentiment_lines(scored), label_distribution(scored)


def conversation_pairs(conv: DataFrame) -> DataFrame:
    """User turn followed by an assistant turn: ``(conv_id, turn, prompt, response)``.

    An equi-join on ``(conv_id, turn)`` / ``(conv_id, turn - 1)`` instead of a window over whole
    conversations: the join key is unique per row, so a very long conversation is spread over
    many tasks instead of one.
    """
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return u.join(a, ["conv_id", "turn"])


def rewrite_candidates(lines: DataFrame, keys: list[str], strategies: list[dict], text_col: str = "text",
                       seed: int = K.DEFAULT_SEED) -> DataFrame:
    """Batch rewrite of lines under several strategies, as CSV-ready candidate rows.

    Candidates of a line are its sentences (scored by mean idf over lines); each strategy picks
    one; the output is whitespace-collapsed and checked with the split-words rules, ``unchanged``
    noted only when nothing else is (pass unaffected). Columns: ``keys, input, output, decoding,
    strategy_rank, tokens_out, constraint_passed, notes``.
    """
    src = lines.select(*keys, F.col(text_col).alias("input"), F.col(text_col).alias("text"))
    long = strategy_candidates(src, keys, strategies, seed=seed, keep=["input"])
    out = long.withColumn("output", T.collapse_ws("output"))
    v = R.validate_df(out, "annotate_unchanged", "output", original_col="input", passed="constraint_passed",
                      words="tokens_out")
    return v.select(*keys, "input", "output", "decoding", "strategy_rank", "tokens_out", "constraint_passed", "notes")
