"""Registered queries over the test tables and their DuckDB oracle SQL.

Every query reads whole tables (no sampling, no id subsets) and returns a DataFrame whose column
names equal those of its oracle statement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import rules as R
from candor.functions import text as T
from candor.plans import oracle as O
from candor.sources.lines import documents_lines, load_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def doc_lines(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    return documents_lines(load_table(spark, sf_dir, "documents"), keep=keep)


# =============================================================================================
# Sources and scalar functions
# =============================================================================================

@register("lines_scan", f"WITH {O.lines_cte()} SELECT doc_id, line_no, lang, text FROM lines")
def q_lines_scan(spark, sf_dir):
    return doc_lines(spark, sf_dir, keep=["lang"]).select("doc_id", "line_no", "lang", "text")


_FEATURES_SQL = f"""WITH {O.lines_cte()},
n AS (SELECT doc_id, line_no, text, {O.collapse_ws('text')} AS norm FROM lines)
SELECT doc_id, line_no, norm,
  {O.ws_word_count('norm')} AS ws_words,
  {O.regex_word_count('norm')} AS regex_words,
  {O.ends_with_period('norm')} AS ends_period,
  {O.terminator_chars('norm')} AS term_chars,
  {O.terminator_runs('norm')} AS term_runs,
  ({O.terminator_runs('norm')} = 1) AS one_sentence,
  {O.one_sentence_period('norm')} AS one_sentence_period,
  ({O.ws_word_count('norm')} BETWEEN {K.WORD_LOW} AND {K.WORD_HIGH}) AS in_window,
  {O.unchanged('norm', 'text')} AS norm_unchanged
FROM n"""


@register("text_features", _FEATURES_SQL)
def q_text_features(spark, sf_dir):
    df = doc_lines(spark, sf_dir).withColumn("norm", T.collapse_ws("text"))
    return df.select(
        "doc_id",
        "line_no",
        "norm",
        T.ws_word_count("norm", collapsed=True).alias("ws_words"),
        T.regex_word_count("norm").alias("regex_words"),
        T.ends_with_period("norm").alias("ends_period"),
        T.terminator_chars("norm").alias("term_chars"),
        T.terminator_runs("norm").alias("term_runs"),
        T.is_one_sentence("norm").alias("one_sentence"),
        T.one_sentence_period("norm").alias("one_sentence_period"),
        T.in_word_window(T.ws_word_count("norm", collapsed=True)).alias("in_window"),
        T.unchanged("norm", "text").alias("norm_unchanged"),
    )


_FLAGS_SQL = f"""WITH {O.lines_cte()}
SELECT doc_id, line_no,
  regexp_replace(regexp_replace({O.collapse_ws('text')}, '[^.!?]', '0', 'g'), '[.!?]', '1', 'g') AS flags
FROM lines"""


@register("char_flags", _FLAGS_SQL)
def q_char_flags(spark, sf_dir):
    return doc_lines(spark, sf_dir).select("doc_id", "line_no", T.char_flags("text").alias("flags"))


_NGRAM_SQL = f"""WITH {O.lines_cte()}, {O.line_tokens_cte()}
SELECT doc_id, line_no,
  {O.has_repeated_ngram('_toks', 2)} AS repeated_bigram,
  {O.has_repeated_ngram('_toks', 3)} AS repeated_trigram
FROM tlines"""


@register("repeated_ngrams", _NGRAM_SQL)
def q_repeated_ngrams(spark, sf_dir):
    return doc_lines(spark, sf_dir).select(
        "doc_id",
        "line_no",
        T.has_repeated_ngram("text", 2).alias("repeated_bigram"),
        T.has_repeated_ngram("text", 3).alias("repeated_trigram"),
    )


_FIRST_SQL = f"""WITH {O.lines_cte()}
SELECT doc_id, line_no,
  {O.first_sentence('text')} AS first_as_is,
  {O.first_sentence('text', clean=True)} AS first_clean
FROM lines"""


@register("first_sentence", _FIRST_SQL)
def q_first_sentence(spark, sf_dir):
    return doc_lines(spark, sf_dir).select(
        "doc_id",
        "line_no",
        T.first_sentence("text").alias("first_as_is"),
        T.first_sentence("text", clean=True).alias("first_clean"),
    )


def _templates_sql() -> str:
    rows = ", ".join(f"({O.S(n)}, {O.S(p)}, {O.S(s)})" for n, p, s in K.TEMPLATES)
    return f"templates(template, prefix, suffix) AS (VALUES {rows})"


_PROMPTS_SQL = f"""WITH {O.lines_cte()}, {_templates_sql()}
SELECT doc_id, line_no, template, prefix || text || suffix AS prompt,
  {O.S(K.BATCH_PREFIX)} || prefix || text || suffix AS batch_prompt
FROM lines, templates"""


@register("prompts_rendered", _PROMPTS_SQL)
def q_prompts_rendered(spark, sf_dir):
    from candor.sources.prompts import render_templates

    return render_templates(doc_lines(spark, sf_dir), "text").select(
        "doc_id", "line_no", "template", "prompt", F.concat(F.lit(K.BATCH_PREFIX), "prompt").alias("batch_prompt")
    )


# =============================================================================================
# Validators
# =============================================================================================

def _sql_rules_split(x: str, wc: str) -> list[tuple[str, str]]:
    return [
        (O.S(K.MSG_NO_PERIOD), f"NOT {O.ends_with_period(x)}"),
        (O.S(K.MSG_MULTI), f"NOT {O.one_sentence_period(x)}"),
        (O.S(K.MSG_TOO_SHORT), f"{wc} < {K.WORD_LOW}"),
        (O.S(K.MSG_TOO_LONG), f"{wc} > {K.WORD_HIGH}"),
    ]


def _sql_rules_rewrite(x: str) -> list[tuple[str, str]]:
    wc = O.ws_word_count(x)
    return [
        (O.S(K.MSG_NO_PERIOD), f"NOT {O.ends_with_period(x)}"),
        (O.S(K.MSG_MULTI), f"{O.ends_with_period(x)} AND NOT {O.one_sentence_period(x)}"),
        (O.S(K.MSG_TOO_SHORT), f"{wc} < {K.WORD_LOW}"),
        (O.S(K.MSG_TOO_LONG), f"{wc} > {K.WORD_HIGH}"),
    ]


def _sql_validation(rules: list[tuple[str, str]], sep: str = K.NOTES_SEP) -> str:
    fails = " OR ".join(f"({c})" for _, c in rules)
    return f"NOT ({fails}) AS passed, {O.concat_notes(rules, sep)} AS notes"


def _validator_sql(rules_of_norm: Callable[[str], list[tuple[str, str]]]) -> str:
    return f"""WITH {O.lines_cte()},
n AS (SELECT doc_id, line_no, {O.collapse_ws('text')} AS norm FROM lines)
SELECT doc_id, line_no, {_sql_validation(rules_of_norm('norm'))} FROM n"""


def _single_rules(x: str) -> list[tuple[str, str]]:
    wc = O.regex_word_count(x)
    return [
        (O.S(K.MSG_SINGLE_PERIOD), f"NOT {O.ends_with_period(x)}"),
        (O.S(K.MSG_SINGLE_ONE), f"NOT {O.one_sentence_period(x)}"),
        (f"printf({O.S(K.MSG_SINGLE_WORDS)}, {wc})", f"NOT ({wc} BETWEEN {K.WORD_LOW} AND {K.WORD_HIGH})"),
    ]


def _line_validator(profile: str) -> QueryFn:
    def fn(spark, sf_dir):
        return R.validate_df(doc_lines(spark, sf_dir), profile).select("doc_id", "line_no", "passed", "notes")

    return fn


register("validate_single", _validator_sql(_single_rules))(_line_validator("single"))
register("validate_regex", _validator_sql(lambda x: _sql_rules_split(x, O.regex_word_count(x))))(
    _line_validator("regex_words")
)
register("validate_split", _validator_sql(lambda x: _sql_rules_split(x, O.ws_word_count(x))))(
    _line_validator("split_words")
)
register("validate_rewrite", _validator_sql(_sql_rules_rewrite))(_line_validator("rewrite"))
register("validate_summary", _validator_sql(lambda x: _sql_rules_rewrite(x)[:2]))(_line_validator("summary"))

_STRATEGY_SQL = f"""WITH {O.lines_cte()}
SELECT doc_id, line_no,
  ({O.terminator_runs('text')} = 1 AND {O.ends_with_period(O.strip_ws('text'))}
   AND {O.ws_word_count('text')} BETWEEN {K.WORD_LOW} AND {K.WORD_HIGH}) AS passed
FROM lines"""


@register("validate_strategy", _STRATEGY_SQL)
def q_validate_strategy(spark, sf_dir):
    return R.validate_df(doc_lines(spark, sf_dir), "strategy_eval").select("doc_id", "line_no", "passed")


def _reason_rules(x: str) -> list[tuple[str, str]]:
    wc = O.ws_word_count(x)
    return [
        (O.S(K.REASON_MULTI), f"{O.terminator_runs(x)} <> 1"),
        (O.S(K.REASON_NO_PERIOD), f"NOT {O.ends_with_period(O.strip_ws(x))}"),
        (f"printf({O.S(K.REASON_WORDS)}, {wc})", f"NOT ({wc} BETWEEN {K.WORD_LOW} AND {K.WORD_HIGH})"),
        (O.S(K.REASON_REPEAT), O.has_repeated_ngram("_toks", 2)),
    ]


def _reasons_sql_cols(x: str) -> str:
    rules = _reason_rules(x)
    fails = " OR ".join(f"({c})" for _, c in rules[:3])
    notes = O.concat_notes(rules, K.REASON_SEP)
    return f"NOT ({fails}) AS passed, coalesce(nullif({notes}, ''), {O.S(K.REASON_NONE)}) AS notes"


_REASONS_SQL = f"""WITH {O.lines_cte()}, {O.line_tokens_cte()}
SELECT doc_id, line_no, {_reasons_sql_cols('text')} FROM tlines"""


@register("failure_reasons", _REASONS_SQL)
def q_failure_reasons(spark, sf_dir):
    return R.validate_df(doc_lines(spark, sf_dir), "failure_reason").select("doc_id", "line_no", "passed", "notes")


# Pairs (original line, candidate = its clean first sentence) for the unchanged-aware profiles.
_PAIRS_CTE = f"""{O.lines_cte()},
pairs AS (SELECT doc_id, line_no, text, {O.first_sentence('text', clean=True)} AS candidate FROM lines)"""

_GUARDED_SQL = f"""WITH {_PAIRS_CTE}
SELECT doc_id, line_no, candidate,
  {_sql_validation(_sql_rules_rewrite(O.collapse_ws('candidate')) + [(O.S(K.MSG_UNCHANGED), O.unchanged('candidate', 'text'))])}
FROM pairs"""


def _pairs(spark, sf_dir):
    return doc_lines(spark, sf_dir).withColumn("candidate", T.first_sentence("text", clean=True))


@register("validate_guarded", _GUARDED_SQL)
def q_validate_guarded(spark, sf_dir):
    v = R.validate_df(_pairs(spark, sf_dir), "rewrite_guarded", "candidate", original_col="text")
    return v.select("doc_id", "line_no", "candidate", "passed", "notes")


def _annotate_sql() -> str:
    x = O.collapse_ws("candidate")
    rules = _sql_rules_split(x, O.ws_word_count(x))
    fails = " OR ".join(f"({c})" for _, c in rules)
    notes = O.concat_notes(rules, K.NOTES_SEP)
    return f"""WITH {_PAIRS_CTE}
SELECT doc_id, line_no, candidate, NOT ({fails}) AS passed,
  CASE WHEN {notes} = '' AND {O.unchanged(x, 'text')} THEN {O.S(K.MSG_UNCHANGED)} ELSE {notes} END AS notes
FROM pairs"""


@register("annotate_unchanged", _annotate_sql())
def q_annotate_unchanged(spark, sf_dir):
    v = R.validate_df(_pairs(spark, sf_dir), "annotate_unchanged", "candidate", original_col="text")
    return v.select("doc_id", "line_no", "candidate", "passed", "notes")


# =============================================================================================
# Flagship: documents -> lines -> rules -> per-language report
# =============================================================================================

def _note_count(message: str, alias: str) -> str:
    return f"count(*) FILTER (WHERE contains(notes, {O.S(message)})) AS {alias}"


@register("lines_report", f"""WITH {O.lines_cte()},
n AS (SELECT lang, {O.collapse_ws('text')} AS norm FROM lines),
v AS (SELECT lang, {O.ws_word_count('norm')} AS words, {_sql_validation(_sql_rules_split('norm', O.ws_word_count('norm')))} FROM n)
SELECT lang, count(*) AS rows, count(*) FILTER (WHERE passed) AS passed,
  round(100.0 * avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END), 9) AS pass_pct, round(avg(words), 9) AS avg_words,
  {_note_count(K.MSG_NO_PERIOD, 'no_period')}, {_note_count(K.MSG_MULTI, 'multi_sentence')},
  {_note_count(K.MSG_TOO_SHORT, 'too_short')}, {_note_count(K.MSG_TOO_LONG, 'too_long')}
FROM v GROUP BY lang""")
def q_lines_report(spark, sf_dir):
    from candor.plans.jobs import lines_report

    out = lines_report(spark, sf_dir)
    return out.withColumn("pass_pct", F.round("pass_pct", 9)).withColumn("avg_words", F.round("avg_words", 9))


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)


def _load_all() -> None:
    """Import the query modules that register themselves."""
    from candor.plans import queries_ext, queries_gen  # noqa: F401
