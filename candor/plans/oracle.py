"""DuckDB SQL snippets equivalent to ``candor.functions`` (the correctness oracle's side).

Each helper takes a SQL expression string and returns a SQL expression string; the regex
classes are the same text as on the Spark side (Java regex and RE2 agree on them).
"""

from __future__ import annotations

from candor import constants as K


def S(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, {S(chr(92) + 'A' + K.WS_CLASS + '+|' + K.WS_CLASS + '+' + chr(92) + 'z')}, '', 'g')"


def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, {S(K.WS_CLASS + '+')}, ' ', 'g'))"


def ws_word_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, {S(K.NON_WS_CLASS + '+')}))"


def regex_word_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, {S(K.REGEX_WORD)}))"


def regex_words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {S(K.REGEX_WORD)})"


def terminator_chars(x: str) -> str:
    return f"len(regexp_extract_all({x}, {S(K.TERMINATOR)}))"


def terminator_runs(x: str) -> str:
    return f"len(regexp_extract_all({x}, {S(K.TERMINATOR_RUN)}))"


def ends_with_period(x: str) -> str:
    return f"ends_with({x}, '.')"


def one_sentence_period(x: str) -> str:
    return f"({ends_with_period(x)} AND {terminator_chars(x)} = 1)"


def ws_tokens(x: str, lower: bool = False) -> str:
    inner = f"lower({x})" if lower else x
    return f"list_filter(string_split({collapse_ws(inner)}, ' '), lambda s: s <> '')"


def ngrams(toks: str, n: int) -> str:
    """Overlapping n-grams of a token-list column as structs (tokens hold no spaces, so structs equal joined n-grams)."""
    parts = ", ".join(f"{toks}[{i + 1}:greatest(len({toks}) - {n - 1 - i}, 0)]" for i in range(n))
    return f"(CASE WHEN len({toks}) >= {n} THEN list_zip({parts}) ELSE [] END)"


def has_repeated_ngram(toks: str, n: int = 2) -> str:
    """Whether an n-gram of a token-list column occurs twice."""
    g = ngrams(toks, n)
    return f"(len(list_distinct({g})) < len({g}))"


def unchanged(out: str, orig: str) -> str:
    return f"(lower({strip_ws(out)}) = lower({strip_ws(orig)}))"


def first_sentence(x: str, clean: bool = False) -> str:
    y = f"regexp_replace({collapse_ws(x)}, {S(K.ECHO_PATTERN.replace('(?iu)', '(?i)'))}, '', 'g')"
    first = f"trim(string_split_regex({y}, {S(K.SENTENCE_SPLIT)})[1], {S(K.QUOTE_STRIP)})"
    if clean:
        first = f"regexp_replace({first}, {S(K.TERMINATOR_RUN + chr(92) + 'z')}, '')"
    return f"({first} || '.')"


def concat_notes(parts: list[tuple[str, str]], sep: str) -> str:
    """``concat_ws`` of CASE WHEN cond THEN msg (NULLs skipped)."""
    items = ", ".join(f"CASE WHEN {cond} THEN {msg} END" for msg, cond in parts)
    return f"concat_ws({S(sep)}, {items})"


def bool_str(x: str) -> str:
    return f"(CASE WHEN {x} THEN 'True' ELSE 'False' END)"


def lines_cte(extra: str = "") -> str:
    """Lines of ``documents`` keyed by (doc_id, ordinal of the kept line), stripped, non-empty."""
    return f"""
doc_parts AS (
  SELECT doc_id, lang{extra}, list_filter(list_transform(string_split_regex(text, {S(K.LINE_BREAK)}), lambda p: {strip_ws('p')}),
    lambda p: p <> '') AS parts FROM documents
),
lines AS MATERIALIZED (
  SELECT doc_id, lang{extra}, unnest(generate_series(1, len(parts)))::BIGINT AS line_no, unnest(parts) AS text FROM doc_parts
)"""


def line_tokens_cte(name: str = "tlines", src: str = "lines", text: str = "text") -> str:
    """``src`` with the lower-case whitespace tokens of its text, taken once, as ``_toks``."""
    return f"{name} AS MATERIALIZED (SELECT *, {ws_tokens(text, lower=True)} AS _toks FROM {src})"
