"""Row-level text functions (all JVM-side Column expressions, whole-stage codegen friendly).

Whitespace, word and sentence semantics follow Python's str.split()/str.strip() exactly by using
the explicit whitespace class of ``constants.WS_CLASS`` instead of Spark's ``trim``/``\\s``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from candor import constants as K

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- whitespace -------------------------------------------------------------------------------

def strip_ws(t: ColumnOrName) -> Column:
    """``str.strip()``: remove leading/trailing Python whitespace, keep the interior."""
    return F.btrim(_c(t), F.lit(K.WS_CHARS))


def collapse_ws(t: ColumnOrName) -> Column:
    """``" ".join(t.split())``: every whitespace run becomes one space, ends trimmed."""
    return F.btrim(F.regexp_replace(_c(t), K.WS_CLASS + "+", " "))


def ws_tokens(t: ColumnOrName, lower: bool = False) -> Column:
    """``t.split()`` as ARRAY<STRING> (empty text gives an empty array)."""
    x = collapse_ws(F.lower(_c(t)) if lower else _c(t))
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, " "))


# --- counts -----------------------------------------------------------------------------------

def ws_word_count(t: ColumnOrName, collapsed: bool = False) -> Column:
    """``len(t.split())``: spaces of the collapsed text plus one (no regex match list)."""
    x = _c(t) if collapsed else collapse_ws(t)
    n = F.char_length(x) - F.char_length(F.replace(x, F.lit(" "), F.lit(""))) + 1
    return F.when(x == "", F.lit(0)).otherwise(n)


def regex_word_count(t: ColumnOrName) -> Column:
    """Count of regex words (word characters, apostrophes, hyphens)."""
    return F.regexp_count(_c(t), F.lit(K.REGEX_WORD))


def regex_words(t: ColumnOrName, lower: bool = True) -> Column:
    """The regex words of a text as ARRAY<STRING> (lower-cased by default)."""
    x = F.lower(_c(t)) if lower else _c(t)
    return F.regexp_extract_all(x, F.lit("(" + K.REGEX_WORD + ")"), 1)


def terminator_chars(t: ColumnOrName) -> Column:
    """Number of ``.``, ``!``, ``?`` characters (``"Wait..."`` counts 3)."""
    return F.char_length(_c(t)) - F.char_length(F.translate(_c(t), ".!?", ""))


def terminator_runs(t: ColumnOrName) -> Column:
    """Number of terminator runs (``"Wait..."`` counts 1)."""
    return F.regexp_count(_c(t), F.lit(K.TERMINATOR_RUN))


# --- predicates -------------------------------------------------------------------------------

def ends_with_period(t: ColumnOrName) -> Column:
    return _c(t).endswith(".")


def is_one_sentence(t: ColumnOrName) -> Column:
    """Exactly one terminator run."""
    return terminator_runs(t) == 1


def one_sentence_period(t: ColumnOrName) -> Column:
    """Ends with a period and holds exactly one terminator character."""
    return ends_with_period(t) & (terminator_chars(t) == 1)


def in_word_window(n: ColumnOrName, low: int = K.WORD_LOW, high: int = K.WORD_HIGH) -> Column:
    return _c(n).between(low, high)


def ngrams(t: ColumnOrName, n: int, lower: bool = True, collapsed: bool = False) -> Column:
    """Consecutive whitespace-token n-grams of a text, each joined by one space.

    One regex pass over the collapsed text: at every token start a lookahead captures the next
    ``n`` tokens, so overlapping n-grams come out in order without per-element lambdas
    (higher-order functions are evaluated without code generation).
    """
    x = F.lower(_c(t)) if lower else _c(t)
    x = x if collapsed else collapse_ws(x)
    pattern = r"(?<![^ ])(?=([^ ]+" + r"(?: [^ ]+)" * (n - 1) + r"))"
    return F.regexp_extract_all(x, F.lit(pattern), 1)


def has_repeated_ngram(t: ColumnOrName, n: int = 2, collapsed: bool = False) -> Column:
    """True when a case-folded whitespace n-gram occurs twice (n=2 is the repetition check)."""
    grams = ngrams(t, n, collapsed=collapsed)
    return F.size(F.array_distinct(grams)) < F.size(grams)


def has_repetition(t: ColumnOrName) -> Column:
    return has_repeated_ngram(t, 2)


def copied_ngram_count(source: ColumnOrName, output: ColumnOrName, n: int = 4) -> Column:
    """Distinct case-folded n-grams of ``output`` that also occur in ``source``."""
    return F.size(F.array_intersect(ngrams(output, n), ngrams(source, n)))


def unchanged(output: ColumnOrName, original: ColumnOrName) -> Column:
    """Case-insensitive equality after ``strip()`` (interior whitespace is not collapsed)."""
    return F.lower(strip_ws(output)) == F.lower(strip_ws(original))


# --- rewrites of the text ---------------------------------------------------------------------

def first_sentence(t: ColumnOrName, clean: bool = False) -> Column:
    """First sentence of a model answer, ending with a period.

    Whitespace is collapsed, echoed ``summarize ...:`` instructions (and one opening quote) are
    removed, the text is split on a terminator followed by space and the first part, stripped of
    spaces and quotes, gets a final ".". With ``clean=False`` a lone sentence that already ends in
    "." keeps it ("Foo bar." -> "Foo bar.."); ``clean=True`` drops a trailing terminator run first.
    """
    x = F.regexp_replace(collapse_ws(t), K.ECHO_PATTERN, "")
    first = F.btrim(F.split(x, K.SENTENCE_SPLIT, 2).getItem(0), F.lit(K.QUOTE_STRIP))
    if clean:
        first = F.regexp_replace(first, K.TERMINATOR_RUN + r"\z", "")
    return F.concat(first, F.lit("."))


def neutral_label(label: ColumnOrName, score: ColumnOrName, band: float | None = K.NEUTRAL_BAND) -> Column:
    """NEUTRAL when ``abs(score - 0.5) <= band`` (binary doubles); no band keeps the label."""
    if band is None:
        return _c(label)
    near = F.abs(_c(score).cast("double") - F.lit(K.NEUTRAL_CENTRE)) <= F.lit(float(band))
    return F.when(near, F.lit(K.LABEL_NEUTRAL)).otherwise(_c(label))


def preview(t: ColumnOrName, n: int = K.PREVIEW_CHARS) -> Column:
    """First ``n`` characters plus "..." when the text is longer."""
    return F.concat(
        F.substring(_c(t), 1, n),
        F.when(F.char_length(_c(t)) > n, F.lit("...")).otherwise(F.lit("")),
    )


def notes_or_dash(notes: ColumnOrName) -> Column:
    return F.coalesce(F.nullif(_c(notes), F.lit("")), F.lit("-"))


def bool_str(b: ColumnOrName) -> Column:
    """"True"/"False" as printed by Python."""
    return F.initcap(_c(b).cast("string"))


def fixed_point(x: ColumnOrName, digits: int) -> Column:
    """A double (under 1e9) with ``digits`` decimals: its exact binary value rounded, halves to even, as Python prints it.

    The value is split into two halves of 26 bits, whose products with the power of ten are exact.
    """
    x = _c(x).cast("double")
    a, p = F.abs(x), F.lit(float(10 ** digits))
    c = a * F.lit(134217729.0)
    high = c - (c - a)
    low = a - high
    whole = F.floor(a * p).cast("double")
    rest = (high * p - whole) + low * p
    whole = F.when(rest < 0, whole - 1).when(rest >= 1, whole + 1).otherwise(whole)
    over = ((high * p - whole) - 0.5) + low * p  # its sign is exact
    up = (over > 0) | ((over == 0) & (whole % 2 == 1))
    n = (whole + F.when(up, 1.0).otherwise(0.0)).cast("long")
    text = F.concat(F.floor(n / F.lit(10 ** digits)).cast("string"), F.lit("."), F.lpad((n % F.lit(10 ** digits)).cast("string"), digits, "0"))
    return F.concat(F.when(x < 0, "-").otherwise(""), text)


_FIXED = re.compile(r"%(\d*)\.(\d+)f")


def printf(fmt: str, *cols: ColumnOrName) -> Column:
    """``format_string`` whose ``%.nf`` rounds as Python does (``fixed_point``); its own rounds the shortest decimal form, halves up."""
    args = list(map(_c, cols))
    for i, spec in enumerate(re.findall(r"%[^%a-z]*[a-z]", fmt.replace("%%", ""))):
        fixed = _FIXED.fullmatch(spec)
        if fixed:
            args[i] = fixed_point(args[i], int(fixed[2]))
    return F.format_string(_FIXED.sub(r"%\1s", fmt), *args)


def char_flags(t: ColumnOrName) -> Column:
    """One flag per character of the collapsed text: "1" for a terminator, "0" otherwise."""
    x = collapse_ws(t)
    return F.regexp_replace(F.regexp_replace(x, r"[^.!?]", "0"), K.TERMINATOR, "1")
