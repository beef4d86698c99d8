"""Constraint validators: ordered rules producing ``passed`` and joined ``notes``.

A rule is ``(message, condition, fails)``: when ``condition`` holds the message is added to the
notes; ``fails=False`` rules only annotate. Messages may be Columns (e.g. carrying a count).
Every validator returns ``(passed, notes)`` Columns; ``check`` dispatches by profile name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import text as T

ColumnOrName = Column | str


@dataclass(frozen=True)
class Rule:
    message: Column | str
    condition: Column
    fails: bool = True


def apply_rules(rules: list[Rule], sep: str = K.NOTES_SEP, none: str = "") -> tuple[Column, Column]:
    """Evaluate ordered rules into ``(passed, notes)``; ``notes`` is ``none`` when nothing fired."""
    msgs = [F.when(r.condition, r.message if isinstance(r.message, Column) else F.lit(r.message)) for r in rules]
    notes = F.concat_ws(sep, *msgs)
    if none:
        notes = F.coalesce(F.nullif(notes, F.lit("")), F.lit(none))
    failing = [r.condition for r in rules if r.fails]
    any_fail = failing[0]
    for c in failing[1:]:
        any_fail = any_fail | c
    return ~any_fail, notes


def _text(t: ColumnOrName) -> Column:
    c = F.col(t) if isinstance(t, str) else t
    return F.coalesce(c, F.lit(""))


# Per-text features every profile is written in terms of; all derive from the collapsed text
# (collapsing whitespace never changes a text's last character, terminators or tokens).
FEATURES = {
    "ends": lambda x: T.ends_with_period(x),
    "tc": lambda x: T.terminator_chars(x),
    "tr": lambda x: T.terminator_runs(x),
    "wc": lambda x: T.ws_word_count(x, collapsed=True),
    "rwc": lambda x: T.regex_word_count(x),
    "rep": lambda x: T.has_repeated_ngram(x, 2, collapsed=True),
}


class Feats:
    """The raw text ``t``, its collapsed form ``x`` and features (columns or expressions)."""

    def __init__(self, t: Column, x: Column, cols: dict[str, str] | None = None):
        self.t, self.x, self.cols = t, x, cols or {}

    @classmethod
    def of(cls, t: ColumnOrName) -> "Feats":
        raw = _text(t)
        return cls(raw, T.collapse_ws(raw))

    def __getitem__(self, name: str) -> Column:
        return F.col(self.cols[name]) if name in self.cols else FEATURES[name](self.x)


def _length_rules(wc: Column, low: int, high: int) -> list[Rule]:
    return [Rule(K.MSG_TOO_SHORT, wc < low), Rule(K.MSG_TOO_LONG, wc > high)]


def _one_period(f: Feats) -> Column:
    return f["ends"] & (f["tc"] == 1)


def _single(f: Feats, original=None, low=K.WORD_LOW, high=K.WORD_HIGH):
    wc = f["rwc"]
    return apply_rules([
        Rule(K.MSG_SINGLE_PERIOD, ~f["ends"]),
        Rule(K.MSG_SINGLE_ONE, ~_one_period(f)),
        Rule(F.format_string(K.MSG_SINGLE_WORDS, wc), ~wc.between(low, high)),
    ])


def _split_rules(f: Feats, wc: Column, low: int, high: int) -> list[Rule]:
    # "no period" and ">1 sentence" both fire for a text without a final period.
    return [Rule(K.MSG_NO_PERIOD, ~f["ends"]), Rule(K.MSG_MULTI, ~_one_period(f)), *_length_rules(wc, low, high)]


def _regex_words(f: Feats, original=None, low=K.WORD_LOW, high=K.WORD_HIGH):
    return apply_rules(_split_rules(f, f["rwc"], low, high))


def _split_words(f: Feats, original=None, low=K.WORD_LOW, high=K.WORD_HIGH):
    return apply_rules(_split_rules(f, f["wc"], low, high))


def _sentence_rules(f: Feats) -> list[Rule]:
    # ">1 sentence" only when the text does end with a period.
    return [Rule(K.MSG_NO_PERIOD, ~f["ends"]), Rule(K.MSG_MULTI, f["ends"] & ~_one_period(f))]


def _rewrite(f: Feats, original=None, low=K.WORD_LOW, high=K.WORD_HIGH):
    return apply_rules([*_sentence_rules(f), *_length_rules(f["wc"], low, high)])


def _guarded(f: Feats, original, low=K.WORD_LOW, high=K.WORD_HIGH):
    same = T.unchanged(f.t, _text(original))
    return apply_rules([*_sentence_rules(f), *_length_rules(f["wc"], low, high), Rule(K.MSG_UNCHANGED, same)])


def _summary(f: Feats, original=None, low=K.WORD_LOW, high=K.WORD_HIGH):
    return apply_rules(_sentence_rules(f))


def _strategy_eval(f: Feats, original=None, low=K.WORD_LOW, high=K.WORD_HIGH):
    return (f["tr"] == 1) & f["ends"] & f["wc"].between(low, high), F.lit("")


def _annotate(f: Feats, original, low=K.WORD_LOW, high=K.WORD_HIGH):
    passed, notes = apply_rules(_split_rules(f, f["wc"], low, high))
    same = T.unchanged(f.x, _text(original))
    return passed, F.when((notes == "") & same, F.lit(K.MSG_UNCHANGED)).otherwise(notes)


def _failure_reason(f: Feats, original=None, low=K.WORD_LOW, high=K.WORD_HIGH):
    wc = f["wc"]
    return apply_rules(
        [
            Rule(K.REASON_MULTI, f["tr"] != 1),
            Rule(K.REASON_NO_PERIOD, ~f["ends"]),
            Rule(F.format_string(K.REASON_WORDS, wc), ~wc.between(low, high)),
            Rule(K.REASON_REPEAT, f["rep"], fails=False),
        ],
        sep=K.REASON_SEP,
        none=K.REASON_NONE,
    )


_IMPL = {
    "single": (_single, {"rwc", "tc", "ends"}),
    "regex_words": (_regex_words, {"rwc", "tc", "ends"}),
    "split_words": (_split_words, {"wc", "tc", "ends"}),
    "rewrite": (_rewrite, {"wc", "tc", "ends"}),
    "summary": (_summary, {"tc", "ends"}),
    "strategy_eval": (_strategy_eval, {"tr", "ends", "wc"}),
    "failure_reason": (_failure_reason, {"tr", "ends", "wc", "rep"}),
    "rewrite_guarded": (_guarded, {"wc", "tc", "ends"}),
    "annotate_unchanged": (_annotate, {"wc", "tc", "ends"}),
}


def validate_single(t: ColumnOrName):
    """Single rewrite check: three independent messages, regex word count."""
    return _single(Feats.of(t))


def validate_regex_words(t: ColumnOrName, low: int = K.WORD_LOW, high: int = K.WORD_HIGH):
    return _regex_words(Feats.of(t), None, low, high)


def validate_split_words(t: ColumnOrName, low: int = K.WORD_LOW, high: int = K.WORD_HIGH):
    return _split_words(Feats.of(t), None, low, high)


def validate_rewrite(t: ColumnOrName, low: int = K.WORD_LOW, high: int = K.WORD_HIGH):
    return _rewrite(Feats.of(t), None, low, high)


def validate_guarded(original: ColumnOrName, t: ColumnOrName, low: int = K.WORD_LOW, high: int = K.WORD_HIGH):
    """Rewrite rules plus ``unchanged``, which fails the row."""
    return _guarded(Feats.of(t), original, low, high)


def validate_summary(t: ColumnOrName):
    return _summary(Feats.of(t))


def passes_strategy_eval(t: ColumnOrName, low: int = K.WORD_LOW, high: int = K.WORD_HIGH) -> Column:
    """One terminator run, final period, word window by whitespace words."""
    return _strategy_eval(Feats.of(t), None, low, high)[0]


def validate_strategy_eval(t: ColumnOrName, low: int = K.WORD_LOW, high: int = K.WORD_HIGH):
    return _strategy_eval(Feats.of(t), None, low, high)


def annotate_unchanged(original: ColumnOrName, t: ColumnOrName, low: int = K.WORD_LOW, high: int = K.WORD_HIGH):
    """Split-words rules; ``unchanged`` is noted only when no other note applies, pass unaffected."""
    return _annotate(Feats.of(t), original, low, high)


def failure_reasons(t: ColumnOrName, low: int = K.WORD_LOW, high: int = K.WORD_HIGH):
    """Reasons joined by ", " or "passes"; repetition is listed but never part of ``passes``."""
    return _failure_reason(Feats.of(t), None, low, high)


def validate_df(df: DataFrame, profile: str, text_col: str = "text", original_col: str | None = None,
                passed: str = "passed", notes: str = "notes", words: str | None = None) -> DataFrame:
    """DataFrame form of ``check``: the collapsed text and the profile's features are computed
    once per row in their own projection, then the rules read them (no re-evaluation inside
    CASE branches). Adds ``passed``, ``notes`` and optionally the whitespace word count."""
    fn, needs = _IMPL[profile]
    if original_col is None and profile in PAIR_PROFILES:
        raise ValueError(f"profile {profile!r} needs the original text")
    needs = set(needs) | ({"wc"} if words else set())
    base = df.columns
    d1 = df.withColumn("_t", _text(text_col)).withColumn("_x", T.collapse_ws(F.col("_t")))
    d2 = d1.select("*", *[FEATURES[n](F.col("_x")).alias(f"_f_{n}") for n in sorted(needs)])
    f = Feats(F.col("_t"), F.col("_x"), {n: f"_f_{n}" for n in needs})
    p, n = fn(f, F.col(original_col) if original_col else None)
    extra = [F.col("_f_wc").alias(words)] if words else []
    return d2.select(*base, p.alias(passed), n.alias(notes), *extra)


PROFILES = {
    "single": validate_single,
    "regex_words": validate_regex_words,
    "split_words": validate_split_words,
    "rewrite": validate_rewrite,
    "summary": validate_summary,
    "strategy_eval": validate_strategy_eval,
    "failure_reason": failure_reasons,
}
PAIR_PROFILES = {
    "rewrite_guarded": validate_guarded,
    "annotate_unchanged": annotate_unchanged,
}


def check(t: ColumnOrName, profile: str, original: ColumnOrName | None = None) -> tuple[Column, Column]:
    """``(passed, notes)`` of ``t`` under a named rule profile."""
    if profile in PAIR_PROFILES:
        if original is None:
            raise ValueError(f"profile {profile!r} needs the original text")
        return PAIR_PROFILES[profile](original, t)
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; known: {sorted(PROFILES) + sorted(PAIR_PROFILES)}")
    return PROFILES[profile](t)
