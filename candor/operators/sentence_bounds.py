"""Sentence bounds learned from the texts themselves (after Kiss and Strunk, "Unsupervised multilingual sentence boundary detection", 2006).

Tokens are runs without white space; a token's type is its lower-case core without quotes, brackets and a final period. Three tables are learned:

* abbreviations: types whose final period is too regular for a chance one (log-likelihood ratio against the share of periods in the texts, weighed by
  few letters, inner periods, and rare use without the period);
* starters: words that stand after sentence ends far more often than elsewhere (log-likelihood ratio of the 2 x 2 table);
* collocations of an initial or number with the word after it, by the same ratio: no sentence ends inside.

A token ends a sentence if it ends with ``!``, ``?`` or several periods, or with one period unless its type is an abbreviation not followed by a capitalised
starter, or the pair is a collocation. The first and last forms of ``functions.text`` stay as they are; this is a further way to count.

Texts are read twice: once to count distinct tokens and what follows a terminator, once to judge. Counts are summed inside tasks, rules applied to distinct
tokens; only tokens with a terminator are looked up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions import text as T
from candor.plans.joins import MAX_BROADCAST_TOKENS, join_bounded
from candor.session import ensure_checkpoint_dir, kept

ABBREVIATION, STARTER, COLLOCATION = 0.3, 30.0, 7.88
OPENING, CLOSING = r"^[\"'(\[{“‘„«]+", r"[\"')\]}”’»,;:]+$"
SHORT = r"^([\p{L}]|[0-9]+)$"


def core(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(token), OPENING, ""), CLOSING, "")


def dotted(c: Column) -> Column:
    """Whether a core ends with one period after something else."""
    return c.rlike(r"[^.]\.$")


def type_of(c: Column) -> Column:
    return F.when(dotted(c), F.substring(c, F.lit(1), F.char_length(c) - 1)).otherwise(c)


def finished(c: Column) -> Column:
    """Whether a core ends with a mark that is no single period."""
    return c.rlike(r"([!?]|\.\.)$")


def ratio(both: Column, first: Column, second: Column, total: float) -> Column:
    """Log-likelihood ratio of the 2 x 2 table of two events with these counts."""
    cells = [(both, first * second), (first - both, first * (F.lit(total) - second)), (second - both, (F.lit(total) - first) * second),
             (F.lit(total) - first - second + both, (F.lit(total) - first) * (F.lit(total) - second))]
    out = F.lit(0.0)
    for seen, product in cells:
        out = out + F.when(seen > 0, seen * F.log(seen * F.lit(total) / product)).otherwise(0.0)
    return 2.0 * out


MARK = r"[.!?]"  # a token without one neither has a final period nor ends a sentence


def _followed(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys, x, after``: tokens with a mark that stand before another token, and that token."""
    words = texts.select(*keys, T.ws_tokens(text_col).alias("_t"))
    pairs = F.arrays_zip(F.col("_t").alias("x"), F.slice("_t", 2, F.greatest(F.size("_t") - 1, F.lit(0))).alias("after"))
    each = words.where(F.size("_t") > 1).select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.*")
    return each.where(F.col("x").rlike(MARK) & F.col("after").isNotNull())


def _counted(texts: DataFrame, text_col: str) -> DataFrame:
    """``before, follows, y, n``: how often the token ``y`` stands after ``before``, which is NULL unless it has a mark, or (not ``follows``) first in a text."""
    words = texts.select(T.ws_tokens(text_col).alias("_t")).where(F.size("_t") > 0)
    none = F.array(F.lit(None).cast("string"))
    pairs = F.arrays_zip(F.concat(none, F.slice("_t", 1, F.size("_t") - 1)).alias("x"), F.col("_t").alias("y"))
    each = words.select(F.explode(pairs).alias("_p")).select("_p.*")
    return each.groupBy(F.when(F.col("x").rlike(MARK), F.col("x")).alias("before"), F.col("x").isNotNull().alias("follows"), "y").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Bounds:
    """``abbreviations(t)``, ``starters(w)``, ``collocations(t, w)``, all materialised."""

    abbreviations: DataFrame
    starters: DataFrame
    collocations: DataFrame


def learn(texts: DataFrame, text_col: str = "text") -> Bounds:
    """The three tables of all texts; NULL and blank texts have no tokens, and no text at all gives empty tables."""
    ensure_checkpoint_dir(texts.sparkSession)
    counts = kept(_counted(texts, text_col))  # rules of a token are applied to distinct ones, with their numbers
    seen = counts.groupBy("y").agg(F.sum("n").alias("n")).select(core(F.col("y")).alias("c"), "n").withColumns({"t": type_of(F.col("c")), "dot": dotted(F.col("c"))})
    zero = F.lit(0).cast("long")
    types = seen.groupBy("t").agg(F.sum(F.when(F.col("dot"), F.col("n")).otherwise(zero)).alias("c1"), F.sum(F.when(F.col("dot"), zero).otherwise(F.col("n"))).alias("c0")).checkpoint(eager=True)
    n, periods = types.agg(F.coalesce(F.sum(F.col("c1") + F.col("c0")), F.lit(0)), F.coalesce(F.sum("c1"), F.lit(0))).first()
    n, share = float(n), min(max(periods / n if n else 0.5, 1e-9), 1 - 1e-9)
    letters = F.char_length(F.replace("t", F.lit("."), F.lit("")))
    dots = F.char_length("t") - letters + 1
    log_ratio = -2 * (F.col("c1") * F.log(F.lit(share)) + F.col("c0") * F.log(F.lit(1 - share)) - F.col("c1") * F.log(F.lit(0.99)) - F.col("c0") * F.log(F.lit(0.01)))
    score = log_ratio * F.exp(-letters) * dots * F.pow(letters.cast("double"), -F.col("c0").cast("double"))
    abbreviations = types.where((F.col("c1") > 0) & (letters > 0) & F.col("t").rlike(r"\p{L}") & ~F.col("t").rlike(r"[!?]") & (score >= ABBREVIATION)).select("t").checkpoint(eager=True)

    after = counts.where("follows").select("before", core(F.col("y")).alias("yc"), "n").select("before", type_of(F.col("yc")).alias("w"), "n")
    cores = after.withColumn("c", core(F.col("before"))).withColumns({"t": type_of(F.col("c")), "dot": F.coalesce(dotted(F.col("c")), F.lit(False)), "fin": F.coalesce(finished(F.col("c")), F.lit(False))})
    known = join_bounded(cores, abbreviations.withColumn("abbr", F.lit(True)), "t", "left", MAX_BROADCAST_TOKENS)
    single = F.col("dot") & F.col("abbr").isNull()
    marked = known.select("t", "w", "n", (F.col("fin") | single).alias("ends"), (single & F.col("t").rlike(SHORT)).alias("short"))
    words = marked.groupBy("w").agg(F.sum(F.when(F.col("ends"), F.col("n")).otherwise(zero)).alias("k"), F.sum("n").alias("n")).select("w", "n", "k").checkpoint(eager=True)
    total, breaks = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    total, breaks = float(total), float(breaks)
    often = F.col("k") * F.lit(total) > F.col("n") * F.lit(breaks)
    starters = words.where(often & F.col("w").rlike(r"\p{L}") & (ratio(F.col("k"), F.col("n"), F.lit(breaks), total) >= STARTER)).select("w").checkpoint(eager=True)

    pairs = marked.where("short").groupBy("t", "w").agg(F.sum("n").alias("both")).where("both > 1")
    own = types.select("t", F.col("c1").alias("first"))
    counted = pairs.join(own, "t").join(words.select("w", F.col("n").alias("second")), "w")
    strong = F.col("both") * F.lit(total) > F.col("first") * F.col("second")
    collocations = counted.where(strong & (ratio(F.col("both"), F.col("first"), F.col("second"), total) >= COLLOCATION)).select("t", "w").checkpoint(eager=True)
    return Bounds(abbreviations, starters, collocations)


def count_sentences(texts: DataFrame, keys: list[str], bounds: Bounds, text_col: str = "text") -> DataFrame:
    """``keys, n_sentences, n_inner_periods`` of each text: its sentences (a last one without a mark counts), and the single periods that end none.

    ``keys`` must be unique. NULL and blank texts have 0 of both.
    """
    ended = _followed(texts, keys, text_col).withColumn("c", core(F.col("x"))).where(dotted(F.col("c")) | finished(F.col("c")))
    ended = ended.withColumn("yc", core(F.col("after")))
    first = F.regexp_replace("after", OPENING, "")
    marked = ended.select(*keys, type_of(F.col("c")).alias("t"), type_of(F.col("yc")).alias("w"), dotted(F.col("c")).alias("dot"), first.rlike(r"^\p{Lu}").alias("capital"))
    for table, on, name in ((bounds.abbreviations, "t", "abbr"), (bounds.starters, "w", "start"), (bounds.collocations, ["t", "w"], "tied")):
        marked = join_bounded(marked, table.withColumn(name, F.lit(True)), on, "left", MAX_BROADCAST_TOKENS)
    inner = F.col("dot") & F.when(F.col("abbr").isNotNull(), ~(F.col("start").isNotNull() & F.col("capital"))).otherwise(F.col("tied").isNotNull())
    sums = marked.groupBy(*keys).agg(F.count_if(~inner).alias("_ends"), F.count_if(inner).alias("_inner"))
    own = texts.select(*keys, (F.size(T.ws_tokens(text_col)) > 0).alias("_some"))
    zero = F.lit(0).cast("long")
    return own.join(sums, keys, "left").select(*keys, F.when(F.col("_some"), F.coalesce("_ends", zero) + 1).otherwise(zero).alias("n_sentences"), F.coalesce("_inner", zero).alias("n_inner_periods"))
