"""Rewrite audits and a lexical rewriter.

* ``simplify_words``: replace whole words found in a user dictionary ``(word, simpler)``,
  keeping trailing punctuation and an initial capital.
* ``length_bounds``, ``cut_words``: word-count bounds of an output (``min_length``/``max_length`` in words), audited or applied.
* ``copied_ngrams``: n-grams of an output that also occur in its source (row-local), and
  ``corpus_overlap``: per document, distinct n-grams shared with a reference corpus (semi join
  on the n-gram, then de-duplication of the few that are shared).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions import text as T

# About 50 MB of short texts as a hashed relation.
MAX_REFERENCE_GRAMS = 500_000
_CORE = r"^(.*?)([.,;:!?]*)$"


def _cap_like(rep: Column, core: Column) -> Column:
    first = F.substring(core, 1, 1)
    capital = (first != F.lower(first))
    return F.when(capital, F.concat(F.upper(F.substring(rep, 1, 1)), F.substring(rep, 2, 1 << 30))).otherwise(rep)


def simplify_words(df: DataFrame, keys: list[str], dictionary: DataFrame | list[tuple[str, str]],
                   text_col: str = "text", out_col: str = "simplified") -> DataFrame:
    """Word substitution over the collapsed text; adds ``out_col`` and ``n_replaced`` (long).

    ``dictionary`` holds ``(word, simpler)``, of any size. Words compare in lower case; of several entries for a word the
    smallest ``simpler`` counts; entries with a NULL are ignored. Only words found in the dictionary are gathered per
    text (by position); the text itself is rebuilt inside its row.
    """
    if not isinstance(dictionary, DataFrame):
        dictionary = df.sparkSession.createDataFrame(list(dictionary), "word STRING, simpler STRING")
    word, simpler = (F.col(c) for c in dictionary.columns[:2])
    entries = dictionary.select(F.lower(word).alias("_k"), simpler.alias("_rep")).dropna().groupBy("_k").agg(F.min("_rep").alias("_rep"))
    toks = df.select(*keys, F.posexplode(T.ws_tokens(text_col)).alias("_pos", "_tok")).select(
        *keys, "_pos", F.lower(F.regexp_extract("_tok", _CORE, 1)).alias("_k"))
    hits = toks.join(entries, "_k").groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_pos", "_rep"))).alias("_hits"))

    def one(tok: Column, pos: Column) -> Column:
        core = F.regexp_extract(tok, _CORE, 1)
        rep = F.try_element_at(F.col("_hits"), pos)
        return F.when(rep.isNull(), tok).otherwise(F.concat(_cap_like(rep, core), F.regexp_extract(tok, _CORE, 2)))

    joined = df.join(hits, keys, "left")
    done = F.when(F.col("_hits").isNull(), T.collapse_ws(text_col)).otherwise(F.array_join(F.transform(T.ws_tokens(text_col), one), " "))
    n = F.when(F.col("_hits").isNull(), 0).otherwise(F.size("_hits"))
    return joined.withColumn(out_col, done).withColumn("n_replaced", n.cast("long")).drop("_hits")


def length_bounds(t: Column | str, min_words: int | None = None, max_words: int | None = None) -> Column:
    """``struct(words, too_short, too_long)`` against optional word bounds."""
    wc = T.ws_word_count(t)
    short = wc < min_words if min_words is not None else F.lit(False)
    long_ = wc > max_words if max_words is not None else F.lit(False)
    return F.struct(wc.alias("words"), short.alias("too_short"), long_.alias("too_long"))


def cut_words(t: Column | str, max_words: int | None) -> Column:
    """The text, cut to its first ``max_words`` words (joined by single spaces) where it has more."""
    x = F.col(t) if isinstance(t, str) else t
    if max_words is None:
        return x
    return F.when(T.ws_word_count(x) > max_words, F.array_join(F.slice(T.ws_tokens(x), 1, max_words), " ")).otherwise(x)


def corpus_overlap(docs: DataFrame, reference: DataFrame, n: int = 4, doc_key: str = "doc_id",
                   text_col: str = "text", ref_text_col: str = "text") -> DataFrame:
    """Per document: distinct n-grams that also occur anywhere in ``reference`` (docs with >= 1).

    A document's n-grams are made distinct inside its row and meet the reference before anything is shuffled by
    document, so only shared ones travel. The reference is broadcast while it has at most ``MAX_REFERENCE_GRAMS`` n-grams.
    """
    ref = reference.select(F.explode(T.ngrams(ref_text_col, n)).alias("gram")).distinct()
    grams = docs.select(doc_key, F.explode(F.array_distinct(T.ngrams(text_col, n))).alias("gram"))
    few = ref.count() <= MAX_REFERENCE_GRAMS
    shared = grams.join(F.broadcast(ref) if few else ref, "gram", "left_semi").distinct()
    return shared.groupBy(doc_key).agg(F.count(F.lit(1)).alias("shared_ngrams"))
