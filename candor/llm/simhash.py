"""SimHash fingerprints with DataFrame functions only.

Terms are the distinct pairs of neighbouring words (lower case, split at white space; the last word stands
alone); a pair that a text repeats counts once, so a repeated line cannot outvote the rest. A term's weight is its length in characters less three, from 1 to ``MAX_WEIGHT``, so that pairs of
short, common words count little. Each bit of the 128-bit term hash votes with the weight; a fingerprint bit is
set where the votes for it are more than half. Votes are summed two to a long: 64 sums, each holding
two counters of 32 bits. A fingerprint is two longs, ``fp0`` and ``fp1``.

``near_counts`` finds all fingerprints within a Hamming radius: the bits are cut into blocks, each with a
tolerance, and the tolerances plus one add up to ``RADIUS + 1``. Two fingerprints that differ in at most ``RADIUS`` bits differ
in at least one block by no more than its tolerance. There is a table for each block; a query looks up its own block and
all that differ from it by the tolerance. ``RADIUS`` follows measured distances of near copies (README).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.llm.common import cut
from candor.plans.ordinals import global_row_number

WORD, HALF = 64, 32
WORDS = 2
BITS = WORD * WORDS
FP = [f"fp{i}" for i in range(WORDS)]
BLOCKS, RADIUS = 10, 19
MAX_WEIGHT = 16


def terms(text: Column) -> Column:
    """Distinct word pairs ``"a b"``; white space at either end makes an empty word, and a blank text the empty term."""
    words = F.split(F.lower(text), r"\s+")
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, fp0, fp1`` per distinct key; rows of one key vote together. Blank texts: 0."""
    exploded = texts.select(*keys, F.explode(terms(F.col(text))).alias("term"))
    hashes = [F.xxhash64("term"), F.xxhash64("term", F.lit(1))]
    size = F.length(F.trim("term"))
    weight = F.when(size == 0, 0).otherwise(F.least(F.greatest(size - 3, F.lit(1)), F.lit(MAX_WEIGHT)))
    weighed = exploded.select(*keys, *[h.alias(f"term{i}") for i, h in enumerate(hashes)], weight.cast("long").alias("w"))
    pair = F.lit((1 << HALF) + 1)
    votes = [F.sum(F.shiftrightunsigned(f"term{i}", j).bitwiseAND(pair) * F.col("w")).alias(f"s{i}_{j}") for i in range(WORDS) for j in range(HALF)]
    summed = weighed.groupBy(*keys).agg(F.sum("w").alias("w"), *votes)

    def bits(i: int, j: int) -> Column:
        low = F.col(f"s{i}_{j}").bitwiseAND(F.lit((1 << HALF) - 1))
        high = F.shiftrightunsigned(f"s{i}_{j}", HALF)
        none = F.lit(0).cast("long")
        return F.when(2 * low > F.col("w"), F.lit(1 << j)).otherwise(none).bitwiseOR(
            F.when(2 * high > F.col("w"), F.lit(_signed(1 << (j + HALF)))).otherwise(none))

    return summed.select(*keys, *[reduce(lambda p, q: p.bitwiseOR(q), [bits(i, j) for j in range(HALF)]).alias(FP[i]) for i in range(WORDS)])


def distance(a: list[Column], b: list[Column]) -> Column:
    """Number of differing bits."""
    return reduce(lambda p, q: p + q, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)])


def likeness(a: list[str], b: list[str]) -> Column:
    """Share of equal bits."""
    return 1 - distance([F.col(x) for x in a], [F.col(x) for x in b]) / F.lit(float(BITS))


def as_hex(fp: list[str]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(x), WORD // 4, "0") for x in fp]))


def _signed(x: int) -> int:
    return x - (1 << WORD) if x >> (WORD - 1) else x


# ---------------------------------------------------------------------------------------------
# All fingerprints within a Hamming radius
# ---------------------------------------------------------------------------------------------

def block_tables(blocks: int, radius: int) -> list[tuple[int, int, int]]:
    """``(first bit, end bit, tolerance)`` of each block that is looked up."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    each, more = divmod(radius + 1, blocks)
    cuts = [(a, b, each - 1 + (i < more)) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return [c for c in cuts if c[2] >= 0]


def _block(fp: list[Column], a: int, b: int) -> Column:
    """Bits ``a`` to ``b`` (at most ``WORD`` of them) as a long."""
    i, at = divmod(a, WORD)
    value = F.shiftrightunsigned(fp[i], at)
    if b > WORD * (i + 1):
        value = value.bitwiseOR(F.shiftleft(fp[i + 1], WORD - at))
    return value.bitwiseAND(F.lit(_signed((1 << (b - a)) - 1)))


def near_counts(fps: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``fp0, fp1, n_near`` per distinct fingerprint of ``queries(fp0, fp1)``: how many rows of ``fps(fp0, fp1)`` are within ``radius`` bits.

    Exact. Equal fingerprints are counted once and weighed by their number, and a pair is made in the first table
    in which it agrees, so no row is made twice. Without rows the result is empty.
    """
    tables = block_tables(blocks, radius)
    names = ["t", "block"]
    own = [F.col(f) for f in FP]
    keyed = F.inline(F.array(*[F.struct(F.lit(t), _block(own, a, b)) for t, (a, b, _) in enumerate(tables)])).alias(*names)
    others = [f"o{i}" for i in range(WORDS)]
    index = fps.groupBy(*FP).agg(F.count(F.lit(1)).alias("n")).select(*[F.col(f).alias(o) for f, o in zip(FP, others)], "n", keyed)
    flips = [[_signed(sum(1 << i for i in c)) for k in range(tolerance + 1) for c in combinations(range(b - a), k)] for a, b, tolerance in tables]
    around = F.array(*[F.array(*[F.lit(x).cast("long") for x in f]) for f in flips])
    asked = queries.select(*FP).distinct().select(*FP, keyed)
    asked = asked.select(*FP, "t", "block", F.explode(F.element_at(around, F.col("t") + 1)).alias("flip")).select(
        *FP, "t", F.col("block").bitwiseXOR(F.col("flip")).alias("block"))
    xor = [F.col(f).bitwiseXOR(F.col(o)) for f, o in zip(FP, others)]
    agrees = [F.bit_count(_block(xor, a, b)) <= tolerance for a, b, tolerance in tables]
    first = F.coalesce(*[F.when(x, F.lit(t)) for t, x in enumerate(agrees)])
    bits = reduce(lambda p, q: p + q, [F.bit_count(x) for x in xor])
    # The planner takes the look-ups for as few as the queries and would broadcast them.
    found = asked.hint("merge").join(index, names).where((bits <= radius) & (first == F.col("t")))
    return found.groupBy(*FP).agg(F.sum("n").alias("n_near"))


# ---------------------------------------------------------------------------------------------
# Documents, each with the edited text made from its successor
# ---------------------------------------------------------------------------------------------

def edited_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct (doc_id, text) rows ``h1, h2, doc_id, copies, n_chars, text, edited, next_h1, next_h2``.

    The successor is the next by descending ``doc_id`` (NULL last, equal ids by content hash), after the last the first.
    """
    own, whole = F.col(doc_id).cast("long"), F.coalesce(F.col(text), F.lit(""))
    src = docs.select(F.xxhash64(own, whole).alias("h1"), F.xxhash64(whole, F.lit("row"), own).alias("h2"),
                      own.alias("doc_id"), whole.alias("text"))
    rows = src.groupBy("h1", "h2", "doc_id", F.length("text").cast("long").alias("n_chars")).agg(F.count(F.lit(1)).alias("copies"))
    ranked = global_row_number(rows, [F.col("doc_id").desc_nulls_last(), F.col("h1").asc(), F.col("h2").asc()], "rn")
    last = ranked.count()
    after = ranked.select(F.when(F.col("rn") == 1, F.lit(last)).otherwise(F.col("rn") - 1).alias("rn"), F.col("h1").alias("next_h1"), F.col("h2").alias("next_h2"))
    link = ranked.join(after, "rn").drop("rn")
    taken = F.expr("n_chars div 3")
    wanted = link.select(F.col("next_h1").alias("h1"), F.col("next_h2").alias("h2"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), taken.cast("int").alias("need"))
    # Repeated rows vote once: their votes could outgrow a counter.
    texts = src.select("h1", "h2", "text").dropDuplicates(["h1", "h2"])
    heads = texts.join(wanted, ["h1", "h2"]).select(F.col("p1").alias("h1"), F.col("p2").alias("h2"), F.left("text", F.col("need")).alias("head"))
    kept = F.left("text", (F.col("n_chars") - taken).cast("int"))
    return (texts.join(link, ["h1", "h2"]).join(heads, ["h1", "h2"])
            .select("h1", "h2", "doc_id", "copies", "n_chars", "text", F.concat(kept, "head").alias("edited"), "next_h1", "next_h2"))


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near`` per row.

    ``n_near`` is, for ids divisible by 50 (NULL for others), the number of other distinct rows
    whose fingerprint is within ``RADIUS`` bits. NULL and empty texts are empty: fingerprint 0. Repeated
    rows (same id and text) are one document and are each returned; equal ids with different texts follow one another.
    A single document is its own successor. An empty table gives no rows; other columns are ignored.
    """
    pairs = edited_pairs(docs, doc_id, text)
    keys = ["h1", "h2", "doc_id", "copies", "n_chars", "next_h1", "next_h2", "edited_sha256", "variant"]
    both = pairs.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        *keys[:-1], F.inline(F.array(F.struct(F.lit(0).alias("variant"), F.col("text").alias("text")),
                                     F.struct(F.lit(1).alias("variant"), F.col("edited").alias("text")))).alias("variant", "text"))
    marked = fingerprints(both, keys)
    edited_fp = [f"e_{f}" for f in FP]
    wide = marked.groupBy(*keys[:-1]).agg(*[F.max(F.when(F.col("variant") == v, F.col(f))).alias(name)
                                            for v, names in enumerate((FP, edited_fp)) for f, name in zip(FP, names)])
    done = cut(wide)
    next_fp = [f"n_{f}" for f in FP]
    after = done.select(F.col("h1").alias("next_h1"), F.col("h2").alias("next_h2"), *[F.col(f).alias(n) for f, n in zip(FP, next_fp)])
    asked = F.col("doc_id") % 50 == 0
    near = near_counts(done.select(*FP), done.where(asked).select(*FP))
    out = done.join(after, ["next_h1", "next_h2"]).join(near, FP, "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(FP).alias("fingerprint"), as_hex(edited_fp).alias("edited_fingerprint"),
        likeness(FP, edited_fp).alias("near_edited"), likeness(FP, next_fp).alias("near_next"),
        F.when(asked, F.col("n_near") - 1).alias("n_near"), F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
