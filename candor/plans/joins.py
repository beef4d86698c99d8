"""Joins with a checked broadcast side.

Broadcast only sides whose size is bounded: either a fixed parameter table (hint directly) or a
data-derived table whose row count is checked here first. Without a bound the join is left to
the planner, where AQE turns a sort-merge join into a broadcast join only when the runtime
shuffle size of a side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.session import ensure_checkpoint_dir


def join_bounded(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int | None = None) -> DataFrame:
    """Join ``big`` with ``small``; broadcast ``small`` only if it has at most ``max_rows`` rows.

    The count is one extra (cheap, aggregated) job on the small side; above the bound the join
    shuffles both sides on the keys.
    """
    if max_rows is not None and small.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


# Rows of a token and one or two numbers: about 50 MB as a hashed relation.
MAX_BROADCAST_TOKENS = 500_000


def _frequent_from(table: DataFrame, count: str, limit: int) -> int:
    """The least power of two from which on tokens of so many occurrences are at most ``limit``; 1 if all are."""
    power = F.floor(F.log2(count))
    sizes = {r["p"]: r["n"] for r in table.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # 64 rows at most
    least, rows = 63, 0
    while least > 0 and rows + sizes.get(least - 1, 0) <= limit:
        least -= 1
        rows += sizes.get(least, 0)
    return 1 << min(least, 62)


def join_tokens(occurrences: DataFrame, table: DataFrame, on: str, count: str, max_rows: int | None = None) -> DataFrame:
    """Inner join of token occurrences with a materialised table of one row a token.

    A table of at most ``max_rows`` rows is broadcast. Beyond that the most frequent tokens are (those with ``count`` from a power of two on, as many
    powers as fit), so that a token with a third of all occurrences never makes a partition; only occurrences of the others are shuffled.
    """
    limit = MAX_BROADCAST_TOKENS if max_rows is None else max_rows
    bound = _frequent_from(table, count, limit)
    if bound == 1:
        return occurrences.join(F.broadcast(table), on)
    frequent = F.broadcast(table.where(F.col(count) >= bound))
    rest = occurrences.join(frequent.select(on), on, "left_anti").join(table.where(F.col(count) < bound), on)
    return occurrences.join(frequent, on).unionByName(rest)


def token_sums(occurrences: DataFrame, table: DataFrame, keys: list[str], on: str, value: str, count: str, max_rows: int | None = None) -> DataFrame:
    """``keys, total, n``: the sum and number of the table's ``value`` (never NULL) over the occurrences of each key that the table knows.

    ``table`` is materialised, one row a token. As in ``join_tokens``, the most frequent tokens are broadcast; here the occurrences are made
    once, whatever the vocabulary: those that meet their value are summed inside the task, so that only rare ones are shuffled by token.
    """
    limit = MAX_BROADCAST_TOKENS if max_rows is None else max_rows
    bound = _frequent_from(table, count, limit)
    total, n = F.sum(value).alias("total"), F.count(value).alias("n")
    if bound == 1:
        return occurrences.join(F.broadcast(table.select(on, value)), on).groupBy(*keys).agg(total, n)
    frequent = F.broadcast(table.where(F.col(count) >= bound).select(on, value))
    met = occurrences.select(*keys, on).join(frequent, on, "left").withColumn("_rare", F.when(F.col(value).isNull(), F.col(on)))
    ensure_checkpoint_dir(occurrences.sparkSession)
    part = met.groupBy(*keys, "_rare").agg(total, n, F.count(F.lit(1)).alias("_times")).checkpoint(eager=True)
    known = part.where("_rare is null").select(*keys, "total", "n")
    rest = table.where(F.col(count) < bound).select(F.col(on).alias("_rare"), F.col(value).alias("_v"))
    late = part.where("_rare is not null").join(rest, "_rare").select(*keys, (F.col("_times") * F.col("_v")).alias("total"), F.col("_times").alias("n"))
    return known.unionByName(late).groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
