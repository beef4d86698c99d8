"""Batches of texts of similar length under a token budget.

Lengths are cut at ``max_length``, so their histogram has at most ``max_length + 1`` rows. It merges over tasks and decides the buckets: equal shares of the rows,
a length never split over two buckets. Inside a bucket rows stand in a seeded order that depends on their keys only; a batch takes as many rows as fit
``token_budget`` at the bucket's largest length. Rows are numbered by range partitioning on narrow keys; no bucket passes through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candor import constants as K
from candor.plans.ordinals import global_row_number
from candor.session import ensure_checkpoint_dir

BUCKETS = 8
TOKEN_BUDGET = 1024


def bucket_table(lengths: DataFrame, length_col: str, max_length: int, buckets: int = BUCKETS) -> DataFrame:
    """``length, bucket, width``: at most ``max_length + 1`` rows."""
    known = lengths.where(F.col(length_col).isNotNull()).select(F.least(F.greatest(F.col(length_col), F.lit(0)), F.lit(max_length)).alias("length"))
    histogram = known.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # bounded by max_length rows
    total = F.sum("n").over(Window.partitionBy())
    cut = histogram.select("length", F.floor(before * buckets / total).cast("int").alias("bucket"))
    return cut.withColumn("width", F.max("length").over(Window.partitionBy("bucket")))


def assign(df: DataFrame, keys: list[str], length_col: str, max_length: int, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET,
           seed: int = K.DEFAULT_SEED) -> DataFrame:
    """``keys, length, bucket, bucket_width, batch_no, pos_in_batch`` of every row with a length; ``keys`` must be unique.

    ``length`` is cut at ``max_length``; batches are numbered from 0 inside a bucket, places from 1. A batch holds at most ``token_budget`` padded tokens, or one
    row where that is longer. Rows of a NULL length are left out; empty texts share the bucket of the shortest.
    """
    ensure_checkpoint_dir(df.sparkSession)
    own = df.where(F.col(length_col).isNotNull()).select(*keys, F.least(F.greatest(F.col(length_col), F.lit(0)), F.lit(max_length)).cast("int").alias("length"))
    own = own.checkpoint(eager=True)  # keys and a number: texts are counted once, not for each of the passes below
    table = bucket_table(own, "length", max_length, buckets).checkpoint(eager=True)
    placed = own.join(F.broadcast(table), "length").withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])))
    order = [F.col("bucket").asc(), F.col("_h").asc(), *[F.col(k).asc() for k in keys]]
    numbered = global_row_number(placed, order, "_rn")
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    first = sizes.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))  # a row a bucket
    rows = F.greatest(F.floor(F.lit(token_budget) / F.greatest(F.col("width"), F.lit(1))), F.lit(1))
    at = F.col("_rn") - F.col("_first") - 1
    out = numbered.join(F.broadcast(first), "bucket")
    return out.select(*keys, "length", "bucket", F.col("width").alias("bucket_width"), F.floor(at / rows).alias("batch_no"), (at % rows + 1).cast("int").alias("pos_in_batch"))


def shapes(assigned: DataFrame) -> DataFrame:
    """Per batch: ``bucket, batch_no, rows, width, tokens, padding_share``."""
    per = assigned.groupBy("bucket", "batch_no").agg(F.count(F.lit(1)).alias("rows"), F.max("length").alias("width"), F.sum(F.col("length").cast("long")).alias("tokens"))
    room = F.col("rows") * F.col("width")
    return per.withColumn("padding_share", F.when(room > 0, 1.0 - F.col("tokens") / room).otherwise(0.0))
