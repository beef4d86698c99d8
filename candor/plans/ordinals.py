"""Global ordinals without a single-partition window.

* ``file_line_ordinals``: 1-based line numbers per file in file order, from scan order inside each
  file block plus a per-block offset table (one row per block).
* ``global_row_number``: dense 1-based ``row_number() over (order by ...)`` computed as range
  partitioning + per-partition position + a per-partition offset table (one row per partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.plans.joins import join_bounded
from candor.session import ensure_checkpoint_dir

# Upper bound of rows for which the per-block offset table is broadcast (≈ 25 TB of text at
# 128 MB blocks); beyond it the join shuffles.
MAX_BROADCAST_BLOCKS = 200_000
_LOCAL_BITS = 33  # monotonically_increasing_id = partition_id << 33 | position


def file_line_ordinals(raw: DataFrame) -> DataFrame:
    """``raw(file, block_start, text)`` straight from a file scan -> ``(file, line_id, text)``.

    Rows of one block are contiguous and in file order inside a scan partition, so their
    ``monotonically_increasing_id`` values are consecutive; the block offset is the number of
    kept rows in earlier blocks of the same file.
    """
    tagged = raw.withColumn("_mid", F.monotonically_increasing_id())
    # One row per block, materialised once: its size is checked and it is joined without another pass over the text.
    ensure_checkpoint_dir(raw.sparkSession)
    blocks = tagged.groupBy("file", "block_start").agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")
    ).checkpoint(eager=True)
    w = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "file", "block_start", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset")
    )
    # The ids of a rescan are the same: they number rows inside the same splits.
    joined = join_bounded(tagged, offsets, ["file", "block_start"], max_rows=MAX_BROADCAST_BLOCKS)
    return joined.select(
        "file",
        (F.col("_offset") + (F.col("_mid") - F.col("_first")) + 1).alias("line_id"),
        "text",
    )


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn", partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row under ``order`` (which must be a total order).

    Range partitioning spreads the rows over ``partitions`` tasks; the numbered table is
    checkpointed (reliable, in the session's checkpoint folder) so that the per-partition counts
    and the final join see the same partitioning even after executor loss or recomputation.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a bounded table, numbered on one task on purpose.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_offset") + F.col("_pos") + 1).drop("_mid", "_pid", "_pos", "_offset")
