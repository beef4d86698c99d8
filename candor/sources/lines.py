"""Line sources: text files and string columns, one record per stripped non-empty line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import text as T
from candor.plans.ordinals import file_line_ordinals


def table_lines(df: DataFrame, keys: list[str], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Split a text column into lines (``\\r\\n``, ``\\r``, ``\\n``), strip, drop empties.

    Output: ``keys + keep + [line_no, text]`` with ``line_no`` the 1-based ordinal of the kept line
    inside the row (as in ``read_lines``), so ``keys + [line_no]`` is a stable key that needs no global ordering.
    Narrow (no shuffle): a Generate on each row.
    """
    keep = keep or []
    kept = F.filter(F.transform(F.split(F.col(text_col), K.LINE_BREAK), T.strip_ws), lambda x: x != "")
    exploded = df.select(*keys, *keep, F.posexplode(kept).alias("pos", "text"))
    return exploded.select(*keys, *keep, (F.col("pos") + 1).alias("line_no"), "text")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text files -> ``(file, line_id, text)``: stripped, non-empty, 1-based ordinal per file.

    Ordinals come from scan order inside each file block plus per-block offsets (see
    ``plans.ordinals``); no single-partition window is used.
    """
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        T.strip_ws("value").alias("text"),
    ).where(F.col("text") != "")
    return file_line_ordinals(raw)


def documents_lines(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Lines of the ``documents`` table keyed by ``(doc_id, line_no)``."""
    return table_lines(docs, ["doc_id"], "text", keep=keep)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, as scanned.

    A file of one row group is one split, whatever the scan settings. Where ``candor.local.slots`` is set (``local_session``
    does, a cluster does not), rows are dealt to that many tasks.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    slots = spark.conf.get("candor.local.slots", None)
    return df.repartition(int(slots)) if slots else df
