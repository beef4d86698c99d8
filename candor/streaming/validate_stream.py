"""Structured Streaming: the row-local rules applied to lines arriving as text files.

Every rule profile is a stateless projection, so the same Column expressions run on a stream. A file arrives as one
row and is split into lines, so lines are keyed by ``(file, line_no)`` with ``line_no`` among the file's kept lines. The only
state is that of ``running_pass_rates``: one row per group. A stream's checkpoint stands in its sink folder unless
a location is given, so a restarted stream goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candor.functions import rules as R
from candor.functions import text as T
from candor.sources.lines import table_lines


def line_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of ``(file, line_no, text)``: stripped, non-empty lines of new text files in ``source_dir``."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(source_dir).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return table_lines(raw, ["file"])


def validate_stream(lines: DataFrame, profile: str = "split_words", text_col: str = "text") -> DataFrame:
    """Attach ``words``, ``passed``, ``notes`` (same rules as the batch jobs)."""
    passed, notes = R.check(F.col(text_col), profile)
    return lines.select("*", T.ws_word_count(text_col).alias("words"), passed.alias("passed"), notes.alias("notes"))


def running_pass_rates(validated: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Rows, passed and pass % so far, over all lines or per ``group`` (a streaming aggregation; state: one row per group)."""
    return validated.groupBy(*(group or [])).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("passed").alias("passed"),
        (100.0 * F.avg(F.col("passed").cast("double"))).alias("pass_pct"),
    )


def _checkpoint(sink_dir: str, location: str | None) -> str:
    return location or f"{sink_dir.rstrip('/')}/_checkpoint"


def write_validated(validated: DataFrame, sink_dir: str, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append validated lines to Parquet, each line once, restarts included."""
    w = validated.writeStream.format("parquet").outputMode("append").option("checkpointLocation", _checkpoint(sink_dir, checkpoint))
    return (w.trigger(availableNow=True) if available_now else w).start(sink_dir)


def write_rates(rates: DataFrame, sink_dir: str, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Write the rates that a batch has changed to a Parquet folder of that batch; a repeated batch replaces its folder."""
    folder = sink_dir.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    w = rates.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", _checkpoint(sink_dir, checkpoint))
    return (w.trigger(availableNow=True) if available_now else w).start()


def latest_rates(spark: SparkSession, sink_dir: str, group: list[str] | None = None) -> DataFrame:
    """The newest rates of each group from a folder of ``write_rates``."""
    cols = ["rows", "passed", "pass_pct"]
    newest = spark.read.parquet(sink_dir).groupBy(*(group or [])).agg(F.max_by(F.struct(*cols), "batch").alias("r"))
    return newest.select(*(group or []), "r.*")
