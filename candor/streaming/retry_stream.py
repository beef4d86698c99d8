"""Retry on a stream: a failing line is tried again in a later batch, at most ``budget`` times, restarts included.

Attempts are columns made before the state: ``outputs``, an array of the first output and its retries, and ``passes``, whether each passes the rules (see
``attempts``). The state of a line (keyed by file and number) is the attempt it waits for; it is there only while the line fails and has attempts left, and
ends ``ttl`` after its last change. A timer wakes a line in the first batch that runs ``delay`` (at least 1 ms, so a later batch) after the failure. The state store must be the one on disk,
since lines wait across batches, and batches without data are off, else a run over what has arrived would never end (``use_disk_state`` sets both).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from candor.streaming.validate_stream import _checkpoint

DELAY_MS, TTL_MS = 1, 7 * 24 * 3600 * 1000
_STATE = "next INT, outputs ARRAY<STRING>, passes ARRAY<BOOLEAN>"
OUT = "file STRING, line_no INT, attempt INT, output STRING, passed BOOLEAN, final BOOLEAN"


def use_disk_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")


def attempts(lines: DataFrame, outputs: list[Column], check: Callable[[Column], tuple[Column, Column]]) -> DataFrame:
    """``file, line_no, outputs, passes``: the first output of each line and its retries, and whether each passes ``check(output)``."""
    return lines.select("file", F.col("line_no").cast("int").alias("line_no"), F.array(*outputs).alias("outputs"), F.array(*[check(o)[0] for o in outputs]).alias("passes"))


class _Retry(StatefulProcessor):
    def __init__(self, budget: int, delay_ms: int, ttl_ms: int):
        self.budget, self.delay_ms, self.ttl_ms = budget, max(delay_ms, 1), ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", _STATE, self.ttl_ms)

    def _try(self, key, at: int, outputs: list, passes: list, timers) -> pd.DataFrame:
        last = passes[at] or at >= self.budget or at + 1 >= len(outputs)
        if last:
            self.waiting.clear()
        else:
            self.waiting.update((at + 1, outputs, passes))
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.delay_ms)
        return pd.DataFrame([(*key, at + 1, outputs[at], bool(passes[at]), bool(last))], columns=[f.split()[0] for f in OUT.split(", ")])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for outputs, passes in zip(frame["outputs"], frame["passes"]):
                if not self.waiting.exists():  # a line that comes again while it waits is the same line
                    yield self._try(key, 0, list(outputs), [bool(p) for p in passes], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.waiting.exists():
            at, outputs, passes = self.waiting.get()
            yield self._try(key, at, list(outputs), list(passes), timerValues)

    def close(self) -> None:
        pass


def retried(tries: DataFrame, budget: int = 1, delay_ms: int = DELAY_MS, ttl_ms: int = TTL_MS) -> DataFrame:
    """``file, line_no, attempt, output, passed, final``: one row for each attempt made, the first in the line's own batch, others in later ones."""
    return tries.groupBy("file", "line_no").transformWithStateInPandas(_Retry(budget, delay_ms, ttl_ms), OUT, "append", "processingTime")


def write_attempts(rows: DataFrame, sink_dir: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append attempts to Parquet, each once, restarts included. A start runs over what has arrived; lines that are due come with it."""
    w = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", _checkpoint(sink_dir, checkpoint))
    return w.trigger(availableNow=True).start(sink_dir)
