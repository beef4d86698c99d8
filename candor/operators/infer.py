"""Batch inference with a user model, and retry of failures only.

``infer`` wraps a user factory ``fn_factory() -> callable(list[str]) -> list[str]`` in an
iterator pandas UDF: the model is built once per Python worker and called on Arrow batches
(``spark.sql.execution.arrow.maxRecordsPerBatch`` rows). NULL prompts are skipped and give NULL,
which is how conditional work is expressed: ``when(~ok, prompt)`` routes only failing rows to
the second model call inside the same stage (Spark evaluates UDF arguments for every row, so a
``when`` around the UDF itself would not save calls). The UDF is marked nondeterministic so the
optimizer never duplicates or re-orders the call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

Model = Callable[[list[str]], list[str]]


def model_udf(fn_factory: Callable[[], Model], normalize: bool = True):
    """An iterator pandas UDF ``STRING -> STRING`` around a user model (NULL in, NULL out)."""

    @pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = fn_factory()
        for s in batches:
            mask = s.notna()
            out = pd.Series([None] * len(s), index=s.index, dtype=object)
            if mask.any():
                res = model([str(x) for x in s[mask]])
                if normalize:
                    res = [" ".join(str(r).split()) if r is not None else None for r in res]
                out[mask] = res
            yield out

    return run.asNondeterministic()


def infer(df: DataFrame, fn_factory: Callable[[], Model], in_col: str, out_col: str, normalize: bool = True) -> DataFrame:
    """Add ``out_col`` = model(``in_col``) (whitespace-collapsed when ``normalize``)."""
    return df.withColumn(out_col, model_udf(fn_factory, normalize)(F.col(in_col)))


def with_retry(df: DataFrame, prompt_col: str, first: Callable[[], Model], second: Callable[[], Model],
               validate: Callable[[Column], tuple[Column, Column]], out_col: str = "output",
               normalize: bool = True) -> DataFrame:
    """First pass on every row; a second pass only where the first output fails ``validate``.

    Adds ``output, passed, notes, retried, retry_output, retry_passed``. One stage, two model
    calls per failing row and one per passing row.
    """
    a = infer(df, first, prompt_col, out_col, normalize)
    passed, notes = validate(F.col(out_col))
    a = a.withColumn("passed", passed).withColumn("notes", notes)
    b = a.withColumn("retry_output", model_udf(second, normalize)(F.when(~F.col("passed"), F.col(prompt_col))))
    r_passed, _ = validate(F.col("retry_output"))
    return b.withColumn("retried", ~F.col("passed")).withColumn(
        "retry_passed", F.when(F.col("retried"), r_passed).otherwise(F.lit(False))
    )


def stand_in_first_sentence(clean: bool = False) -> Callable[[], Model]:
    """Factory of a deterministic stand-in model for dry runs and checks: it answers each text
    with its first sentence (the same rule as ``functions.text.first_sentence``)."""

    def factory() -> Model:
        import re

        echo = re.compile(r"(?i)summarize.*?: *[“\"”]?")
        split = re.compile(r"[.!?] +")
        tail = re.compile(r"[.!?]+\Z")

        def one(t: str) -> str:
            x = echo.sub("", " ".join(t.split()))
            first = split.split(x, maxsplit=1)[0].strip(" \"'“”")
            return (tail.sub("", first) if clean else first) + "."

        return lambda prompts: [one(p) for p in prompts]

    return factory

