"""Candidate CSV sink and source.

Columns in the order of ``constants.CSV_COLUMNS``; minimal quoting with doubled quotes, empty texts
written bare, booleans as ``True``/``False``. Texts come back as they were, outer spaces, quotes and
backslashes included; NULL texts are written, and so come back, as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import text as T
from candor.session import kept

CANDIDATE_SCHEMA = "input STRING, output STRING, decoding STRING, tokens_out INT, constraint_passed STRING, notes STRING"
_TEXTS = ("input", "output", "notes")


def write_candidates_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite", order: list[str] | None = None) -> None:
    """Write candidate rows; one file per partition unless ``single_file`` is requested.

    ``order`` (e.g. input ordinal, then strategy rank) sorts the rows; files are numbered in that order. Rows are kept, compressed, in the
    checkpoint folder first: the sample that finds the sort's ranges then reads them instead of making every row once more.
    """
    if order:
        df = kept(df).orderBy(*order)
    cols = {c: F.coalesce(c, F.lit("")).alias(c) for c in _TEXTS}
    cols |= {"tokens_out": F.col("tokens_out").cast("string").alias("tokens_out"), "constraint_passed": T.bool_str("constraint_passed").alias("constraint_passed")}
    out = df.select(*[cols.get(c, F.col(c)) for c in K.CSV_COLUMNS])
    if single_file:
        out = out.coalesce(1)
    (out.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").option("quoteAll", False)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_candidates_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read candidate rows back with types: ``tokens_out`` INT, ``constraint_passed`` BOOLEAN (NULL unless True or False).

    ``multi_line`` reads texts with line breaks; files are then not split.
    """
    raw = (spark.read.schema(CANDIDATE_SCHEMA).option("header", True).option("escape", '"').option("multiLine", multi_line)
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    flag = F.when(F.col("constraint_passed") == "True", True).when(F.col("constraint_passed") == "False", False)
    cols = {c: F.coalesce(c, F.lit("")).alias(c) for c in _TEXTS} | {"constraint_passed": flag.alias("constraint_passed")}
    return raw.select(*[cols.get(c, F.col(c)) for c in K.CSV_COLUMNS])
