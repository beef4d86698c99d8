"""Report text: metric tables and candidate rows as formatted lines, and ordinals inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import text as T
from candor.plans.ordinals import global_row_number
from candor.session import ensure_checkpoint_dir


def number_within(df: DataFrame, group: list[str], order: list[str], name: str = "ord") -> DataFrame:
    """``name``: the 1-based position of a row in its group under ``order`` (with ``group``, unique).

    Rows are numbered over the whole table in range partitions; a group's first number is taken off. So a group that
    holds most of the rows is spread over many tasks. ``df`` is made once, for the sample of the ranges and for the sort.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numbered = global_row_number(df.checkpoint(eager=True), [F.col(c).asc() for c in [*group, *order]], "_rn")
    first = numbered.groupBy(*group).agg(F.min("_rn").alias("_first"))
    return numbered.join(first, group).withColumn(name, F.col("_rn") - F.col("_first") + 1).drop("_rn", "_first")


def _lines(parts: list[Column]) -> Column:
    return F.array(*[F.struct(F.lit(i + 1).alias("line_no"), p.alias("line")) for i, p in enumerate(parts)])


def guard_metric_lines(metrics: DataFrame) -> DataFrame:
    """``(line_no, line)`` of one row of guardrail metrics."""
    return metrics.select(F.inline(_lines([T.printf(f, c) for c, f in K.GUARD_METRICS])))


def strategy_table_lines(evaluation: DataFrame, group: str = "decoding") -> DataFrame:
    """``(decoding, line)`` of the strategy evaluation, under ``constants.STRATEGY_HEADER``."""
    cells = [F.col(c) for c in ("pass_pct", "avg_wc", "std_wc", "repeat_pct")]
    return evaluation.select(group, T.printf(K.STRATEGY_LINE, F.initcap(group), *cells).alias("line"))


def mini_report_lines(report: DataFrame, group: str = "decoding") -> DataFrame:
    """``(decoding, line_no, line)``: the mini-report block of each strategy, one line where it has no rows."""
    values = [group, "rows", "pass_pct", "avg_tokens", "reflection"]
    block = _lines([T.printf(f, c) for f, c in zip(K.MINI_REPORT, values)])
    empty = _lines([F.format_string(K.MINI_REPORT_EMPTY, F.col(group))])
    return report.select(group, F.inline(F.when(F.col("rows") == 0, empty).otherwise(block)))


def side_by_side_lines(wide: DataFrame, ordinal: str, names: list[str]) -> DataFrame:
    """``(ordinal, line_no, line)``: the outputs of three strategies under each other."""
    first, second, third = K.SIDE_BY_SIDE
    outputs = [F.coalesce(F.trim(F.col(n)), F.lit("")) for n in names]
    return wide.select(ordinal, F.inline(_lines([F.format_string(first, F.col(ordinal), outputs[0]), F.format_string(second, outputs[1]),
                                                 F.format_string(third, outputs[2])])))


def sentiment_lines(scored: DataFrame, ordinal: str = "line_no", text_col: str = "text") -> DataFrame:
    """``scored`` with ``line`` (raw label, score, label under the neutral band) and ``text_line``."""
    line = T.printf(K.SENTIMENT_LINE, F.col(ordinal), F.col("label"), F.col("score"), F.col("neutralized"))
    return scored.withColumn("line", line).withColumn("text_line", F.format_string(K.SENTIMENT_TEXT_LINE, F.col(text_col)))


def distribution_lines(distribution: DataFrame) -> DataFrame:
    """``(line_no, line)`` of one row of ``metrics.label_distribution``."""
    return distribution.select(F.inline(_lines([F.format_string(K.RAW_DISTRIBUTION, "raw_pos", "raw_neg"),
                                                F.format_string(K.NEUTRAL_DISTRIBUTION, "pos", "neg", "neu")])))


def status_lines(g: DataFrame, ordinal: str, input_col: str, output_col: str) -> DataFrame:
    """Per-row report of a guarded job: status line, input preview, output and retry lines."""
    status = F.format_string(
        "%02d. beam_pass=%s | words=%02d | notes=%s%s%s",
        F.col(ordinal), T.bool_str("passed"), F.col("words"), T.notes_or_dash("notes"),
        F.when(F.col("retried"), F.lit(" | retry_triggered")).otherwise(F.lit("")),
        F.when(F.col("retry_passed"), F.lit(" | retry_fixed")).otherwise(F.lit("")),
    )
    return g.select(
        F.col(ordinal),
        status.alias("status_line"),
        F.concat(F.lit("    input : "), T.preview(input_col)).alias("input_line"),
        F.concat(F.lit("    output: "), F.col(output_col)).alias("output_line"),
        F.when(F.col("retried"), F.concat(F.lit("    retry : "), F.col(f"retry_{output_col}"))).alias("retry_line"),
    )
