"""Prompt sources: the inline prompt set and template rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor import constants as K


def prompt_table(spark: SparkSession, prompts: list[tuple[str, str]] | None = None, prefix: str = K.BATCH_PREFIX) -> DataFrame:
    """``(prompt_id, family, prompt, batch_prompt)`` from user rows (default: the 12-prompt set)."""
    rows = [(i + 1, fam, p) for i, (fam, p) in enumerate(prompts or K.PROMPT_SET)]
    df = spark.createDataFrame(rows, "prompt_id INT, family STRING, prompt STRING")
    return df.withColumn("batch_prompt", F.concat(F.lit(prefix), "prompt"))


def render_templates(df: DataFrame, text_col: str, templates: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """One row per input row and template: ``template`` name and rendered ``prompt``.

    The template list is a small parameter, inlined as a literal array and exploded (a narrow
    Generate, no join and no shuffle).
    """
    tpl = templates or K.TEMPLATES
    arr = F.array(*[
        F.struct(F.lit(n).alias("template"), F.lit(p).alias("prefix"), F.lit(s).alias("suffix")) for n, p, s in tpl
    ])
    out = df.withColumn("_t", F.explode(arr))
    return out.withColumn("template", F.col("_t.template")).withColumn(
        "prompt", F.concat(F.col("_t.prefix"), F.col(text_col), F.col("_t.suffix"))
    ).drop("_t")
