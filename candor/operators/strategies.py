"""Decoding strategies as data: the parameter table, input x strategy expansion, seeded draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candor import constants as K

STRATEGY_SCHEMA = (
    "strategy STRING, do_sample BOOLEAN, num_beams INT, temperature DOUBLE, top_p DOUBLE, top_k INT, "
    "no_repeat_ngram INT, source_no_repeat_ngram INT, repetition_penalty DOUBLE, length_penalty DOUBLE, "
    "min_length INT, max_length INT"
)

def strategy_rows(names: list[str]) -> list[dict]:
    return [dict(zip(K.STRATEGY_COLUMNS, K.STRATEGIES[n])) for n in names]


def strategy_table(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """The named parameter sets of ``constants.STRATEGIES`` as a DataFrame."""
    names = names or list(K.STRATEGIES)
    return spark.createDataFrame([K.STRATEGIES[n] for n in names], STRATEGY_SCHEMA)


def expand(df: DataFrame, strategies: list[dict], name_col: str = "decoding") -> DataFrame:
    """Input x strategy, long format: one row per input and strategy, by a narrow Generate over literals."""
    structs = []
    for rank, s in enumerate(strategies):
        fields = [F.lit(s["strategy"]).alias(name_col), F.lit(rank).alias("strategy_rank")]
        for c in K.STRATEGY_COLUMNS[1:]:
            fields.append(F.lit(s.get(c)).alias(c))
        structs.append(F.struct(*fields))
    return df.withColumn("_s", F.explode(F.array(*structs))).select("*", "_s.*").drop("_s")


def uniform(seed: int, *parts: Column | str) -> Column:
    """Reproducible U(0,1) per row from ``md5(seed|part|...)``, independent of partitioning.

    ``u = (int(first 13 hex digits) + 0.5) / 2^52``; the same value is computed by any engine
    with md5 and hex parsing (the oracle uses it too).
    """
    cols = [F.lit(str(seed))] + [F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]
    h = F.md5(F.concat_ws("|", *cols))
    as_int = F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint")
    return (as_int.cast("double") + F.lit(0.5)) / F.lit(float(2**52))
