"""Uncertainty of strategy differences by a Poisson bootstrap (Chamandy et al. 2012).

Each input row gets a Poisson(1) weight for each replicate, drawn from a hash of seed, key and replicate: rows of one input under different strategies share their
weights, so differences are paired and a weight is drawn once an input, and no partitioning changes a draw. A replicate's weighted mean is two sums, merged inside tasks: one row a strategy and replicate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor import constants as K
from candor.operators.strategies import uniform

REPLICATES = 200
# Cumulative probabilities of 0, 1, 2, ... events under a mean of one; beyond, a weight has probability under 1e-9.
CUMULATIVE = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183,
              0.999916758850712, 0.9999897508033253, 0.999998874797402, 0.9999998885745217, 0.9999999899522336, 0.9999999991683892)


def poisson(u: Column) -> Column:
    """The Poisson(1) weight of a uniform number."""
    out = F.when(u < F.lit(CUMULATIVE[0]), 0)
    for i, c in enumerate(CUMULATIVE[1:], 1):
        out = out.when(u < F.lit(c), i)
    return out.otherwise(len(CUMULATIVE))


def replicate_means(rows: DataFrame, keys: list[str], value: Column, group: str = "decoding", replicates: int = REPLICATES, seed: int = K.DEFAULT_SEED) -> DataFrame:
    """``group, replicate, n, mean`` of ``value``; replicate 0 is the data itself. Rows with a NULL value are left out; a replicate without weight has a NULL mean."""
    own = rows.select(F.col(group).alias("_g"), *keys, value.cast("double").alias("_v")).where("_v is not null")
    per = own.groupBy(*keys, "_g").agg(F.sum("_v").alias("_v"), F.count(F.lit(1)).alias("_n"))
    inputs = per.groupBy(*keys).agg(F.collect_list(F.struct("_g", "_v", "_n")).alias("_of"))  # one entry a strategy
    drawn = inputs.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates)))).withColumn("_u", uniform(seed, *keys, F.col("replicate")))
    weight = F.when(F.col("replicate") == 0, 1).otherwise(poisson(F.col("_u")))
    each = drawn.select("replicate", "_of", weight.alias("_w")).select("replicate", "_w", F.inline("_of"))
    sums = each.groupBy("_g", "replicate").agg(F.sum(F.col("_w") * F.col("_n")).alias("n"), F.sum(F.col("_w") * F.col("_v")).alias("_s"))
    return sums.select(F.col("_g").alias(group), "replicate", "n", F.try_divide("_s", "n").alias("mean"))


def paired_intervals(means: DataFrame, base: str, group: str = "decoding", level: float = 0.95) -> DataFrame:
    """``group, difference, low, high`` against the strategy ``base``: the observed difference of means and its percentile interval (nearest rank).

    ``means`` is a few rows a strategy. A strategy without replicates (no rows) is absent.
    """
    ours = means.where(F.col(group) != base).select(group, "replicate", F.col("mean").alias("_a"))
    theirs = means.where(F.col(group) == base).select("replicate", F.col("mean").alias("_b"))
    diff = ours.join(theirs, "replicate").select(group, "replicate", (F.col("_a") - F.col("_b")).alias("_d"))
    drawn = diff.where("replicate > 0 and _d is not null")
    at = F.row_number().over(Window.partitionBy(group).orderBy("_d", "replicate"))  # one row a replicate
    ranked = drawn.withColumn("_rn", at).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(group)))
    tail = round((1 - level) / 2, 12)
    low, high = F.greatest(F.ceil(F.col("_n") * tail), F.lit(1)), F.greatest(F.ceil(F.col("_n") * (1 - tail)), F.lit(1))
    bounds = ranked.groupBy(group).agg(F.max(F.when(F.col("_rn") == low, F.col("_d"))).alias("low"), F.max(F.when(F.col("_rn") == high, F.col("_d"))).alias("high"))
    return diff.where("replicate = 0").select(group, F.col("_d").alias("difference")).join(bounds, group, "left")
