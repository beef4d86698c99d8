"""Trained and calibrated binary classification: logistic regression over hashed words, then isotonic calibration.

Words and word pairs of a text are hashed into ``2 ** bits`` features, so the model has a fixed size whatever the vocabulary. The weights are
fitted by Spark ML (quasi-Newton steps with line search, gradients summed over a tree of tasks). Raw probabilities of rows that training did not see are
then calibrated: they are counted in ``BINS`` bins, and neighbouring bins that fall are pooled until the share of positives rises with the score. Bins are
the only thing that leaves the executors. Scores interpolate between the pooled blocks, so the neutral band catches what is uncertain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import text as T
from candor.session import kept

BITS = 18
BINS = 1024
EPS = 1e-6
DIGITS = 9


def features(df: DataFrame, text_col: str = "text", bits: int = BITS, out_col: str = "features") -> DataFrame:
    """Add the hashed words and word pairs of a text, each counted once, as a vector of length 1 (no words: the zero vector).

    A table that has them already stays as it is, so ``train`` and ``score`` can share one that was kept (``hashed``).
    """
    if out_col in df.columns:
        return df
    words = df.withColumn("_w", F.coalesce(T.regex_words(text_col), F.array().cast("array<string>")))
    n = F.size("_w") - 1
    pairs = F.transform(F.arrays_zip(F.slice("_w", 1, F.greatest(n, F.lit(0))).alias("a"), F.slice("_w", 2, F.greatest(n, F.lit(0))).alias("b")), lambda x: F.concat_ws(" ", x["a"], x["b"]))
    hashed = HashingTF(numFeatures=1 << bits, binary=True, inputCol="_t", outputCol="_f").transform(words.withColumn("_t", F.concat("_w", pairs)))
    return Normalizer(inputCol="_f", outputCol=out_col).transform(hashed).drop("_w", "_t", "_f")


def hashed(df: DataFrame, keep: list[str], text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``keep, features`` of every row and ``has_text`` (text is not NULL), made once and kept."""
    return kept(features(df, text_col, bits).select(*keep, F.col(text_col).isNotNull().alias("has_text"), "features"))


@dataclass
class Calibration:
    """Rising points ``(score, share of positives)``; scores between two points are interpolated."""

    points: list[tuple[float, float]]

    def apply(self, score: Column) -> Column:
        if not self.points:
            return score
        (first, p), *rest = self.points
        out = F.when(score <= first, F.lit(p))
        for (a, pa), (b, pb) in zip(self.points, rest):
            out = out.when(score <= b, F.lit(pa) + (score - F.lit(a)) * F.lit((pb - pa) / (b - a)))
        return out.otherwise(F.lit(self.points[-1][1]))


def pooled(bins: list[tuple[float, float, float]]) -> list[tuple[float, float, float]]:
    """Pool adjacent violators: ``(x, weight, positives)`` in rising ``x`` to blocks ``(mean x, weight, positives)`` whose shares rise."""
    blocks: list[list[float]] = []
    for x, n, y in bins:
        blocks.append([x * n, n, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return [(x / n, n, y) for x, n, y in blocks]


def calibrate(scored: DataFrame, label_col: str = "y", score_col: str = "raw", bins: int = BINS) -> Calibration:
    """The calibration of ``scored(score, y in {0, 1})``: at most ``bins`` rows reach the driver. Shares are smoothed by half a row of each class."""
    at = F.least(F.floor(F.col(score_col) * bins), F.lit(bins - 1)).alias("bin")
    rows = scored.where(F.col(score_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(at).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label_col).cast("long")).alias("y")).orderBy("bin").collect()
    return Calibration([(x, (y + 0.5) / (n + 1)) for x, n, y in _rising(pooled([((r.bin + 0.5) / bins, float(r.n), float(r.y)) for r in rows]))])


def _rising(blocks: list[tuple[float, float, float]]) -> list[tuple[float, float, float]]:
    """Smoothing can turn two blocks of few rows; those are pooled as well."""
    done = False
    while not done:
        done = True
        for i in range(len(blocks) - 1):
            (x, n, y), (a, m, b) = blocks[i], blocks[i + 1]
            if (y + 0.5) / (n + 1) >= (b + 0.5) / (m + 1):
                blocks = [*blocks[:i], ((x * n + a * m) / (n + m), n + m, y + b), *blocks[i + 2:]]
                done = False
                break
    return blocks


@dataclass
class Classifier:
    model: LogisticRegressionModel | None
    prior: float
    calibration: Calibration
    bits: int


def train(texts: DataFrame, keys: list[str], label_col: str = "y", text_col: str = "text", bits: int = BITS, regularisation: float = 1e-3,
          iterations: int = 50, calibrating: int = 4) -> Classifier:
    """A classifier of ``texts(keys, text, y in {0, 1})``; one row in ``calibrating``, chosen by a hash of ``keys``, calibrates and is not trained on.

    Rows with another label or a NULL are not used. With one class only (or none), every text gets that class' smoothed share.
    ``texts`` may be rows of ``hashed`` (of the same ``bits``) instead. What is trained on is kept, as it is read several times.
    """
    told = F.col("has_text") if "has_text" in texts.columns else F.col(text_col).isNotNull()
    known = texts.where(F.col(label_col).isin(0, 1) & told).withColumn(label_col, F.col(label_col).cast("double"))
    held = F.pmod(F.crc32(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])), F.lit(calibrating)) == 0
    ready = kept(features(known, text_col, bits).select(label_col, "features", held.alias("held")))
    fit, rest = ready.where(~F.col("held")), ready.where("held")
    n1, n0 = fit.agg(F.count_if(F.col(label_col) == 1), F.count_if(F.col(label_col) == 0)).first()
    prior = (n1 + 0.5) / (n1 + n0 + 1)
    if not n1 or not n0:
        return Classifier(None, prior, Calibration([]), bits)
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=iterations, tol=1e-5, regParam=regularisation, standardization=False, aggregationDepth=2)
    model = lr.fit(fit)
    return Classifier(model, prior, calibrate(_raw(model, rest), label_col), bits)


def _raw(model: LogisticRegressionModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("raw", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def score(df: DataFrame, classifier: Classifier, text_col: str = "text") -> DataFrame:
    """Add ``raw`` and ``p`` (probability of the positive class before and after calibration), ``label`` and ``score`` (of the winning class)."""
    if classifier.model is None:
        out = df.withColumn("raw", F.lit(classifier.prior))
    else:
        out = _raw(classifier.model, features(df, text_col, classifier.bits)).drop("features")
    out = out.withColumn("p", F.round(classifier.calibration.apply(F.col("raw")), DIGITS))
    label = F.when(F.col("p") >= 0.5, F.lit(K.LABEL_POSITIVE)).otherwise(F.lit(K.LABEL_NEGATIVE))
    return out.withColumn("label", label).withColumn("score", F.greatest(F.col("p"), 1 - F.col("p")))


def quality(scored: DataFrame, label_col: str = "y", p_col: str = "p", bins: int = 10) -> DataFrame:
    """One row: ``rows, log_loss, brier, calibration_error`` (mean distance of predicted and true share over ``bins`` bins)."""
    y, p = F.col(label_col).cast("double"), F.least(F.greatest(F.col(p_col), F.lit(EPS)), F.lit(1 - EPS))
    each = scored.where(y.isNotNull()).select(p.alias("p"), y.alias("y"), F.least(F.floor(p * bins), F.lit(bins - 1)).alias("bin"))
    per = each.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum(-F.when(F.col("y") == 1, F.log("p")).otherwise(F.log(1 - F.col("p")))).alias("loss"),
                                  F.sum((F.col("p") - F.col("y")) ** 2).alias("square"), F.abs(F.sum(F.col("p") - F.col("y"))).alias("gap"))
    n = F.sum("n")
    return per.agg(F.coalesce(n, F.lit(0).cast("long")).alias("rows"), (F.sum("loss") / n).alias("log_loss"), (F.sum("square") / n).alias("brier"), (F.sum("gap") / n).alias("calibration_error"))
