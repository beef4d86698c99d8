import math
import random

import pytest
from pyspark.sql import functions as F

from candor.operators import logistic as C
from candor.operators.classify import neutralize, score_naive_bayes, train_naive_bayes


def noisy(n, seed):
    """Texts whose class shows in a few words, each said several times as in real texts, with labels that are wrong now and then."""
    rng = random.Random(seed)
    good, bad, plain = ["clear", "useful", "sound"], ["broken", "awful", "spam"], [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        y = rng.random() < 0.6
        marks = [rng.choice(good if (rng.random() < 0.8) == y else bad) for _ in range(rng.randint(0, 3))]
        words = [m for m in marks for _ in range(rng.randint(1, 6))] + [rng.choice(plain) for _ in range(rng.randint(5, 40))]
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(y if rng.random() < 0.95 else not y)))
    return rows


SCHEMA = "id INT, text STRING, y INT"


def test_better_calibrated_than_naive_bayes(spark):
    seen, rest = spark.createDataFrame(noisy(1500, 1), SCHEMA), spark.createDataFrame(noisy(600, 2), SCHEMA)
    model = C.train(seen, ["id"])
    scored = C.score(rest, model)
    bayes = score_naive_bayes(rest, ["id"], *train_naive_bayes(seen)).withColumn("p", 1 / (1 + F.exp(-F.col("z"))))
    ours, theirs = C.quality(scored).first(), C.quality(bayes).first()
    assert ours.rows == theirs.rows == 600
    assert ours.log_loss < theirs.log_loss and ours.calibration_error < theirs.calibration_error and ours.log_loss < 0.6
    banded = neutralize(scored, 0.1).groupBy("neutralized").count().collect()
    share = {r.neutralized: r["count"] / 600 for r in banded}
    assert 0.01 < share.get("NEUTRAL", 0) < 0.5 and share["POSITIVE"] > 0.2 and share["NEGATIVE"] > 0.1
    order = [r.p for r in scored.orderBy("raw").collect()]
    assert order == sorted(order)


def test_quality_is_its_definition(spark):
    rows = [(0.9, 1), (0.2, 0), (0.75, 0), (0.71, 1), (0.0, 1), (1.0, 1), (0.5, None)]
    got = C.quality(spark.createDataFrame(rows, "p DOUBLE, y INT")).first()
    known = [(min(max(p, 1e-6), 1 - 1e-6), y) for p, y in rows if y is not None]
    assert got.rows == 6
    assert got.log_loss == pytest.approx(sum(-math.log(p if y else 1 - p) for p, y in known) / 6)
    assert got.brier == pytest.approx(sum((p - y) ** 2 for p, y in known) / 6)
    bins = {}
    for p, y in known:
        bins.setdefault(min(int(p * 10), 9), []).append(p - y)
    assert got.calibration_error == pytest.approx(sum(abs(sum(b)) for b in bins.values()) / 6)


def least_squares(bins):
    """Isotonic fit by its max-min formula."""
    n = len(bins)
    mean = lambda a, b: sum(x[2] for x in bins[a:b + 1]) / sum(x[1] for x in bins[a:b + 1])
    return [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


@pytest.mark.parametrize("seed", range(10))
def test_pooling_is_the_isotonic_fit(seed):
    rng = random.Random(seed)
    bins = [(i / 20, float(n := rng.randint(1, 9)), float(rng.randint(0, n))) for i in range(20)]
    want, blocks = least_squares(bins), C.pooled(bins)
    got = [y / n for _, n, y in blocks for _ in range(1)]
    assert sorted(set(round(w, 9) for w in want)) == [round(g, 9) for g in got]
    assert sum(b[1] for b in blocks) == sum(b[1] for b in bins)


def test_edges(spark):
    for rows in ([], [(1, "only good", 1)], [(1, None, 1), (2, "x", None), (3, "y", 7)]):
        model = C.train(spark.createDataFrame(rows, SCHEMA), ["id"])
        out = C.score(spark.createDataFrame([(5, "text", 1), (6, None, 0), (7, "", 1)], SCHEMA), model).collect()
        assert len(out) == 3 and all(0 < r.p < 1 for r in out)
    model = C.train(spark.createDataFrame(noisy(200, 3), SCHEMA), ["id"])
    out = C.score(spark.createDataFrame([(5, "", 1), (6, None, 0)], SCHEMA), model).collect()
    assert out[0].p == out[1].p


def test_texts_are_hashed_once(spark, monkeypatch):
    texts = spark.createDataFrame([*noisy(120, 4), (900, None, 1), (901, "", 0), (None, "sound w1", 1)], SCHEMA)
    plain = C.train(texts, ["id"])
    want = sorted((str(r.id), r.raw, r.p) for r in C.score(texts, plain).collect())
    table = C.hashed(texts, ["id", "y"])
    assert table.columns == ["id", "y", "has_text", "features"] and table.where("NOT has_text").count() == 1
    monkeypatch.setattr(C.T, "regex_words", None)  # no text is read again
    shared = C.train(table, ["id"])
    got = sorted((str(r.id), r.raw, r.p) for r in C.score(table, shared).collect())
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [x for g in got for x in g[1:]] == pytest.approx([x for w in want for x in w[1:]], abs=1e-6)
