"""Naive Bayes training/scoring against a brute-force computation."""

import math
import re

from pyspark.sql import functions as F

from candor.operators.classify import neutralize, score_naive_bayes, train_naive_bayes

WORD = re.compile(r"[\w'-]*\w[\w'-]*")


def test_naive_bayes_brute_force(spark):
    train = [("good great fine", 1), ("great movie", 1), ("bad awful", 0), ("awful boring bad bad", 0), ("fine", 1)]
    tests = [(1, "great fine"), (2, "bad movie"), (3, "unknown words"), (4, "")]
    tdf = spark.createDataFrame(train, "text STRING, y INT")
    w, prior = train_naive_bayes(tdf)
    out = neutralize(score_naive_bayes(spark.createDataFrame(tests, "k INT, text STRING"), ["k"], w, prior), 0.1)
    got = {r.k: r for r in out.collect()}
    c = {0: {}, 1: {}}
    for t, y in train:
        for tok in WORD.findall(t.lower()):
            c[y][tok] = c[y].get(tok, 0) + 1
    vocab = set(c[0]) | set(c[1])
    n = {y: sum(c[y].values()) for y in c}
    p = math.log(4 / 3)
    for k, t in tests:
        z = p + sum(math.log((c[1].get(x, 0) + 1) / (n[1] + len(vocab))) - math.log((c[0].get(x, 0) + 1) / (n[0] + len(vocab)))
                    for x in WORD.findall(t.lower()) if x in vocab)
        assert abs(got[k].z - z) < 1e-8
        assert got[k].label == ("POSITIVE" if z >= 0 else "NEGATIVE")
        s = round(1 / (1 + math.exp(-abs(round(z, 9)))), 9)
        assert abs(got[k].score - s) < 1e-8
        assert got[k].neutralized == ("NEUTRAL" if abs(s - 0.5) <= 0.1 else got[k].label)


def test_one_class_no_rows_and_null_labels(spark):
    docs = spark.createDataFrame([(1, "good day"), (2, ""), (3, None)], "k INT, text STRING")
    for rows, label in (([("good", 1), ("good", None), (None, 1)], "POSITIVE"), ([("good", 0)], "NEGATIVE"), ([], "POSITIVE")):
        w, prior = train_naive_bayes(spark.createDataFrame(rows, "text STRING, y INT"))
        got = {r.k: r for r in score_naive_bayes(docs, ["k"], w, prior).collect()}
        assert got[1].label == label and all(math.isfinite(r.z) for r in got.values())
        assert got[2].z == round(math.log(2.0 if rows and label == "POSITIVE" else 0.5 if rows else 1.0), 9)
    from candor.operators.metrics import label_distribution

    labels = spark.createDataFrame([("POSITIVE", "NEUTRAL"), (None, None), ("ODD", "ODD")], "label STRING, neutralized STRING")
    r = label_distribution(labels).first()
    assert (r.n, r.raw_pos, r.neu, r.unknown_labels) == (3, 1, 1, 2)


def test_token_joins_are_whole_beyond_the_broadcast_bound(spark):
    from candor.plans.joins import join_tokens

    table = spark.createDataFrame([(f"w{i}", i, 1.0 * i) for i in range(1, 60)], "tok STRING, n LONG, w DOUBLE").checkpoint()
    seen = spark.createDataFrame([(k, f"w{(k * 7) % 70}") for k in range(300)], "k INT, tok STRING")
    want = sorted(map(str, seen.join(table, "tok").select("k", "tok", "n", "w").collect()))
    for bound in (1000, 40, 3, 0):
        assert sorted(map(str, join_tokens(seen, table, "tok", "n", bound).select("k", "tok", "n", "w").collect())) == want


def test_token_sums_reads_occurrences_once(spark):
    from candor.plans.joins import token_sums

    table = spark.createDataFrame([(f"w{i}", i, 1.0 * i) for i in range(1, 60)], "tok STRING, n LONG, w DOUBLE").checkpoint()
    made = spark.sparkContext.accumulator(0)

    def token(k):
        made.add(1)
        return f"w{(k * 7) % 70}" if k % 50 else None

    rows = spark.range(300).select(F.when(F.col("id") % 11 > 0, F.col("id") % 11).alias("k"), F.udf(token, "string").asNondeterministic()("id").alias("tok"))
    want = {r.k: (r.t, r.n) for r in rows.join(table, "tok").groupBy("k").agg(F.sum("w").alias("t"), F.count("w").alias("n")).collect()}
    for bound in (1000, 40, 3, 0):
        before = made.value
        got = token_sums(rows, table, ["k"], "tok", "w", "n", bound).collect()
        assert made.value - before == 300
        assert len(got) == len(want) and {r.k: (r.total, r.n) for r in got} == want
