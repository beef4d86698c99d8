"""Learned substitutions, graph-ranked sentences and bootstrap intervals against plain versions."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from candor.operators import bootstrap as B
from candor.operators import graph_summary as G
from candor.operators import rewrite as RW
from candor.operators import translate as X


def plain_model_one(pairs, steps):
    bags = [(Counter(a.split()) + Counter({"": 1}), Counter(b.split())) for a, b in pairs if a.split() and b.split()]
    p = {(s, t): 1.0 for a, b in bags for s in a for t in b}
    of = Counter(s for s, _ in p)
    p = {k: 1 / of[k[0]] for k in p}
    loss = []
    for step in range(steps + 1):
        c, total = defaultdict(float), 0.0
        for a, b in bags:
            for t, nt in b.items():
                z = sum(ns * p[s, t] for s, ns in a.items())
                total += nt * math.log(z / sum(a.values()))
                for s, ns in a.items():
                    c[s, t] += nt * ns * p[s, t] / z
        loss.append(total)
        if step == steps:
            return p, loss
        sums = defaultdict(float)
        for (s, _), x in c.items():
            sums[s] += x
        p = {k: x / sums[k[0]] for k, x in c.items()}


def lexicon_pairs(n, seed):
    """Targets are the sources under a fixed word table, in another order."""
    rng = random.Random(seed)
    table = {"utilize": "use", "purchase": "buy", "house": "house", "red": "red", "obtain": "get", "tree": "tree"}
    out = []
    for _ in range(n):
        a = [rng.choice(list(table)) for _ in range(rng.randint(1, 5))]
        b = [table[w] for w in a]
        rng.shuffle(b)
        out.append((" ".join(a), " ".join(b)))
    return out


def test_model_one(spark):
    pairs = [*lexicon_pairs(60, 1), ("", "x"), ("x", ""), ("a a b", "c")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate([*pairs, (None, "x")])], "id INT, a STRING, b STRING").repartition(3)
    table, loss = X.train(df, ["id"], "a", "b", 4)
    want, want_loss = plain_model_one(pairs, 4)
    got = {(r.s, r.t): r.p for r in table.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    assert loss == pytest.approx(want_loss) and all(x <= y + 1e-9 for x, y in zip(loss, loss[1:]))
    sums = Counter()
    for (s, _), p in got.items():
        sums[s] += p
    assert all(x == pytest.approx(1) for x in sums.values())
    empty, none = X.train(df.limit(0), ["id"], "a", "b", 2)
    assert empty.count() == 0 and none == [0.0, 0.0, 0.0]


def test_learned_dictionary_simplifies(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(lexicon_pairs(200, 2))], "id INT, a STRING, b STRING")
    table, _ = X.train(df, ["id"], "a", "b", 8)
    texts = spark.createDataFrame([(t,) for t in ["use it", "use that", "buy it", "buy more", "get one", "get two", "utilize", "purchase", "obtain"]], "text STRING")
    words = X.substitutions(table, texts)
    assert {(r.word, r.simpler) for r in words.collect()} == {("utilize", "use"), ("purchase", "buy"), ("obtain", "get")}
    lines = spark.createDataFrame([(1, 1, "Utilize the red house.")], "doc_id INT, line_no INT, text STRING")
    assert RW.simplify_words(lines, ["doc_id", "line_no"], words.select("word", "simpler")).first().simplified == "Use the red house."


def dense_rank(words, rounds=5000):
    n = len(words)
    if not n:
        return np.zeros(0)
    held = Counter(w for s in words for w in s)
    w = np.zeros((n, n))
    for i in range(n):
        for j in range(n):
            if i != j:
                w[i, j] = sum(math.log(1 + n / held[x]) ** 2 for x in set(words[i]) & set(words[j]))
    r, degree = np.full(n, 1 / n), w.sum(axis=1)
    for _ in range(rounds):
        r = (1 - G.DAMPING) / n + G.DAMPING * (sum((r[j] * w[:, j] / degree[j] for j in range(n) if degree[j] > 0), np.zeros(n)) + r[degree == 0].sum() / n)
    return r


@pytest.mark.parametrize("seed", range(6))
def test_ranks_are_the_dense_fixed_point(seed):
    rng = random.Random(seed)
    words = [sorted({rng.choice("abcdefghij") for _ in range(rng.randint(0, 4))}) for _ in range(rng.randint(1, 15))]
    got = G.rank(words)
    assert np.allclose(got, dense_rank(words), atol=1e-9) and got.sum() == pytest.approx(1)


def test_ranked_sentences(spark):
    text = "The cat sat here. A dog and the cat ran.  Nothing else! The dog sat. ..."
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "one only"), (5, "a. " * 2000)], "doc_id INT, text STRING")
    rows = G.ranked_sentences(df, ["doc_id"]).collect()
    own = {r.cand_id: r.score for r in rows if r.doc_id == 1}
    words = [["the", "cat", "sat", "here"], ["a", "dog", "and", "the", "cat", "ran"], ["nothing", "else"], ["the", "dog", "sat"], []]  # the dots are a candidate without words
    want = dense_rank(words)
    assert [own[i] for i in sorted(own)] == pytest.approx(list(want), abs=1e-8)
    assert {r.doc_id for r in rows} == {1, 4, 5} and [r.score for r in rows if r.doc_id == 4] == [1.0]


def test_bootstrap_is_the_plain_loop(spark):
    rng = random.Random(4)
    rows = [(k, s, rng.randint(1, 30) if rng.random() < 0.95 else None) for k in range(40) for s in ("greedy", "beam", "draw")]
    df = spark.createDataFrame(rows, "k INT, decoding STRING, n INT")

    def weight(k, b):
        u = (int(hashlib.md5(f"42|{k}|{b}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        return sum(u >= c for c in B.CUMULATIVE)

    def mean(s, b):
        own = [((weight(k, b) if b else 1), n) for k, g, n in rows if g == s and n is not None]
        return sum(w * n for w, n in own) / sum(w for w, _ in own)

    for parts in (1, 7):
        means = B.replicate_means(df.repartition(parts), ["k"], F.col("n"), replicates=60)
        got = {r.decoding: (r.difference, r.low, r.high) for r in B.paired_intervals(means, "greedy").collect()}
        for s in ("beam", "draw"):
            drawn = sorted(mean(s, b) - mean("greedy", b) for b in range(1, 61))
            assert got[s] == pytest.approx((mean(s, 0) - mean("greedy", 0), drawn[1], drawn[58]))
    assert B.paired_intervals(B.replicate_means(df.limit(0), ["k"], F.col("n")), "greedy").count() == 0


def test_poisson_weights():
    assert B.CUMULATIVE[0] == pytest.approx(math.exp(-1)) and all(
        B.CUMULATIVE[i] == pytest.approx(sum(math.exp(-1) / math.factorial(k) for k in range(i + 1)), abs=1e-12) for i in range(len(B.CUMULATIVE)))


def test_ranks_come_from_numbers_not_strings(spark):
    texts = ["The cat sat. A cat ran! Dogs bark? The end.", "...", None, "one", "", "a b. c d. a c. ' -. b", "x. x. x."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts])], "doc_id INT, text STRING").repartition(1)
    got = {}
    for r in G.ranked_sentences(df, ["doc_id"]).collect():
        got.setdefault(r.doc_id, {})[r.cand_id] = r.score
    words = {0: ["the cat sat", "a cat ran", "dogs bark", "the end"], 3: ["one"], 5: ["a b", "c d", "a c", "", "b"], 6: ["x", "x", "x"]}
    for i, w in words.items():
        want = G.rank([x.split() for x in w]).round(G.DIGITS).tolist()
        assert [got[i][k] for k in sorted(got[i])] == [got[i + len(texts)][k] for k in sorted(got[i])] == want
    assert {i % len(texts) for i in got} - set(words) <= {1}
    numbers = {w: 97 - i for i, w in enumerate(dict.fromkeys(x for s in words[0] for x in s.split()))}
    coded = np.unique([numbers[x] for s in words[0] for x in s.split()], return_inverse=True)[1]
    assert G.rank_entries(np.array([len(s.split()) for s in words[0]]), coded).tolist() == G.rank([s.split() for s in words[0]]).tolist()


def test_texts_are_split_and_ranked_once(spark):
    df = spark.createDataFrame([(1, "A b. A c."), (2, None), (3, " "), (4, "...")], "doc_id INT, text STRING")
    ranked = G.ranked_sentences(df, ["doc_id"])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("[^.!?]+") == 1
    assert sorted((r.doc_id, r.cand_id) for r in ranked.collect()) == [(1, 1), (1, 2)]
