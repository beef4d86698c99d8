import random

import numpy as np
import pytest

from candor.operators import spans as S


def plain_longest(source, output):
    """All pairs of starts; the first longest run of the output, at its first place in the source."""
    a, b = (source or "").lower().split(), (output or "").lower().split()
    best = (0, 0, 0)
    for j in range(len(b)):
        for i in range(len(a)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if n > best[0]:
                best = (n, j, i)
    return best


def plain_spans(docs, reference, least):
    refs = {tuple((t or "").lower().split()) for t in reference}
    out = []
    for key, text in docs:
        words = (text or "").lower().split()
        spans = []
        for i in range(len(words)):
            n = max((next((m for m in range(min(len(words) - i, len(r) - j) + 1) if m == min(len(words) - i, len(r) - j) or words[i + m] != r[j + m]), 0)
                     for r in refs for j in range(len(r))), default=0)
            if n >= least:
                spans.append((i, n))
        out += [(key, i, n) for i, n in spans if not any(a <= i and i + n <= a + m and (a, m) != (i, n) for a, m in spans)]
    return sorted(out)


def random_texts(n, seed, words="abcde", size=40):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_longest_copied(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(random_texts(150, 1), random_texts(150, 2)))]
    rows += [(900, None, "a"), (901, "a", None), (902, "", ""), (903, "A b  C", "c a B c"), (904, "x y", "q r"), (905, "w " * 3000, "w " * 2000)]
    df = spark.createDataFrame(rows, "id INT, a STRING, b STRING")
    for r in S.longest_copied(df, "a", "b").collect():
        if r.id == 905:
            assert tuple(r.copied) == (2000, 0, 0)
        else:
            assert tuple(r.copied) == plain_longest(r.a, r.b)


@pytest.mark.parametrize("seed", range(8))
def test_longest_matches(seed):
    rng = np.random.default_rng(seed)
    ref, seg = ([rng.integers(0, 3, rng.integers(1, 30)) for _ in range(rng.integers(1, 6))] for _ in range(2))
    for s, got in zip(seg, S.longest_matches(ref, seg)):
        for i in range(len(s)):
            best = 0
            for r in ref:
                for j in range(len(r)):
                    n = 0
                    while i + n < len(s) and j + n < len(r) and s[i + n] == r[j + n]:
                        n += 1
                    best = max(best, n)
            assert got[i] == best


@pytest.mark.parametrize("limits", [{}, {"SHARD_WORDS": 30, "BATCH_WORDS": 50}, {"MAX_BROADCAST_SEEDS": 0, "SHARD_WORDS": 100}])
@pytest.mark.parametrize("least", [1, 3, 4])
def test_shared_spans(spark, monkeypatch, limits, least):
    for k, v in limits.items():
        monkeypatch.setattr(S, k, v)
    docs = list(enumerate([*random_texts(40, 3), None, "", "A  b C", "x " * 300]))
    reference = [*random_texts(12, 4), None, "", "x " * 200, "a b c d e", "a b c d e"]
    a = spark.createDataFrame(docs, "doc_id INT, text STRING")
    b = spark.createDataFrame([(t,) for t in reference], "text STRING")
    got = sorted(tuple(r) for r in S.shared_spans(a, b, ["doc_id"], least).collect())
    assert got == plain_spans(docs, reference, least)


def test_empty(spark):
    a, none = spark.createDataFrame([(1, "a b c d e")], "doc_id INT, text STRING"), spark.createDataFrame([], "doc_id INT, text STRING")
    assert S.shared_spans(a, none, ["doc_id"]).count() == 0 and S.shared_spans(none, a, ["doc_id"]).count() == 0
