import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candor.llm import hyperminhash as H

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING"


def brute(rows, percent=85):
    """(doc_id, text) rows -> {row index: (size, component)} by comparing all pairs of shingle sets."""
    sets = []
    for _, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if union and 100 * both >= percent * union:
                comp[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[root(i)] = min(d, best.get(root(i), d))
    return sorted(((d, len(sets[i]), best.get(root(i)), d == best.get(root(i)) or None is d is best.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, percent=85):
    out = H.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent=percent)
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()), key=str)


def test_whole_table_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = H.near_duplicates(docs)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()), key=str) == brute(rows)


def test_chain_of_near_copies_is_one_component(spark):
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):  # each differs from the one before in one more word, ends are far apart
        base[5 * i] = f"x{i}"
        rows.append((100 - i, " ".join(base)))
    rows += [(500 + i, " ".join(f"a{i}_{j}" for j in range(30)) + " shared tail of a few words") for i in range(20)]
    assert run(spark, rows) == brute(rows)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(130)]
    rows = []
    for i in range(160):  # near copies of one text, some too far from all others
        own = list(base)
        for k in rng.choice(130, rng.integers(1, 9), replace=False):
            own[k] = f"x{rng.integers(1000)}"
        rows.append((1000 - i, " ".join(own)))
    want = brute(rows)
    assert 1 < len({r[2] for r in want}) < 150
    for few, block in ((32, 256), (0, 256), (0, 20), (1 << 30, 256)):
        monkeypatch.setattr(H, "FEW", few)
        monkeypatch.setattr(H, "BLOCK_SETS", block)
        assert run(spark, rows) == want
    assert run(spark, rows, 80) == brute(rows, 80) != want


def test_edges(spark):
    long = " ".join(f"t{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two\n"), (6, "two one"), (7, "a b c d e"), (7, "a b c d e"),
            (None, "a b c d e"), (None, None), (9, long), (8, long.upper()), (10, "Ä b c d e f"), (11, "ä b c d e f"),
            (None, "only null ids here now"), (12, "a\x0bb c\x0cd\re"), (13, "a b c d e")]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert H.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "a b c d e f", 5, "q"), (2, "a b c d e f", 6, "r"), (3, "", 7, "s"), (3, "", 7, "s")],
                               "doc_id LONG, text STRING, n LONG, h1 STRING").withColumn("node", F.lit(1)).withColumn("_blank", F.lit(2))
    out = H.keep_one(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 3]


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(1)
    errs = []
    for n in (300, 3000, 30000):
        for share in (0.2, 0.5, 0.85):
            both = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
            a, b = (np.unique(np.concatenate((both, rng.integers(0, 1 << 63, n - len(both), dtype=np.uint64)))) for _ in "ab")
            reg = H.registers([a, b])
            est = H.estimate(reg[:1], reg[1:], [len(a)], [len(b)])[0]
            errs.append(est - len(both) / (2 * n - len(both)))
    assert max(map(abs, errs)) < 0.12


@pytest.mark.parametrize("n", [1, 2, 7])
def test_small_sets_fill_all_registers(n):
    reg = H.registers([np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)])
    assert len(np.unique(reg)) <= n and (reg > 0).all()


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_keep_one_with_and_without_broadcasts(spark, monkeypatch, limit):
    monkeypatch.setattr(H.C, "MAX_BROADCAST_KEYS", limit)
    base = "one two three four five six seven eight nine ten eleven twelve".split()
    rows = [(i, " ".join(base)) for i in range(5, 1, -1)] + [(2, " ".join(base)), (9, "other words"), (9, "other words"), (10, None), (11, " "), (11, " ")]
    out = H.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.text) for r in out if r.text and r.text.strip()) == [(2, " ".join(base)), (9, "other words")]
    assert sorted(r.doc_id for r in out if not (r.text or "").strip()) == [10, 11, 11]
