"""Model 1 keeps words and bags of pairs, never a row of a pair and two words; chunks of any size give the same."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from candor.operators import translate as X
from candor.session import ensure_checkpoint_dir


def folder_bytes(spark):
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names)


def test_no_row_of_a_pair_and_two_words_is_written(spark):
    text = lambda mark, n: F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit(mark), F.col("id").cast("string"), F.lit("x"), i.cast("string"))), " ")
    pairs = spark.range(20).select("id", text("s", 300).alias("a"), text("t", 300).alias("b"))
    before = folder_bytes(spark)
    table, loss = X.train(pairs, ["id"], "a", "b", 2)
    assert table.count() == 20 * 301 * 300 and len(loss) == 3
    assert folder_bytes(spark) - before < 3_000_000


def test_repeated_and_null_keys(spark):
    """A repeated key is one pair; rows without a key only count as target words of equal shares."""
    df = spark.createDataFrame([(1, "a b a", "x"), (1, "a b a", "x"), (None, "a", "y"), (2, "b", "x z")], "k INT, a STRING, b STRING")
    table, loss = X.train(df, ["k"], "a", "b", 1)
    got = {(r.s, r.t): r.p for r in table.collect()}
    first = {"a": 1 / 2, "b": 1 / 2, "": 1 / 3}
    z1, z2 = 2 * (2 * first["a"] + first["b"] + first[""]), first["b"] + first[""]
    c = {("a", "x"): 2 * 2 * first["a"] / z1, ("b", "x"): 2 * first["b"] / z1 + first["b"] / z2, ("", "x"): 2 * first[""] / z1 + first[""] / z2, ("b", "z"): first["b"] / z2, ("", "z"): first[""] / z2}
    sums = {s: sum(x for k, x in c.items() if k[0] == s) for s in first}
    assert got == pytest.approx({k: x / sums[k[0]] for k, x in c.items()}) and len(loss) == 2


def test_chunks_of_any_size(spark, monkeypatch):
    rows = [(i, " ".join("abcdef"[:1 + i % 6]), " ".join("uvwxyz"[i % 4:])) for i in range(50)]
    words, bags = X._bags(spark.createDataFrame(rows, "k INT, a STRING, b STRING"), ["k"], "a", "b")
    batches = bags.toArrow().to_batches()

    def entries():
        out = {}
        for chunk in X._chunks(iter(batches), len(words)):
            c, _ = chunk.shares(np.ones(len(chunk.s)), 0)
            assert not out.keys() & set(zip(chunk.s.tolist(), chunk.t.tolist()))
            out.update(zip(zip(chunk.s.tolist(), chunk.t.tolist()), c.tolist()))
        return out

    whole = entries()
    for size in (1, 40, 200):
        monkeypatch.setattr(X, "CHUNK", size)
        assert entries() == pytest.approx(whole)
    assert len(list(X._chunks(iter(batches), len(words)))) > 1
