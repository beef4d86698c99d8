"""Batch inference: one model call per row, a second only for failing rows."""

from pyspark.sql import functions as F

from candor.functions import rules as R
from candor.operators.infer import infer, with_retry


def counting_factory(acc, fn):
    def factory():
        def run(prompts):
            acc.add(len(prompts))
            return [fn(p) for p in prompts]

        return run

    return factory


def test_retry_calls_only_failures(spark):
    sc = spark.sparkContext
    first_calls, second_calls = sc.accumulator(0), sc.accumulator(0)
    rows = [(i, f"word {i} " * (3 if i % 3 == 0 else 5) + ".") for i in range(90)]
    df = spark.createDataFrame(rows, "id INT, prompt STRING")
    first = counting_factory(first_calls, lambda p: p)
    second = counting_factory(second_calls, lambda p: "a longer and fixed answer with enough words here.")
    out = with_retry(df, "prompt", first, second, lambda c: R.check(c, "rewrite")).cache()
    res = out.collect()
    failures = sum(1 for r in res if not r.passed)
    assert first_calls.value == 90
    assert second_calls.value == failures
    assert all(r.retried == (not r.passed) for r in res)
    assert all(r.retry_passed for r in res if r.retried)
    assert all(r.retry_output is None for r in res if not r.retried)


def test_infer_skips_nulls(spark):
    acc = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([("a  b",), (None,), ("c",)], "p STRING")
    out = infer(df, counting_factory(acc, lambda p: p.upper()), "p", "o").collect()
    assert [r.o for r in out] == ["A B", None, "C"]
    assert acc.value == 2
