"""A failing line is retried in a later batch, at most as often as its budget allows, and a restart neither loses nor repeats it."""

import pytest
from pyspark.sql import functions as F

from candor.functions import rules as R
from candor.functions import text as T
from candor.streaming import retry_stream as S
from candor.streaming.validate_stream import line_stream

GOOD = "This line has exactly eight words in it."
MENDED = "This line has eight good words in it. And a second sentence."
HOPELESS = "Too short. Really."


@pytest.fixture()
def disk_state(spark):
    keys = ["spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.noDataMicroBatches.enabled"]
    before = [spark.conf.get(k) for k in keys]
    S.use_disk_state(spark)
    yield spark
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def run(spark, src, sink, budget):
    lines = line_stream(spark, str(src))
    tries = S.attempts(lines, [F.col("text"), T.first_sentence("text", clean=True), F.concat(T.first_sentence("text", clean=True), F.lit(" "))], lambda o: R.check(o, "rewrite"))
    query = S.write_attempts(S.retried(tries, budget), str(sink))
    if not query.awaitTermination(60):
        query.stop()
        raise AssertionError("the run did not end")
    return spark.read.parquet(str(sink)).count()


def test_later_batch_once_and_over_a_restart(disk_state, tmp_path):
    spark, src, out = disk_state, tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.txt").write_text("\n".join([GOOD, MENDED, HOPELESS]), encoding="utf-8")
    assert run(spark, src, out, 1) == 3
    rows = spark.read.parquet(str(out)).collect()
    assert {(r.output, r.passed, r.final) for r in rows} == {(GOOD, True, True), (MENDED, False, False), (HOPELESS, False, False)}
    (src / "b.txt").write_text(GOOD, encoding="utf-8")  # the stream starts anew; the waiting lines are due
    assert run(spark, src, out, 1) == 6
    rows = spark.read.parquet(str(out)).where("attempt > 1").collect()
    assert {(r.output, r.attempt, r.passed, r.final) for r in rows} == {("This line has eight good words in it.", 2, True, True), ("Too short.", 2, False, True)}
    (src / "c.txt").write_text(GOOD, encoding="utf-8")
    assert run(spark, src, out, 1) == 7  # five first attempts, two retries, and never a third
