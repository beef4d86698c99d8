"""The stream applies the same rules as the batch path, and goes on after a restart."""

from pyspark.sql import functions as F

from candor.functions import rules as R
from candor.streaming.validate_stream import latest_rates, line_stream, running_pass_rates, validate_stream, write_rates, write_validated


def run(spark, src, sink):
    write_validated(validate_stream(line_stream(spark, str(src))), str(sink)).awaitTermination(120)
    return sorted((r.file.rsplit("/", 1)[-1], r.line_no, r.text) for r in spark.read.parquet(str(sink)).collect())


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    texts = ["This line has exactly eight words in it.", "Short one.", "No period here at all friends of mine ok", "Wait... what?"]
    (src / "a.txt").write_text(f"{texts[0]}\n\n{texts[1]}\n", encoding="utf-8")
    (src / "b.txt").write_text(f"{texts[2]}\n  {texts[3]}\n", encoding="utf-8")
    assert run(spark, src, tmp_path / "out") == [("a.txt", 1, texts[0]), ("a.txt", 2, texts[1]), ("b.txt", 1, texts[2]), ("b.txt", 2, texts[3])]
    passed, notes = R.check(F.col("text"), "split_words")
    batch = spark.createDataFrame([(t,) for t in texts], "text STRING").select("text", passed.alias("passed"), notes.alias("notes"))
    got = spark.read.parquet(str(tmp_path / "out")).select("text", "passed", "notes")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_a_restarted_stream_takes_new_files_once(spark, tmp_path):
    src, out, rates = tmp_path / "in", tmp_path / "out", tmp_path / "rates"
    src.mkdir()
    want = []
    for i, name in enumerate(["a.txt", "b.txt", "c.txt"]):
        (src / name).write_text(f"Line {i} of a file.\n", encoding="utf-8")
        want.append((name, 1, f"Line {i} of a file."))
        assert run(spark, src, out) == want
        write_rates(running_pass_rates(validate_stream(line_stream(spark, str(src)))), str(rates)).awaitTermination(120)
        r = latest_rates(spark, str(rates)).first()
        assert (r.rows, r.passed) == (i + 1, 0)
