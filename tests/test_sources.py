"""Line sources: text files with per-file ordinals, also when files are split into many blocks."""

import os

from pyspark.sql import functions as F

from candor.sources.lines import read_lines, table_lines
from tests.conftest import FIXTURES


def test_read_lines_fixtures(spark):
    rows = {n: sorted((r.line_id, r.text) for r in read_lines(spark, os.path.join(FIXTURES, n)).collect()) for n in ("rewrite_lines.txt", "sentiment_lines.txt")}
    rewrite, sentiment = rows["rewrite_lines.txt"], rows["sentiment_lines.txt"]
    assert [i for i, _ in rewrite] == list(range(1, 11)) and [i for i, _ in sentiment] == list(range(1, 16))
    assert rewrite[0][1].startswith("Given the sudden change in schedule, the meeting originally planned")
    assert rewrite[9][1].endswith("because we spent too much time reviewing background material.")
    assert sentiment[:3] == [(1, "I absolutely loved the movie; the acting was brilliant."), (2, "The food at that restaurant was terrible and overpriced."),
                             (3, "Today is just an ordinary day, nothing special happened.")]
    assert sentiment[14] == (15, "The meeting is scheduled for 3 PM tomorrow.")


def test_ordinals_survive_block_splits(spark, tmp_path):
    p = tmp_path / "big.txt"
    lines = [("" if i % 7 == 0 else f"  line {i} text  ") for i in range(5000)]
    p.write_text("\n".join(lines), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_lines(spark, str(p))
        splits = spark.read.text(str(p)).select(F.col("_metadata.file_block_start")).distinct().count()
        assert splits > 10
        got = sorted((r.line_id, r.text) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(k, f"line {i} text") for k, i in enumerate((i for i in range(5000) if i % 7), start=1)]


def test_table_lines_breaks(spark):
    df = spark.createDataFrame([(1, "a\r\nb\rc\n\n  d   e")], "k INT, text STRING")
    got = [(r.line_no, r.text) for r in table_lines(df, ["k"]).orderBy("line_no").collect()]
    assert got == [(1, "a"), (2, "b"), (3, "c"), (4, "d   e")]  # ordinals of kept lines
