"""The recorded candidate CSV: flags, notes and token counts recomputed; per-mode report."""

import os

from pyspark.sql import functions as F

from candor.functions import rules as R
from candor.functions import text as T
from candor.operators import metrics as M
from candor.sources.csv_io import read_candidates_csv, write_candidates_csv
from tests.conftest import FIXTURES

GOLDEN = os.path.join(FIXTURES, "golden_candidates.csv")


def test_recompute_golden(spark):
    g = read_candidates_csv(spark, GOLDEN)
    assert g.count() == 20
    passed, notes = R.annotate_unchanged("input", "output")
    out = g.select("*", T.ws_word_count("output").alias("wc"), passed.alias("p"), notes.alias("n")).collect()
    for r in out:
        assert r.wc == r.tokens_out
        assert r.p == r.constraint_passed
        assert r.n == r.notes


def test_mini_report_golden(spark):
    rep = {r.decoding: r for r in M.mini_report(read_candidates_csv(spark, GOLDEN)).collect()}
    assert rep["beam"].rows == 10 and abs(rep["beam"].pass_pct - 90.0) < 1e-9 and abs(rep["beam"].avg_tokens - 10.2) < 1e-9
    assert rep["sampling"].rows == 10 and abs(rep["sampling"].pass_pct - 100.0) < 1e-9
    assert abs(rep["sampling"].avg_tokens - 10.5) < 1e-9
    unchanged = read_candidates_csv(spark, GOLDEN).groupBy("decoding").agg(
        F.count_if(T.unchanged("output", "input")).alias("u")).collect()
    assert {r.decoding: r.u for r in unchanged} == {"beam": 9, "sampling": 10}


def test_csv_round_trip(spark, tmp_path):
    g = read_candidates_csv(spark, GOLDEN)
    path = str(tmp_path / "out")
    write_candidates_csv(g, path, single_file=True)
    back = read_candidates_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, g.collect()))
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))
    assert text.splitlines()[0] == "input,output,decoding,tokens_out,constraint_passed,notes"
    assert ",beam,7,False,too short" in text


def test_empty_rates(spark):
    empty = spark.createDataFrame([], "output STRING, decoding STRING")
    ev = {r.decoding: r for r in M.strategy_eval(empty, names=["greedy", "beam"]).collect()}
    assert ev["greedy"].pass_pct == 0.0 and ev["beam"].std_wc == 0.0
    g = spark.createDataFrame([(True, 9, True, 10, False, None)],
                              "passed BOOLEAN, words INT, sampled_passed BOOLEAN, sampled_words INT, retried BOOLEAN, retry_passed BOOLEAN")
    m = M.guardrail_metrics(g).first()
    assert m.retry_triggered == 0 and m.retry_fix_pct == 0.0


def test_csv_keeps_texts_and_order(spark, tmp_path):
    texts = ["", "  outer  ", 'quote " and ""', "back\\slash\\", "a,b", "'", "\\", "ü “x”", '"', "end\\\""]
    rows = [(i, t, t[::-1], "beam", i, i % 2 == 0, n) for i, (t, n) in enumerate(zip(texts, ["", "x; y"] * 5))]
    schema = "ord INT, input STRING, output STRING, decoding STRING, tokens_out INT, constraint_passed BOOLEAN, notes STRING"
    df = spark.createDataFrame(rows, schema).repartition(5)
    path = str(tmp_path / "one")
    write_candidates_csv(df, path, single_file=True, order=["ord"])
    back = [tuple(r) for r in read_candidates_csv(spark, path).collect()]
    assert back == [r[1:] for r in rows]
    odd = spark.createDataFrame([(1, None, None, "beam", 1, None, None)], schema)
    write_candidates_csv(odd, str(tmp_path / "two"))
    assert [tuple(r) for r in read_candidates_csv(spark, str(tmp_path / "two")).collect()] == [("", "", "beam", 1, None, "")]
    multi = spark.createDataFrame([(1, "a\nb", "c", "beam", 1, True, "")], schema)
    write_candidates_csv(multi, str(tmp_path / "three"))
    assert read_candidates_csv(spark, str(tmp_path / "three"), multi_line=True).first().input == "a\nb"
