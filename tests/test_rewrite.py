"""Word simplification, shared n-grams, ordinals inside groups, and jobs on clean and empty tables."""

import re

from pyspark.sql import functions as F

from candor.operators import metrics as M
from candor.operators import report as RP
from candor.operators import rewrite as RW
from candor.operators.strategies import strategy_rows
from candor.plans import jobs as J

LINES = "doc_id LONG, line_no LONG, text STRING"
KEYS = ["doc_id", "line_no"]


def simplified(spark, dictionary, texts):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], LINES)
    return {r.line_no: (r.simplified, r.n_replaced) for r in RW.simplify_words(df, KEYS, dictionary).collect()}


def test_simplify_words_defines_duplicates_and_nulls(spark):
    pairs = [("With", "w/"), ("with", "using"), (None, "x"), ("this", None), ("utilize", "use")]
    got = simplified(spark, pairs, ["Utilize that with care,  With.", "", "no  hit"])
    want = {0: ("Use that using care, Using.", 3), 1: ("", 0), 2: ("no hit", 0)}
    assert got == want
    table = spark.createDataFrame(pairs, "word STRING, simpler STRING")
    assert simplified(spark, table, ["Utilize that with care,  With.", "", "no  hit"]) == want
    many = table.unionByName(spark.range(20000).select(F.concat(F.lit("w"), "id").alias("word"), F.lit("y").alias("simpler")))
    assert simplified(spark, many, ["Utilize that with care,  With.", "", "no  hit", "w19999!"]) == {**want, 3: ("y!", 1)}
    assert dict(RW.simplify_words(spark.createDataFrame([(1, 1, "with")], LINES), KEYS, table).dtypes)["n_replaced"] == "bigint"


def test_overlap_meets_the_reference_before_the_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "x a b c d"), (3, "nothing shared here at all"), (4, None), (1, "c d e f")], "doc_id LONG, text STRING")
    ref = spark.createDataFrame([(1, "A b  c d"), (2, "c d e f")], "item_id LONG, text STRING")
    for limit in (RW.MAX_REFERENCE_GRAMS, 0):
        monkeypatch.setattr(RW, "MAX_REFERENCE_GRAMS", limit)
        out = RW.corpus_overlap(docs, ref, 4)
        assert {r.doc_id: r.shared_ngrams for r in out.collect()} == {1: 2, 2: 1}
        plan = RW.corpus_overlap(docs, ref, 4)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("LeftSemi") > plan.index("Aggregate [doc_id")  # the join stands below the distinct
        scan_side = plan[plan.index("LeftSemi"):]
        assert "Aggregate [doc_id" not in scan_side


def test_ordinals_within_groups(spark):
    df = spark.createDataFrame([(g, k) for g in "aab" for k in (5, 3, 9)], "g STRING, k INT").distinct()
    got = sorted((r.g, r.ord, r.k) for r in RP.number_within(df, ["g"], ["k"]).collect())
    assert got == [(g, i + 1, k) for g in "ab" for i, k in enumerate((3, 5, 9))]


def test_all_passed_lists_clean_strategies(spark):
    good = "One two three four five six seven eight."
    df = spark.createDataFrame([(1, "greedy", good), (2, "greedy", good), (1, "beam", good), (2, "beam", "Short.")], "doc_id LONG, decoding STRING, output STRING")
    names = spark.createDataFrame([("greedy",), ("beam",), ("sampling",)], "decoding STRING")
    out = M.all_passed_strategies(names, M.failures_listed(df, keys=["doc_id"])).collect()
    assert sorted(r.decoding for r in out) == ["greedy", "sampling"]


def test_guarded_rewrites_and_report(spark):
    lines = spark.createDataFrame([(1, 1, "One two three four five six seven eight. Short one."), (1, 2, "Same."), (2, 1, "No end here")], LINES)
    g = J.guarded_rewrites(lines, KEYS, *strategy_rows(["guarded_beam", "guarded_sampling", "guarded_retry"]))
    rows = {(r.doc_id, r.line_no): r for r in g.collect()}
    assert rows[1, 2].notes == "too short; unchanged" and rows[1, 2].retried and rows[1, 2].retry_output == "Same." and not rows[1, 2].retry_passed
    assert all((r.retry_output is None) == r.passed for r in rows.values())
    m = M.guardrail_metrics(g)
    text = [r.line for r in RP.guard_metric_lines(m).orderBy("line_no").collect()]
    assert text[0].startswith("Beam pass-rate       : ") and text[4].endswith("case(s)") and len(text) == 6
    status = {r.line_no: r.status_line for r in RP.status_lines(g.where("doc_id = 1"), "line_no", "input", "output").collect()}
    assert status[2] == "02. beam_pass=False | words=01 | notes=too short; unchanged | retry_triggered"


def test_report_blocks(spark):
    rep = spark.createDataFrame([("beam", 2, 50.0, 9.5, "Fine."), ("sampling", 0, 0.0, 0.0, "x")], "decoding STRING, rows LONG, pass_pct DOUBLE, avg_tokens DOUBLE, reflection STRING")
    got = [r.line for r in RP.mini_report_lines(rep).orderBy("decoding", "line_no").collect()]
    assert got == ["=== Mini-report: beam ===", "Rows: 2", "Constraint pass rate: 50.0%", "Average tokens_out: 9.50", "Reflection: Fine.", "[sampling] No rows."]
    wide = spark.createDataFrame([(1, "a", " b", None)], "k INT, greedy STRING, beam STRING, sampling STRING")
    assert [r.line for r in RP.side_by_side_lines(wide, "k", ["greedy", "beam", "sampling"]).collect()] == ["01. [Greedy] a", "    [Beam]   b", "    [Sample] "]
    ev = spark.createDataFrame([("greedy", 12.34, 9.0, 1.25, 100.0)], "decoding STRING, pass_pct DOUBLE, avg_wc DOUBLE, std_wc DOUBLE, repeat_pct DOUBLE")
    assert RP.strategy_table_lines(ev).first().line == "Greedy       12.3    9.0    1.2    100.0"


def test_sentiment_job(spark):
    lines = spark.createDataFrame([(1, 1, "good day"), (1, 2, "bad day"), (1, 3, "other")], LINES)
    labelled = spark.createDataFrame([("good good", 1), ("bad bad", 0)], "text STRING, y INT")
    report, dist = J.sentiment_job(lines, KEYS, labelled)
    got = {r.line_no: (r.line, r.text_line) for r in report.collect()}
    assert got[1][0].startswith("01. raw=POSITIVE (0.") and got[1][1] == "    text: good day" and got[3][0].endswith("neutralized=NEUTRAL")
    assert [r.line for r in RP.distribution_lines(dist).collect()] == ["Raw distribution        : POS=2, NEG=1", "Neutralized distribution: POS=1, NEG=1, NEU=1"]


def test_jobs_on_empty_tables(spark):
    lines = spark.createDataFrame([], LINES)
    rows = strategy_rows(["guarded_beam", "guarded_sampling", "guarded_retry"])
    g = J.guarded_rewrites(lines, KEYS, *rows)
    assert g.count() == 0
    m = M.guardrail_metrics(g).first()
    assert (m.n, m.beam_pass_pct, m.retry_fix_pct) == (0, 0.0, 0.0)
    assert J.strategy_candidates(lines, KEYS, rows).count() == 0 and J.rewrite_candidates(lines, KEYS, rows).count() == 0
    report, dist = J.sentiment_job(lines, KEYS, spark.createDataFrame([], "text STRING, y INT"))
    assert report.count() == 0 and dist.first().n == 0
    assert RW.simplify_words(lines, KEYS, [("a", "b")]).count() == 0 and RP.number_within(lines, ["doc_id"], ["line_no"]).count() == 0


def shuffled(df):
    """Columns of each exchange of the plan."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [re.findall(r"(\w+)#", m) for m in re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[(.*?)\]", text)]


def test_texts_pass_one_exchange_however_many_strategies(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(1, 1, "One two. Three.")], LINES).repartition(2)
        found = []
        for n in (["greedy"], ["greedy", "beam", "sampling", "rewrite_sampling"]):
            plan = shuffled(J.strategy_candidates(docs, KEYS, strategy_rows(n)))
            assert len(plan) > 3
            found.append(sum(bool({"text", "_texts", "choices"} & set(cols)) for cols in plan if "_texts" in cols or "choices" in cols))
        assert found == [1, 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
