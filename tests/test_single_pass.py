"""Texts are made once where several passes need what is derived from them; large tables are kept as compressed columns."""

from pyspark.sql import functions as F


def counted(spark, n, make, kind):
    """``id, made`` with ``made`` from a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    def fn(i):
        calls.add(1)
        return make(i)

    return spark.range(n).select("id", F.udf(fn, kind).asNondeterministic()("id").alias("made")), calls


def test_ordered_csv_rows_are_made_once(spark, tmp_path):
    from candor.sources.csv_io import read_candidates_csv, write_candidates_csv

    df, calls = counted(spark, 200, lambda i: f"text {i:03d}.", "string")
    rows = df.select("id", F.col("made").alias("input"), F.lit("o").alias("output"), F.lit("beam").alias("decoding"), F.lit(2).alias("tokens_out"),
                     F.lit(True).alias("constraint_passed"), F.lit("").alias("notes"))
    write_candidates_csv(rows, str(tmp_path / "c"), order=["id"])
    assert calls.value == 200
    assert sorted(r.input for r in read_candidates_csv(spark, str(tmp_path / "c")).collect()) == [f"text {i:03d}." for i in range(200)]


def test_lengths_are_counted_once(spark):
    from candor.operators.length_buckets import assign

    df, calls = counted(spark, 120, lambda i: i % 17, "int")
    assert assign(df, ["id"], "made", 10, 3, 40).count() == 120 and calls.value == 120


def test_numbered_rows_are_made_once(spark):
    from candor.operators.report import number_within

    df, calls = counted(spark, 90, lambda i: "ab"[i % 2], "string")
    got = {(r.made, r.id): r.ord for r in number_within(df, ["made"], ["id"]).collect()}
    assert got == {("ab"[i % 2], i): i // 2 + 1 for i in range(90)} and calls.value == 90


def test_sentence_bounds_read_texts_once(spark):
    from candor.operators.sentence_bounds import learn

    df, calls = counted(spark, 60, lambda i: "Dr. Who met 3. Mann. The end. The start! x" if i % 3 else "", "string")
    learn(df.select(F.col("made").alias("text")))
    assert calls.value == 60


def test_a_weight_is_drawn_once(spark):
    from candor.operators.bootstrap import replicate_means

    rows = spark.createDataFrame([(1, "a", 2), (1, "b", 3)], "k INT, decoding STRING, n INT")
    plan = replicate_means(rows, ["k"], F.col("n"), replicates=3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1


def test_trigram_tables_are_columns(spark):
    from candor.operators import language_model as L

    model = L.train(spark.createDataFrame([("a b c",), ("a b d",)], "text STRING"))
    assert all(t.inputFiles() for t in (model.tri, model.bi, model.of_two))


def test_lists_meet_the_contexts_asked(spark):
    from candor.operators.generate import _with_lists

    lists = spark.range(1000).select((F.col("id") % 10).alias("u"), F.col("id").alias("v"), F.lit("x").alias("seen2"))
    asked = spark.createDataFrame([(1, 1), (2, 12), (7, 3), (1, 1)], "u LONG, v LONG")
    assert sorted(map(tuple, _with_lists(asked, lists, ["u", "v"]).collect()), key=str) == [(1, 1, "x"), (1, 1, "x"), (2, 12, "x"), (7, 3, None)]


def test_translation_passes_move_numbers(spark):
    from candor.operators.translate import _numbered

    pairs = spark.createDataFrame([(1, "a b a", "x"), (1, "a b a", "x"), (None, "c", "y"), (2, "", "z")], "k INT, a STRING, b STRING")
    words, seen = _numbered(pairs, ["k"], "a", "b")
    assert [f.dataType.typeName() for f in seen.schema] == ["long", "long", "long", "integer", "integer"]
    name = {r.id: r.word for r in words.collect()}
    rows = [(r.pair, name[r.s], name[r.t], r.n_s) for r in seen.collect()]
    assert len({r[0] for r in rows if r[2] == "x"}) == 1 and {r[0] for r in rows if r[2] == "y"} == {None}
    assert sorted((s, n) for _, s, t, n in rows if t == "x") == [("", 1)] * 2 + [("a", 2)] * 2 + [("b", 1)] * 2
