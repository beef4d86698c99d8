"""The pipeline against plain Python versions of its stages."""

import zlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from candor.llm import langid, pii
from tests.llm.test_hyperminhash import brute as components
from tests.llm.test_pii import brute as base_spans

SF = "/root/testdata/sf0.001"


def test_stages_on_the_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, None, None, None), (9001, "", "en", "s", 0), (9002, "12 !", "en", "s", 4), (None, None, None, None, None)],
                                docs.schema)
    docs = docs.unionByName(odd)
    names = [n for n, _ in P.STAGES]
    assert names == ["languages", "near_copies", "personal_data", "packed"]
    model = langid.fit(docs)
    pred = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    given = docs.collect()
    want = {r.doc_id: r.text for r in given if pred[r.doc_id].score >= langid.MIN_SCORE}
    assert {r.doc_id for r in given} - want.keys() == {None, 9000, 9001, 9002}

    one = P.languages(spark, docs, SF)
    assert one.columns == docs.columns
    assert {r.doc_id: (r.text, r.lang) for r in one.collect()} == {d: (t, pred[d].lang_pred) for d, t in want.items()}

    two = P.near_copies(spark, one, SF)
    assert two.schema.fieldNames() == docs.columns
    want = {d: want[d] for d, _, _, kept in components(list(want.items()), P.NEAR_PERCENT) if kept}
    assert {r.doc_id: r.text for r in two.collect()} == want

    three = P.personal_data(spark, two, SF)
    assert three.columns == docs.columns
    got = {r.doc_id: r for r in three.collect()}
    for d, t in want.items():
        for a, b, kind in base_spans(t):
            assert t[a:b] not in got[d].text
        assert got[d].text == pii.redact(t, pii.find_spans(t, pii.automaton())) and got[d].n_chars == len(got[d].text)

    four = P.packed(spark, three, SF).collect()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in four:
        ids = t.encode(got[r.doc_id].text, add_special_tokens=False).ids + [2]
        part = ids[r.start:r.start + r.length]
        assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)) == r.ids_crc32
    assert {r.doc_id for r in four} == want.keys()


def test_run_equals_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = P.run(spark, SF)
    step = docs
    for _, stage in P.STAGES:
        step = stage(spark, step, SF)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert out.select(cols).exceptAll(step.select(cols)).count() == 0 and out.count() == step.count()


def test_one_row_of_repeated_rows_stays(spark):
    rows = [(1, "a b c d e f g", "en", "s", 13)] * 3 + [(2, "a b c d e f g", "en", "s", 13), (3, "", "en", "s", 0), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    assert sorted(r.doc_id for r in P.near_copies(spark, docs, SF).collect()) == [1, 3, 3]


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
