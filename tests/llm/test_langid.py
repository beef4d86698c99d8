import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from candor.llm import langid as L

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id LONG, text STRING, lang STRING"
EN = "the house and the river with that thing from them which those there while"
FR = "la maison et le fleuve avec cela chose pour eux lesquels ceux alors quand"
RU = "дом и река с этой вещью для них которые те там пока"


def training(n=40):
    rows = []
    for i in range(n):
        for j, (text, lang) in enumerate(((EN, "en"), (FR, "fr"), (RU, "ru"))):
            rows.append((3 * i + j, text, lang))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.createDataFrame(training(), SCHEMA))


def rows(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    return L.predict(df, model).orderBy("doc_id").collect()


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(0)
    counts = np.array([0, 5, 1, 4, 6])
    scores = rng.normal(size=(counts.sum(), 3)) * 3
    begins = np.cumsum(counts) - counts
    label = L.viterbi(scores, begins, counts, 2.5)
    for b, n in zip(begins, counts):
        def worth(path):
            return sum(scores[b + i, k] for i, k in enumerate(path)) - 2.5 * sum(x != y for x, y in itertools.pairwise(path))
        if n:
            assert worth(label[b:b + n]) == pytest.approx(max(map(worth, itertools.product(range(3), repeat=int(n)))))


def test_spans_of_mixed_text(spark, model):
    text = f"{EN}. {FR}! {RU}"
    got = rows(spark, model, [text, EN, RU])
    assert [(s.start, s.end, s.lang) for s in got[0].spans] == [
        (0, len(EN), "en"), (len(EN) + 2, len(EN) + 2 + len(FR), "fr"), (len(EN) + len(FR) + 4, len(text), "ru")]
    assert [(r.lang_pred, r.score) for r in got[1:]] == [("en", 1.0), ("ru", 1.0)]


def test_edges(spark, model):
    got = rows(spark, model, [None, "", "12 34 !?", "汉字", "THE HOUSE", "the " * 30000, "x" * 50000, "ǅ ﬁ ß"])
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3 and all(r.spans == [] for r in got[:3])
    assert got[3].lang_pred in model.langs
    assert [r.lang_pred for r in got[4:6]] == ["en", "en"] and len(got[5].spans) == 1
    assert all(0 <= r.score <= 1 for r in got)
    none = L.fit(spark.createDataFrame([], SCHEMA))
    assert [r.lang_pred for r in rows(spark, none, ["the house"])] == ["und"]
    odd = spark.createDataFrame([(None, "the house", "q", 1), (None, "the house", "q", 1)], "doc_id LONG, text STRING, score STRING, held_out INT")
    assert [(r.doc_id, r.held_out, r.lang_pred) for r in L.predict(odd, model).collect()] == [(None, False, "en")] * 2
    assert L.predict(spark.createDataFrame([], "doc_id LONG, text STRING"), model).count() == 0


def test_held_out_rows_are_not_learned_from(spark):
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, EN, "wrong") for i in out] + [(i, EN, "en") for i in range(200) if i not in out] + [(300, None, "fr"), (301, FR, None)]
    m = L.fit(spark.createDataFrame(rows, SCHEMA))
    assert m.langs == ["en"]


def test_held_out_accuracy_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pred = L.predict(docs, L.fit(docs)).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = pred.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.98


def test_marks_belong_to_the_letter_before():
    from candor.llm.langid import Alphabet, find_words

    texts = ["हिन्दी भाषा", "e\u0301te\u0301 x", "\u0301a", "1\u0301 b", "", "காலை"]
    w = find_words(texts, Alphabet())
    got = {(t, texts[t][s:e]) for t, s, e in zip(w.text.tolist(), w.start.tolist(), w.end.tolist())}
    assert got == {(0, "हिन्दी"), (0, "भाषा"), (1, "e\u0301te\u0301"), (1, "x"), (2, "a"), (3, "b"), (5, "காலை")}
