import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from candor.llm import prefix_viterbi as V

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pieces():
    return V.Pieces(PATH)


@pytest.fixture(scope="module")
def library():
    """The model with its type set to unigram: the library's n-best search then looks for the highest sums of scores."""
    m = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    sp = sentencepiece.SentencePieceProcessor()
    sp.LoadFromSerializedProto(m.SerializeToString())
    return sp


def test_words_of_the_table_score_as_in_the_library(spark, pieces, library):
    words = sorted({w for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() for w in r.text.split() if V.MARK not in w})

    def total(ids):
        return sum(library.get_score(int(i)) for i in ids)
    ours = pieces.encode(words)
    assert len(words) > 10000 and [pieces.decode(x) for x in ours] == words
    assert [total(x) for x in ours] == [total(library.nbest_encode_as_ids(w, 2)[0]) for w in words]


def test_scores_equal_all_segmentations(pieces):
    rng = random.Random(4)
    score = {}

    def walk(node, word):
        for k, v in node.items():
            if k == "":
                score[word] = v[0]
            else:
                walk(v, k + word)

    walk(pieces.ends, "")
    names = dict(enumerate(pieces.names))
    words = ["".join(rng.choice("▁aehtnrs\n①é") for _ in range(rng.randrange(1, 9))) for _ in range(150)]
    words = sorted({"▁" + w.replace("▁", "") for w in words})
    for word, ids in zip(words, pieces.encode_sorted(words)):
        def worth(cuts):
            parts = [word[a:b] for a, b in itertools.pairwise((0, *cuts, len(word)))]
            if any(p not in score and len(p) > 1 for p in parts):
                return -np.inf
            return sum(score.get(p, pieces.unknown) for p in parts)
        most = max(worth(c) for n in range(len(word)) for c in itertools.combinations(range(1, len(word)), n))
        got, k = 0.0, 0
        while k < len(ids):
            if ids[k] in pieces.byte_of:
                size = next(n for n in (1, 2, 3, 4) if _is_char(bytes(pieces.byte_of[i] for i in ids[k:k + n])))
                got, k = got + pieces.unknown, k + size
            else:
                got, k = got + score[names[ids[k]]], k + 1
        assert got == pytest.approx(most), word


def _is_char(raw):
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def test_round_trips(pieces):
    texts = ["", " ", "  a  b ", "a\n\tb", "①②é\x00😀", "x" * 3000, "a " * 20000, "<s> <0x41> <unk>"]
    assert [pieces.decode(x) for x in pieces.encode(texts)] == texts


def test_table_and_edges(spark, pieces):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (7000, None), (7001, ""), (7002, "a▁b"), (7003, "y" * 50000)], "doc_id LONG, text STRING")
    both = docs.unionByName(odd).withColumn("ids", F.lit("x")).withColumn("decoded_equal", F.lit(1))
    out = V.encode(both, PATH)
    want = sorted(((str(r.doc_id), ids.tolist(), zlib.crc32(ids.astype("<u4").tobytes()), "▁" not in (r.text or ""))
                   for r in both.collect() for ids in pieces.encode([r.text or ""])))
    assert sorted((str(r.doc_id), r.ids, r.ids_crc32, r.decoded_equal) for r in out.collect()) == want
    back = V.decode(out.select("doc_id", "ids"), PATH).where("doc_id < 7000")
    assert back.exceptAll(docs.join(out.select("doc_id", "ids"), "doc_id").select("doc_id", "ids", "text")).count() == 0
    assert V.encode(odd.limit(0), PATH).count() == 0


def test_words_met_before_are_not_searched_again(pieces, monkeypatch):
    first, second = ["the cat  sat", " the mat"], ["the mat", "", "a  cat ▁sat", "  the cat "]
    want = [V.Pieces(PATH).encode([t])[0].tolist() for t in second]
    fresh, searched = V.Pieces(PATH), []
    monkeypatch.setattr(V.Pieces, "encode_sorted", lambda self, words, search=V.Pieces.encode_sorted: searched.append(words) or search(self, words))
    fresh.encode(first)
    assert [x.tolist() for x in fresh.encode(second)] == want
    assert [sorted(w) for w in searched] == [["▁cat", "▁mat", "▁the", "▁▁sat", "▁▁the"], ["▁", "▁a", "▁▁cat", "▁▁▁the"]]
    monkeypatch.setattr(V, "KEPT_WORDS", 1)
    monkeypatch.setattr(V, "KEPT_ENDS", 1)
    assert [x.tolist() for x in fresh.encode(second)] == want and len(searched[-1]) == len(fresh.ids_of)
