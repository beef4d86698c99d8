import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candor.llm import packing as K

FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
SF = "/root/testdata/sf0.001"


def expected_ids(texts):
    t = Tokenizer.from_file(FILES[0])
    return [e.ids + [2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_layout(rows):
    """Gapless sequences of at most 1024 ids; returns their number."""
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at and n > 0
            at += n
        assert at <= 1024
    return len(seqs)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = K.pack(docs, *FILES).collect()
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    ids = dict(zip((d for d, _ in given), expected_ids([t for _, t in given])))
    own = defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
    assert own.keys() == ids.keys()
    for d, pieces in own.items():
        pieces.sort(key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(pieces):
            part = np.array(ids[d][at:at + r.length], "<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(part))
            assert k == 0 or r.length == 1024
            at += r.length
        assert at == len(ids[d])
    least = -(-sum(map(len, ids.values())) // 1024)
    assert least <= check_layout(rows) <= least * 1.05


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "x <|endoftext|> y  \n z"), (None, "a b"), (None, "a b"), (5, "word " * 5000), (5, "word " * 5000),
            (6, "a" * 5000), (7, " " * 3000), (8, "é  b　c")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumn("piece", F.lit("x")).withColumn("shard", F.lit(1))
    out = K.pack(df, *FILES, with_ids=True).collect()
    got = sorted((str(r.doc_id), r.piece, r.ids) for r in out)
    want = []
    for (d, _), ids in zip(rows, expected_ids([t for _, t in rows])):
        want += [(str(d), k, ids[a:a + n]) for k, (a, n) in enumerate(K.cut_pieces(len(ids)))]
    assert got == sorted(want)
    check_layout(out)
    assert K.pack(spark.createDataFrame([], "doc_id LONG, text STRING"), *FILES).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_placement_is_the_least_sum_of_squares(seed):
    rng = np.random.default_rng(seed)
    lengths, cap = rng.integers(1, 21, 80), 20
    bin_of, offset = K.sum_of_squares(lengths, cap)
    fill = {}
    for s, b, o in zip(lengths, bin_of, offset):
        def squares(fills):
            gaps = np.bincount([cap - f for f in fills.values()], minlength=cap + 1)
            gaps[0] = gaps[cap] = 0
            return int((gaps ** 2).sum())
        options = [squares({**fill, k: f + s}) for k, f in [*fill.items(), ("new", 0)] if f + s <= cap]
        assert o == fill.get(b, 0)
        fill[b] = o + s
        assert squares(fill) == min(options)


def test_packing_is_close_to_the_bound():
    lengths = np.random.default_rng(0).integers(1, 1025, 30000)
    bin_of, offset = K.pack_shard(lengths)
    order = np.lexsort((offset, bin_of))
    ends = (offset + lengths)[order]
    same = bin_of[order][1:] == bin_of[order][:-1]
    assert (offset[order][1:][same] == ends[:-1][same]).all() and ends.max() <= 1024
    assert bin_of.max() + 1 <= 1.02 * lengths.sum() / 1024


def test_repeated_rows_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(K, "SHARD_PIECES", 100)
    df = spark.createDataFrame([(None, "")] * 800 + [(1, "same text")] * 200, "doc_id LONG, text STRING").repartition(4)
    rows = K.pack(df, *FILES).collect()
    check_layout(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.sequence_id % 10] += 1
    assert len(rows) == 1000 and len(sizes) == 10 and max(sizes.values()) < 200
