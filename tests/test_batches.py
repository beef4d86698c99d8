"""Token batches and distributed ordinals against brute force."""

import re

from pyspark.sql import functions as F

from candor import constants as K
from candor.operators.batches import assign_batches, batch_shapes, build_vocabulary, encode, pad_batches
from candor.plans.ordinals import global_row_number
from candor.sources.prompts import prompt_table

WORD = re.compile(r"[\w'-]*\w[\w'-]*")


def test_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(7)
    out = global_row_number(df, [F.col("v").desc()], partitions=5).collect()
    got = sorted((r.rn, r.v) for r in out)
    assert got == [(i + 1, 4999 - i) for i in range(5000)]


def test_vocabulary_encode_pad(spark):
    texts = ["the cat sat", "the dog", "", "a cat a cat the end", "x"] * 3
    df = spark.createDataFrame([(i // 5, i % 5 + 1, t) for i, t in enumerate(texts)], "doc INT, line INT, text STRING")
    vocab = {r.tok: r.id for r in build_vocabulary(df).collect()}
    counts = {}
    for t in texts:
        for w in WORD.findall(t.lower()):
            counts[w] = counts.get(w, 0) + 1
    order = sorted(counts, key=lambda w: (-counts[w], w))
    assert vocab == {w: i + 2 for i, w in enumerate(order)}
    enc = encode(df, ["doc", "line"], build_vocabulary(df), max_length=3)
    padded = pad_batches(assign_batches(enc, ["doc", "line"], 4), ["batch_no"]).collect()
    for r in padded:
        ids = [vocab[w] for w in WORD.findall(r.text.lower())]
        assert list(r.input_ids) == ids[:3] and r.n_tokens == len(ids)
        assert sum(r.attention_mask) == len(r.input_ids)
        assert len(r.padded_ids) == len(r.attention_mask) == r.batch_width
    order = sorted((r.doc, r.line, r.batch_no, r.pos_in_batch) for r in padded)
    assert [x[2:] for x in order] == [(i // 4, i % 4 + 1) for i in range(15)]
    shapes = batch_shapes(pad_batches(assign_batches(enc, ["doc", "line"], 4), ["batch_no"]), ["batch_no"]).collect()
    assert sorted(r.rows for r in shapes) == [3, 4, 4, 4]


def test_unknown_tokens_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, "known other"), (1, 2, ""), (1, 3, None)], "doc INT, line INT, text STRING")
    vocab = spark.createDataFrame([("known", 1, 5_000_000_000)], "tok STRING, cnt INT, id LONG")
    got = {r.line: list(r.input_ids) for r in encode(df, ["doc", "line"], vocab).collect()}
    assert got == {1: [5_000_000_000, 1], 2: [], 3: []}
    assert build_vocabulary(df.limit(0)).count() == 0 and assign_batches(df.limit(0), ["doc", "line"]).count() == 0


def test_prompt_set_to_one_padded_batch(spark):
    """The inline prompt set: prompts with the batch prefix, ids, one batch of twelve, padding and mask."""
    prompts = prompt_table(spark)
    rows = prompts.orderBy("prompt_id").collect()
    assert [r.prompt_id for r in rows] == list(range(1, 13)) and [r.family for r in rows] == [f for f, _ in K.PROMPT_SET]
    assert all(r.batch_prompt == K.BATCH_PREFIX + r.prompt for r in rows)
    texts = prompts.select("prompt_id", "batch_prompt")
    enc = encode(texts, ["prompt_id"], build_vocabulary(texts, "batch_prompt"), "batch_prompt")
    out = pad_batches(assign_batches(enc, ["prompt_id"], 12), ["batch_no"]).orderBy("prompt_id").collect()
    width = max(len(WORD.findall(r.batch_prompt.lower())) for r in rows)
    assert {r.batch_no for r in out} == {0} and {r.batch_width for r in out} == {width}
    assert [sum(r.attention_mask) for r in out] == [len(WORD.findall(r.batch_prompt.lower())) for r in rows]
    assert all(r.padded_ids[len(r.input_ids):] == [0] * (width - len(r.input_ids)) for r in out)
