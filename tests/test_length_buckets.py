from collections import defaultdict

from pyspark.sql import functions as F

from candor.operators import length_buckets as B


def test_every_row_once_within_budget(spark):
    n = 3000
    df = spark.range(n).select("id", (F.pmod(F.xxhash64("id"), F.lit(200))).cast("int").alias("len"))
    rows = B.assign(df, ["id"], "len", 128, buckets=6, token_budget=500).collect()
    assert sorted(r.id for r in rows) == list(range(n))
    given = {r.id: r.len for r in df.collect()}
    batches = defaultdict(list)
    widths = defaultdict(set)
    for r in rows:
        assert r.length == min(given[r.id], 128)
        batches[r.bucket, r.batch_no].append(r)
        widths[r.bucket].add(r.length)
    for (bucket, _), own in batches.items():
        assert sorted(r.pos_in_batch for r in own) == list(range(1, len(own) + 1))
        assert len(own) == 1 or len(own) * max(r.length for r in own) <= 500
        assert {r.bucket_width for r in own} == {max(widths[bucket])}
    assert max(widths[0]) < min(widths[max(widths)])
    again = B.assign(df.repartition(7), ["id"], "len", 128, buckets=6, token_budget=500).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    other = B.assign(df, ["id"], "len", 128, buckets=6, token_budget=500, seed=7).collect()
    assert sorted(map(str, rows)) != sorted(map(str, other))


def test_padding_is_halved(spark):
    """Against batches of as many consecutive rows."""
    df = spark.range(4000).select("id", (1 + F.floor(60 * F.pow(F.rand(1), F.lit(3)))).cast("int").alias("len")).persist()
    room = B.shapes(B.assign(df, ["id"], "len", 128, 8, 512)).agg(F.sum(F.col("rows") * F.col("width")), F.sum("tokens")).first()
    plain = df.groupBy(F.floor(F.col("id") / 16)).agg(F.max("len").alias("w"), F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("w") * F.col("n"))).first()[0]
    tokens = room[1]
    assert room[0] - tokens <= (plain - tokens) / 2


def test_edges(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 500), (4, 0), (5, -1)], "id INT, len INT")
    got = {r.id: (r.length, r.bucket_width) for r in B.assign(df, ["id"], "len", 128, token_budget=10).collect()}
    assert got.keys() == {1, 3, 4, 5} and got[3] == (128, 128) and got[1][0] == got[5][0] == 0
    assert B.assign(df.limit(0), ["id"], "len", 128).count() == 0
    assert {r.padding_share for r in B.shapes(B.assign(df.where("len = 0"), ["id"], "len", 128)).collect()} == {0.0}
