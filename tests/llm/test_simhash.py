import hashlib
import random

from pyspark.sql import functions as F

from candor.llm import simhash as S

SF = "/root/testdata/sf0.001"


def edited_of(rows):
    """{(doc_id, text): edited} for distinct rows with different ids."""
    order = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        k = len(t) // 3
        out[d, t] = t[:len(t) - k] + nxt[:k]
    return out


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = {d: (len(t), hashlib.sha256(e.encode()).hexdigest()) for (d, t), e in edited_of(given).items()}
    got = S.fingerprint_documents(docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want and len(got) == len(given)
    by_id = {r.doc_id: r for r in got}
    order = sorted(by_id, reverse=True)
    for i, d in enumerate(order):
        r, nxt = by_id[d], by_id[order[(i + 1) % len(order)]]
        def same(x, y):
            return 1 - (int(x, 16) ^ int(y, 16)).bit_count() / 128
        assert r.near_edited == same(r.fingerprint, r.edited_fingerprint) and r.near_next == same(r.fingerprint, nxt.fingerprint)
        if d % 50 == 0:
            assert r.n_near == sum((int(r.fingerprint, 16) ^ int(x.fingerprint, 16)).bit_count() <= S.RADIUS for x in got) - 1
        else:
            assert r.n_near is None
    texts = dict(given)
    prints = {}
    for d, r in by_id.items():
        assert prints.setdefault(texts[d], r.fingerprint) == r.fingerprint
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)


def test_votes(spark):
    """Against a plain count of weighted bits, with the term hashes Spark computes."""
    text = "The cat sat on the mat, the cat ran. " * 3 + "\n Öl und Wasser"
    df = spark.createDataFrame([(1, text)], "k LONG, text STRING")
    rows = df.select(F.explode(S.terms(F.col("text"))).alias("term")).selectExpr("term", "xxhash64(term) h0", "xxhash64(term, 1) h1").collect()
    found = [r.term for r in rows]
    assert found[:3] == ["the cat", "cat sat", "sat on"] and found[-1] == "wasser" and len(set(found)) == len(found) == 12
    weight = [min(max(len(t) - 3, 1), S.MAX_WEIGHT) for t in found]
    got = S.fingerprints(df, ["k"]).first()
    for name, fp in (("h0", got.fp0), ("h1", got.fp1)):
        want = 0
        for j in range(64):
            votes = sum(w for r, w in zip(rows, weight) if r[name] >> j & 1)
            want |= (2 * votes > sum(weight)) << j
        assert fp % (1 << 64) == want


def test_edges(spark):
    rows = [(5, None), (4, ""), (3, " \n"), (2, "ab"), (1, "é" * 10), (None, "null id"), (7, "x y z"), (7, "x y z"), (9, "long words here " * 9000), (0, "q")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumn("edited", F.lit(1)).withColumn("h1", F.lit("a")).withColumn("n_chars", F.lit(0))
    got = S.fingerprint_documents(df).collect()
    want = edited_of(rows)
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(
        (str(d), len(t or ""), hashlib.sha256(want[d, t or ""].encode()).hexdigest()) for d, t in rows)
    assert {r.fingerprint for r in got if r.doc_id in (3, 4, 5)} == {"0" * 32}
    single = S.fingerprint_documents(spark.createDataFrame([(1, "abcdef")], "doc_id LONG, text STRING")).collect()
    assert [r.edited_sha256 for r in single] == [hashlib.sha256(b"abcdab").hexdigest()]
    assert S.fingerprint_documents(spark.createDataFrame([], "doc_id LONG, text STRING")).count() == 0


def test_near_counts_equal_all_pairs(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(128) for _ in range(60)]
    fps = [b ^ sum(1 << k for k in rng.sample(range(128), rng.randrange(6))) for b in base for _ in range(8)] + base[:5] * 3
    halves = [tuple(S._signed(x >> s & ((1 << 64) - 1)) for s in (0, 64)) for x in fps]
    df = spark.createDataFrame(halves, "fp0 LONG, fp1 LONG")
    got = {(r.fp0, r.fp1): r.n_near for r in S.near_counts(df, df).collect()}
    assert got == {h: sum((x ^ y).bit_count() <= S.RADIUS for y in fps) for h, x in zip(halves, fps)}
    wide = {(r.fp0, r.fp1): r.n_near for r in S.near_counts(df, df, 8, 11).collect()}
    assert wide == {h: sum((x ^ y).bit_count() <= 8 for y in fps) for h, x in zip(halves, fps)}


def test_near_copies_are_found(spark):
    """Texts of 300 words of which one to four are changed (five-word similarity 0.88 or more)."""
    rng = random.Random(8)
    rows = []
    for i in range(40):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
        rows.append((100 * i, " ".join(words)))
        for k in rng.sample(range(300), 1 + i % 4):
            words[k] = "changed" + words[k]
        rows.append((100 * i + 1, " ".join(words)))
    got = S.fingerprint_documents(spark.createDataFrame(rows, "doc_id LONG, text STRING")).where("doc_id % 50 = 0").collect()
    assert len(got) == 40 and sum(r.n_near == 1 for r in got) >= 38 and max(r.n_near for r in got) == 1


def test_blocks_with_unequal_tolerances(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(128) for _ in range(20)]
    fps = [b ^ sum(1 << k for k in rng.sample(range(128), rng.randrange(26))) for b in base for _ in range(10)]
    halves = [tuple(S._signed(x >> s & ((1 << 64) - 1)) for s in (0, 64)) for x in fps]
    df = spark.createDataFrame(halves, "fp0 LONG, fp1 LONG")
    for radius, blocks in ((0, 2), (5, 3), (12, 7)):
        got = {(r.fp0, r.fp1): r.n_near for r in S.near_counts(df, df, radius, blocks).collect()}
        assert got == {h: sum((x ^ y).bit_count() <= radius for y in fps) for h, x in zip(halves, fps)}


def test_repeated_rows_vote_once(spark):
    rows = [(1, "one text here"), (1, "other text")] + [(2, "the same again")] * 5 + [(None, None)] * 3
    pairs = S.edited_pairs(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert sorted((str(r.doc_id), r.text, r.copies) for r in pairs) == [
        ("1", "one text here", 1), ("1", "other text", 1), ("2", "the same again", 5), ("None", "", 3)]
