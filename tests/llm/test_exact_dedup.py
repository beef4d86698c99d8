import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candor.llm import exact_dedup as K


def plain(rows):
    """Rows of the contract for ``(doc_id, text)``, as sorted strings; of full repeats one stays."""
    groups = defaultdict(list)
    for at, (d, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d is None, d or 0, at, d))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:4])
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [str((m[4], members[0][4], len(members), i == 0, sha)) for i, m in enumerate(members)]
    return sorted(out)


def found(df):
    return sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in df.collect())


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2 ** 62 - 1), max_size=60), st.integers(0, 60))
def test_golomb_round_trip(values, shift):
    values = np.unique(np.array(sorted(values), dtype=np.int64) >> shift)
    k, code = K.golomb_encode(values)
    assert (K.golomb_decode(len(values), k, code) == values).all()


def test_golomb_size():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 30, 100_000))
    k, code = K.golomb_encode(values)
    assert len(code) * 8 <= len(values) * (np.log2((1 << 30) / len(values)) + 2)


ROWS = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a b"), (5, "ab"), (6, " a  b"), (6, " a  b"), (7, "a b"), (None, "xyz"), (None, "x y z"),
        (8, "xyz"), (-3, "x yz"), (9, "tie 1"), (10, "tie1 "), (11, "é漢😀"), (12, "é漢 😀"), (13, "long " * 50_000), (14, "long" * 50_000 + " "),
        (15, "Ab"), (None, None), (None, None), (16, "a\x85b"), (-2 ** 63, "edge"), (2 ** 63 - 1, "edge")]


def test_edges(spark):
    df = spark.createDataFrame(ROWS, "doc_id LONG, text STRING").withColumns({c: F.lit("x") for c in ("row", "fp", "sha", "hit", "norm", "word", "group_size")})
    assert found(K.exact_duplicates(df)) == plain(ROWS)
    assert found(K.exact_duplicates(df.repartition(7))) == plain(ROWS)
    assert K.exact_duplicates(spark.createDataFrame([], "doc_id LONG, text STRING")).count() == 0


@pytest.mark.parametrize("names", [{"BLOCK_ROWS": 37}, {"FILTER_BITS": 6}, {"SPARE_BITS": 0}, {"MAX_BROADCAST_GROUPS": -1, "HOT_SHARE": 10},
                                   {"SMALL_OWNER_KEYS": 8, "BLOCK_ROWS": 100}])
def test_blocks_owners_and_filters_change_nothing(spark, monkeypatch, names):
    """Hot group of a third of the rows, many small groups, uniques; blocks, owners, a full filter, shuffled groups."""
    for k, v in names.items():
        monkeypatch.setattr(K, k, v)
    rng = np.random.default_rng(5)
    rows = [(i, "hot text" + " " * int(rng.integers(0, 3))) for i in range(300)]
    rows += [(1000 + i, f"group {rng.integers(0, 120)}") for i in range(300)] + [(5000 + i, f"unique {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(5)
    assert found(K.exact_duplicates(df)) == plain(rows)


def test_all_repeats_are_suspected_and_few_others(spark):
    df = spark.range(40_000).select((F.col("id") % 30_000).alias("v")).select(F.xxhash64("v").alias("fp")).repartition(6).persist()
    keys, bits = K.suspected(df, 40_000)
    got = {r.key for r in keys.collect()}
    by_fp = {r.fp: r["count"] for r in df.groupBy("fp").count().collect()}
    repeated = {(f % 2 ** 64) >> (64 - bits) for f, n in by_fp.items() if n > 1}
    assert repeated <= got and len(got) < len(repeated) + 30_000 * 2 ** -8
