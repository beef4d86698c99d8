import random

import pytest
from pyspark.sql import functions as F

from candor.llm import fixity as X

SCHEMA = "page_id LONG, file_no LONG, offset LONG, record STRING"


def archive(n, files=3):
    rng, rows = random.Random(1), []
    for f in range(files):
        at = 0
        for i in range(n):
            record = f"{f}-{i}-" + "é" * rng.randrange(40)
            rows.append((f * n + i, f, at, record))
            at += len(record.encode())
    return rows


def brute(a, b):
    def by_place(rows):
        out = {}
        for k, f, o, r in rows:
            if None not in (f, o, r):
                out.setdefault((f, o), []).append((len(r.encode()), r, k))
        return out
    x, y, out = by_place(a), by_place(b), set()
    for place in x.keys() | y.keys():
        p, q = (sorted(s[:2] for s in z.get(place, [])) for z in (x, y))
        if p != q:
            n, m = (sum(s[0] for s in z) if z else None for z in (p, q))
            status = "missing" if not q else "extra" if not p else "truncated" if m < n else "changed"
            out.add((min(s[2] for s in (x.get(place) or y[place])), *place, n, m, status))
    return out


def run(spark, a, b):
    df = lambda rows: spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("x")).withColumn("length", F.lit("y"))
    return {tuple(r) for r in X.audit(X.digests(df(a)), X.digests(df(b))).collect()}


@pytest.mark.parametrize("leaf", [64, 1 << 18])
def test_all_kinds_of_damage(spark, monkeypatch, leaf):
    monkeypatch.setattr(X, "LEAF_BYTES", leaf)
    a = archive(60)
    b = list(a)
    b[5] = (*b[5][:3], "~" + b[5][3][1:])
    b[70] = (*b[70][:3], b[70][3][:2])
    del b[100]
    b.append((999, 2, 10 ** 5, "extra at the end"))
    b.append((998, 4, 0, "extra file"))
    got = run(spark, a, b)
    assert got == brute(a, b) and {g[-1] for g in got} == {"missing", "extra", "truncated", "changed"}


def test_equal_and_empty(spark):
    a = archive(20)
    assert run(spark, a, list(reversed(a))) == set() == run(spark, [], [])
    assert run(spark, a, []) == brute(a, [])
    twice = a + [a[3], (7, None, None, "no place"), (8, 0, 0, None)]
    assert run(spark, twice, a) == brute(twice, a)


def test_only_differing_branches_are_read(spark, monkeypatch):
    monkeypatch.setattr(X, "LEAF_BYTES", 64)
    a = archive(200)
    b = [(*r[:3], r[3] + "!") if r[0] == 50 else r for r in a]
    df = lambda rows: X.digests(spark.createDataFrame(rows, SCHEMA))
    ta, tb = X.tree(df(a), 256, 3), X.tree(df(b), 256, 3)
    bad = None
    for la, lb in zip(reversed(ta), reversed(tb)):
        bad = X.differing(la, lb, bad)
        assert bad.count() == 1


def test_records_of_odd_pages(spark):
    rows = [(2, "u", "x" * 300000), (1, None, None), (None, "u", "é"), (2, "u", "x" * 300000), (1, "a", "")]
    df = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").withColumn("record", F.lit(1)).withColumn("h1", F.lit("a"))
    records = X.warc_records(df)
    sizes = {(r.h1, r.h2): len(r.record.encode()) for r in records.collect()}
    out = X.archive(records).orderBy("offset").collect()
    at = 0
    for r in out:
        assert r.file_no == 0 and r.offset == at and r.length == sizes[r.h1, r.h2]
        at += r.length
    assert [r.page_id for r in out] == [1, 1, 2, 2, None]
    manifest = X.archive(records)
    assert X.audit(manifest, X.replica(records, manifest)).count() == 0
    assert X.archive(X.warc_records(df.limit(0))).count() == 0


def test_lost_copies_and_extra_records(spark, monkeypatch):
    monkeypatch.setattr(X, "FILE_RECORDS", 3)
    pages = [(1, "u", "a"), (1, "u", "a"), (2, "u", "bb"), (3, "u", "c"), (4, "u", "d" * 99), (5, "u", "e"), (None, None, None)]
    records = X.warc_records(spark.createDataFrame(pages, "page_id LONG, url STRING, html STRING"))
    manifest = X.archive(records).checkpoint()
    rows = sorted(records.collect(), key=str)
    frame = lambda some: spark.createDataFrame(some, records.schema)
    one = [r for r in rows if r.page_id == 1]
    audit = lambda some: sorted(((r.page_id, r.status) for r in X.audit(manifest, X.replica(frame(some), manifest)).collect()), key=str)
    assert audit(rows) == [] == audit(rows[::-1])
    assert audit([r for r in rows if r is not one[0]]) == [(1, "missing")]
    assert audit(rows + one[:1]) == [(1, "extra")]
    stranger = one[0].asDict() | {"page_id": 77, "h1": 5, "record": "other"}
    assert audit([*rows, tuple(stranger.values())]) == [(77, "extra")]
    short = [r if r.page_id != 2 else tuple((r.asDict() | {"record": r.record[:-3]}).values()) for r in rows]
    assert audit(short) == [(2, "truncated")]  # the records behind it have not moved
    assert len(audit([])) == len(rows)
    nothing = X.archive(records.limit(0))
    assert {r.status for r in X.audit(nothing, X.replica(frame(rows), nothing)).collect()} == {"extra"}
