import datetime as dt
import random

from pyspark.sql import functions as F

from candor.llm import url_lists as U

D = dt.date
ENTRIES = "pattern STRING, category STRING, day DATE, listed BOOLEAN"
CAPTURES = "page_id LONG, url STRING, fetched_on DATE"


def brute(captures, entries):
    out = []
    for key, host, day in captures:
        active = set()
        for pattern, cat in {(p, c) for p, c, *_ in entries}:
            if host and day and (host == pattern or host.endswith("." + pattern)):
                past = [(d, not on) for p, c, d, on in entries if (p, c) == (pattern, cat) and d <= day]
                if past and not max(past)[1]:
                    active.add((pattern, cat))
        out.append((key, bool(active), ",".join(sorted({c for _, c in active})), max((p for p, _ in active), key=len, default=None)))
    return sorted(out, key=str)


def run(spark, captures, entries):
    caps = spark.createDataFrame(captures, CAPTURES).withColumn("host", F.lit(1)).withColumn("pattern", F.lit(1)).withColumn("spans", F.lit(1))
    got = U.evaluate(caps, spark.createDataFrame(entries, ENTRIES).withColumn("valid_from", F.lit(1)))
    return sorted(((r.page_id, r.blocked, r.categories, r.pattern) for r in got.collect()), key=str)


def test_random_lists_equal_a_plain_look_up(spark, monkeypatch):
    rng = random.Random(2)
    domains = ["com", "a.com", "b.a.com", "c.b.a.com", "x.org", "y.x.org", "hot.net"]
    def day():
        return D(2020, 1, 1) + dt.timedelta(rng.randrange(40))
    entries = [(rng.choice(domains), rng.choice("pq"), day(), rng.random() < 0.6) for _ in range(120)]
    entries += entries[:10]
    caps = [(i, rng.choice([*domains, *["hot.net"] * 10, "z.y.x.org"]), day()) for i in range(300)]
    urls = [(k, f"HTTPS://u@{h.upper()}.:80/p?x=http://a.com", d) for k, h, d in caps]
    assert run(spark, urls, entries) == brute(caps, entries)
    monkeypatch.setattr(U, "MAX_BROADCAST_SPANS", 0)
    assert run(spark, urls, entries) == brute(caps, entries)


def test_edges(spark):
    entries = [("a.com", "p", D(2020, 1, 1), True), (None, "p", D(2020, 1, 1), True), ("a.com", None, D(2020, 1, 1), True), ("b.com", "p", None, True)]
    caps = [(1, None, D(2021, 1, 1)), (2, "http://a.com", None), (3, "", D(2021, 1, 1)), (4, "a.com/x", D(2021, 1, 1)), (None, "http://a.com", D(2020, 1, 1)),
            (5, "http://a.com", D(2019, 12, 31)), (6, "http://nota.com/", D(2020, 1, 1)), (7, "http://" + "l." * 60 + "a.com/" + "x" * 100000, D(2020, 1, 1))]
    got = run(spark, caps + caps[-1:], entries)
    assert [g[0] for g in got if g[1]] == [7, 7, None]
    assert run(spark, [], entries) == [] and all(not g[1] for g in run(spark, caps, []))
    steps = [("a.com", "p", D(2020, 1, 1), True), ("a.com", "p", D(2020, 1, 5), False), ("a.com", "p", D(2020, 1, 5), True), ("a.com", "p", D(2020, 1, 9), True)]
    days = [(d, "http://a.com", D(2020, 1, d)) for d in (1, 4, 5, 8, 9)]
    assert [g[:2] for g in run(spark, days, steps)] == [(1, True), (4, True), (5, False), (8, False), (9, True)]


HOSTS = [("http://[2001:db8::1]/x", "[2001:db8::1]"), ("http://[::1]:8080", "[::1]"), ("http://a@b@evil.com/", "evil.com"), ("http://u:p@Host.ORG.:80?q", "host.org"),
         ("http://10.0.0.1:8/x", "10.0.0.1"), ("http://good.com\\@evil.com", "good.com"), ("http://good.com/@evil.com", "good.com"), ("http://good.com#@evil.com", "good.com"),
         ("http://", None), ("http://:80/", None), ("http://[broken/x", None), ("//a.com", None), ("ftp+x.y-1://a_b.c", "a_b.c"), ("http://bücher.de/ü", "bücher.de"), (None, None)]


def test_hosts(spark):
    df = spark.createDataFrame([(u, h) for u, h in HOSTS], "url STRING, want STRING")
    for r in df.select("url", "want", U.host_of(F.col("url")).alias("host")).collect():
        assert r.host == r.want, r


def test_addresses_have_no_parents(spark):
    df = spark.createDataFrame([("10.0.0.1",), ("[::1]",), ("1.2.3.com",), ("b.a.com",)], "host STRING")
    got = {r.host: r.p for r in df.select("host", U.parent_domains(F.col("host")).alias("p")).collect()}
    assert got == {"10.0.0.1": ["10.0.0.1"], "[::1]": ["[::1]"], "1.2.3.com": ["1.2.3.com", "2.3.com", "3.com", "com"], "b.a.com": ["b.a.com", "a.com", "com"]}
    entries = [("1", "p", D(2020, 1, 1), True), ("0.0.1", "p", D(2020, 1, 1), True), ("evil.com", "p", D(2020, 1, 1), True), ("[::1]", "q", D(2020, 1, 1), True)]
    caps = [(1, "http://10.0.0.1/", D(2021, 1, 1)), (2, "http://a@b@evil.com/", D(2021, 1, 1)), (3, "http://[::1]:80/", D(2021, 1, 1))]
    assert [g[:3] for g in run(spark, caps, entries)] == [(1, False, ""), (2, True, "p"), (3, True, "q")]
