import hashlib
import random
import re

from pyspark.sql import functions as F

from candor.llm import pii

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(ds):
    doubled = [int(c) for c in ds[::-1]]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(doubled)) % 10 == 0


def brute(text):
    out = []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            ds = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                    "card": 14 <= len(ds) <= 19 and luhn(ds), "phone": 10 <= len(ds) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def base(text):
    return [s for s in pii.find_spans(text, pii.automaton()) if s[2] in pii.BASE]


def test_base_spans_equal_the_patterns_on_random_strings():
    rng = random.Random(5)
    a = pii.automaton()
    for alphabet in ("a.@-1", "12. -+()", "0123456789 -.", "ab@.%+ é1", "1.", "+1 (", "255.0x", "@a."):
        for _ in range(4000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert [s for s in pii.find_spans(t, a) if s[2] in pii.BASE] == brute(t), t


def test_base_spans_with_planted_values():
    rng = random.Random(6)
    bits = ["4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", "+1 (483) 555-1712", "+44.20.7946.0958", "93.81.200.107", "1.2.3.4.5.6.7.8.9",
            "256.1.1.1", "x.y+z@a-b.example.com", "a@b@c.de", "@", "www", "é", " ", ".", "-", "00012.1.1.1", "12345678901234567890"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
        assert base(t) == brute(t), t


def test_added_kinds():
    def found(t):
        return [(t[a:b], k) for a, b, k in pii.find_spans(t, pii.automaton())]

    assert found("see https://www.example.org/a?b=1. or http://nohost or ftp://x.y)") == [("https://www.example.org/a?b=1", "url"), ("ftp://x.y", "url")]
    assert found("IBAN: GB82 WEST 1234 5698 7654 32 and so on") == [("GB82 WEST 1234 5698 7654 32", "account")]
    assert found("IBAN: GB83 WEST 1234 5698 7654 32") == []
    assert found("Account number: 00123456, discount 123456, konto=1234567") == [("00123456", "account"), ("1234567", "account")]
    assert found("SSN 123-45-6789 and 123-45-6789") == [("123-45-6789", "ssn")]
    assert pii.redact("to x@y.zz, +1 (483) 555-1712!", pii.find_spans("to x@y.zz, +1 (483) 555-1712!", pii.automaton())) == "to <EMAIL>, <PHONE>!"


def test_long_text_is_linear():
    assert base("a@" * 200_000) == [] and base("1" * 500_000) == [] and base("1." * 300_000)[:1] == [(0, 7, "ip")]
    assert base("+1" + " " * 500_000) == []


def test_whole_table_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(None, "x@y.zz"), (None, "x@y.zz"), (7000, None), (7001, ""), (7002, "é x@y.zz " * 20000)], "doc_id LONG, text STRING")
    both = docs.unionByName(extra).withColumn("spans", F.lit(1)).withColumn("found", F.lit("q"))
    want = {}
    for r in both.collect():
        s = brute(r.text)
        form = ",".join(f"{k}:{a}:{b}" for a, b, k in s)
        want.setdefault((r.doc_id, *(sum(x[2] == k for x in s) for k in pii.BASE), hashlib.sha256(form.encode()).hexdigest()), []).append(form)
    got = {}
    for r in pii.find_personal_data(both).collect():
        kept = ",".join(x for x in r.spans.split(",") if x.split(":")[0] in pii.BASE)
        assert ",".join(f"{f.kind}:{f.start}:{f.end}" for f in r.found) == r.spans
        got.setdefault((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256), []).append(kept)
    assert got == want
    assert pii.find_personal_data(spark.createDataFrame([], "doc_id LONG, text STRING")).count() == 0


def test_redaction_of_a_table(spark):
    df = spark.createDataFrame([(1, "mail x@y.zz now", 15, "a"), (2, None, None, None), (3, "", 0, "")], "doc_id LONG, text STRING, n_chars LONG, source STRING")
    assert [tuple(r) for r in pii.redact_documents(df).orderBy("doc_id").collect()] == [(1, "mail <EMAIL> now", 16, "a"), (2, None, None, None), (3, "", 0, "")]
