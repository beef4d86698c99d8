import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candor.llm import fim as K
from candor.llm import queries as Q

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def plain(doc, text):
    """The contract, word by word, on Python strings."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    sha = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100:
        return n, "plain", None, None, text, sha
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", sha
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", sha


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 4096])
def test_every_cut(block):
    for text in ("", "a", "\n", "a\n", "é\n\n漢字\nx", "\n" * 50, "😀b\r\nc" * 30 + "\n", "no end " * 40):
        raw = np.frombuffer(text.encode(), np.uint8)
        tree, units = K.BlockTree(raw, block), UNIT.findall(text)
        assert tree.lines == len(units) and tree.chars == len(text)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert tree.cut(k) == (len(head.encode()), len(head))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a\né漢😀\r ", max_size=200), st.integers(1, 9))
def test_cuts_of_random_texts(text, block):
    tree, units = K.BlockTree(np.frombuffer(text.encode(), np.uint8), block), UNIT.findall(text)
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert tree.cut(k) == (len(head.encode()), len(head))


def test_changed_block():
    raw = np.frombuffer(("line\n" * 100).encode(), np.uint8).copy()
    tree = K.BlockTree(raw, 16)
    raw[tree.block * 3] = 10  # a letter of the fourth block becomes a line end
    old = K.BlockTree(raw, 16)
    tree.add(3, 1, 0)
    assert (tree.tree == old.tree).all()


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "one line"), (4, "a\nb\nc\n"), (4, "a\nb\nc\n"), (None, "x\ny"), (5, "has <S> in it\nb"), (6, "<P"), (7, "<\n<\nS>\n<M"),
            (8, "é漢😀\n" * 9000), (-9, "\n\n\n"), (10, "w" * 200_000), (11, "a\r\nb c\n")] + [(100 + i, "q\nw\ne\nr\n<") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumns({"output": F.lit("x"), "form": F.lit(1), "n": F.lit(None)})
    out = K.transform(df).withColumn("again", K.restored(F.col("output"), F.col("form"))).collect()
    got = sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again) for r in out)
    want = sorted((str(d), *plain(d, t)[:5], t or "") for d, t in rows)
    assert [g[0:3] for g in got] == [w[0:3] for w in want] and got == want
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert K.transform(spark.createDataFrame([], "doc_id LONG, text STRING")).count() == 0
    few = K.transform(df, rate=40).where("form <> 'plain'").count()
    assert 0 < few < len(rows) - 3


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = Q.QUERIES["op11_fill_in_middle"](spark, sf).collect()
    assert len(rows) == len(given)
    for r in rows:
        n, form, p, m, output, sha = plain(r.doc_id, given[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert (r.output_sha256, r.restored_sha256) == (hashlib.sha256(output.encode()).hexdigest(), sha)
