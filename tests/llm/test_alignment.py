import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candor.llm import alignment as K
from candor.llm import queries as Q

FILES = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model"))


def byte_table():
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in own}
    return table | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in own)}


def plain(rows):
    """The contract over ``(doc_id, text)`` with the tokenizer files themselves and every link as a row."""
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[3])
    chars, entries = byte_table(), {i: t for t, i in a.get_vocab().items()}
    docs = []
    for d, text in rows:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(chars[c] for c in entries[i]) for i in ids_a]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends = [set(np.cumsum([len(x) for x in s]).tolist()) for s in (bytes_a, bytes_b)]
                both = sorted(ends[0] & ends[1])
                place = lambda ids, parts: [(i, np.searchsorted(both, e)) for i, e in zip(ids, np.cumsum([len(x) for x in parts]).tolist())]
                of = defaultdict(lambda: ([], []))
                for side, pairs in enumerate((place(ids_a, bytes_a), place(ids_b, bytes_b))):
                    for i, g in pairs:
                        of[g][side].append(i)
                groups = [of[g] for g in sorted(of)]
        docs.append((d, groups))
    count = Counter(p for _, groups in docs for p in {(x, y) for g in groups for x in g[0] for y in g[1]})
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for d, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append(str((d, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(count[p] == highest[p[0]] for p in links),
                        sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else "")))
    return sorted(out)


def found(df):
    return sorted(str(tuple(r)) for r in df.collect())


ROWS = [(1, None), (2, ""), (3, " "), (4, "plain words here"), (4, "plain words here"), (None, "plain words"), (5, "a<|endoftext|>b <s> </s> <0x0A> <unk>"),
        (6, "has ▁ mark"), (7, "x\x00y\n\n\tz \r\n"), (8, "é漢字😀 und Straße ".replace(" ", " ")), (9, " " * 500 + "x" + "\n" * 300), (10, "z" * 3000),
        (11, "漢字仮名交じり文" * 60), (12, "क्ष " * 50), (13, "word " * 4000), (14, "ǆ﻿‍\U000e0001"), (-15, "1234567890" * 40)]


def test_edges(spark):
    df = spark.createDataFrame(ROWS, "doc_id LONG, text STRING").withColumns({c: F.lit("x") for c in ("row", "pair", "n_a", "once", "best", "rest")})
    assert found(K.link_statistics(df, FILES)) == plain(ROWS)
    assert K.link_statistics(spark.createDataFrame([], "doc_id LONG, text STRING"), FILES).count() == 0


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["the", "Straße", " ", "  ", "\n", "don't", "漢字", "é", "😀", "2024-01-02", "https://a.b/c?d=e", "́", "ABCdef", "\t", "_", "…", "▁", "\x00", "naïve"]
    return [(i, "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("limits", [{}, {"MAX_PAIRS": 40}, {"MAX_PAIRS": 0}, {"LARGE": 2, "NEAR": 0}, {"NEAR": 1}])
def test_random_texts(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(K, k, v)
    rows = random_texts(150, 3)
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(4)
    # Small searches and large groups inside tasks: the module's values there are those of the driver only under the direct call.
    tokenizers = K.Tokenizers(*FILES)
    own = K.Aligned(tokenizers, [t for _, t in rows])
    doc, pairs, times = own.id_pairs(32000)
    assert int(times.sum()) == int(own.links().sum())
    assert found(K.link_statistics(df, FILES)) == plain(rows)


@pytest.mark.parametrize("near", [0, 1, 8])
def test_cuts_are_all_common_ends(monkeypatch, near):
    monkeypatch.setattr(K, "NEAR", near)
    rng = np.random.default_rng(near)
    for _ in range(200):
        ends, bounds, base = [[], []], [[0], [0]], 0
        for _ in range(rng.integers(1, 5)):
            n = int(rng.integers(0, 60))
            for k in (0, 1):
                own = np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n + 1)), n)) if n else np.zeros(0, int)
                ends[k] += (own + base).tolist()
                bounds[k].append(len(ends[k]))
            base += n
        a, b = (np.array(x, dtype=np.int64) for x in ends)
        after, after_b = K.shared_cuts(a, b, *(np.array(x) for x in bounds))
        both = np.intersect1d(a, b)
        assert (a[after - 1] == both).all() and (b[after_b - 1] == both).all() and len(after) == len(both)


def test_long_interval_without_a_cut():
    n = 200_000
    a, b = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n)
    after, after_b = K.shared_cuts(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    assert after.tolist() == [len(a)] and after_b.tolist() == [len(b)]


def test_groups_of_align(spark):
    tokenizers = K.Tokenizers(*FILES)
    for r in K.align(spark.createDataFrame(ROWS, "doc_id LONG, text STRING"), FILES).collect():
        assert len(r.a_ends) == len(r.b_ends)
        at, at_b, done = 0, 0, b""
        for x, y in zip(r.a_ends, r.b_ends):
            one = b"".join(tokenizers.bytes_a[i] for i in r.a_ids[at:x])
            assert one and one == b"".join(tokenizers.bytes_b[i] for i in r.b_ids[at_b:y])
            at, at_b, done = x, y, done + one
        assert (at, at_b) == (len(r.a_ids), len(r.b_ids))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(Q.QUERIES["op13_cut_alignment"](spark, sf)) == plain(given)


def test_texts_whose_bytes_differ():
    tokenizers = K.Tokenizers(*FILES)
    got = tokenizers.pairs(["plain", "a▁b", None, "", "▁", "more words"])
    assert [len(a) > 0 for a, _ in got] == [True, False, False, False, False, True]
    ids = [np.array(tokenizers.b.encode(t), np.int32) for t in ("ab", "cd")]
    assert tokenizers.spelled(ids, [b" ab", b" ce"], tokenizers.size_b, tokenizers.flat_b).tolist() == [True, False]
