import math
import random
import re
from collections import Counter

from candor.operators import sentence_bounds as S

OPEN, CLOSE = r"^[\"'(\[{“‘„«]+", r"[\"')\]}”’»,;:]+$"


def core(x):
    return re.sub(CLOSE, "", re.sub(OPEN, "", x.lower()))


def dotted(c):
    return bool(re.search(r"[^.]\.$", c))


def typed(c):
    return c[:-1] if dotted(c) else c


def finished(c):
    return bool(re.search(r"([!?]|\.\.)$", c))


def g2(both, a, b, n):
    cells = [(both, a * b), (a - both, a * (n - b)), (b - both, (n - a) * b), (n - a - b + both, (n - a) * (n - b))]
    return 2 * sum(o * math.log(o * n / p) for o, p in cells if o > 0)


def plain(texts):
    """Abbreviations, starters, collocations and the two counts of each text, from the definitions."""
    rows = [[(core(x), y) for x, y in zip(t.split(), [*t.split()[1:], None])] for t in texts]
    flat = [r for row in rows for r in row]
    c1, c0 = Counter(typed(c) for c, _ in flat if dotted(c)), Counter(typed(c) for c, _ in flat if not dotted(c))
    n = len(flat)
    p = min(max(sum(c1.values()) / n, 1e-9), 1 - 1e-9)
    abbr = set()
    for t, k in c1.items():
        letters, dots, rest = len(t.replace(".", "")), t.count(".") + 1, c0[t]
        if letters and re.search(r"[^\W\d_]", t) and not re.search("[!?]", t):
            ll = -2 * (k * math.log(p) + rest * math.log(1 - p) - k * math.log(0.99) - rest * math.log(0.01))
            if ll * math.exp(-letters) * dots * float(letters) ** -rest >= 0.3:
                abbr.add(t)
    pairs = [(typed(c), typed(core(y)), dotted(c), finished(c) or (dotted(c) and typed(c) not in abbr)) for c, y in flat if y is not None]
    words, after = Counter(w for _, w, _, _ in pairs), Counter(w for _, w, _, e in pairs if e)
    total, breaks = len(pairs), sum(after.values())
    starters = {w for w, k in after.items() if re.search(r"[^\W\d_]", w) and k * total > words[w] * breaks and g2(k, words[w], breaks, total) >= 30}
    both = Counter((t, w) for t, w, d, _ in pairs if d and t not in abbr and re.fullmatch(r"[^\W\d_]|[0-9]+", t))
    tied = {(t, w) for (t, w), k in both.items() if k > 1 and k * total > c1[t] * words[w] and g2(k, c1[t], words[w], total) >= 7.88}
    counts = []
    for row in rows:
        ends = inner = 0
        for c, y in row:
            if y is None or not (dotted(c) or finished(c)):
                continue
            capital = re.sub(OPEN, "", y)[:1].isupper()
            t, w = typed(c), typed(core(y))
            if dotted(c) and ((t in abbr and not (w in starters and capital)) or (t not in abbr and (t, w) in tied)):
                inner += 1
            else:
                ends += 1
        counts.append((ends + 1 if row else 0, inner))
    return abbr, starters, tied, counts


def corpus(n, seed):
    rng = random.Random(seed)
    nouns = ["tool", "model", "report", "house", "river", "engine", "letter"]
    out = []
    for _ in range(n):
        s = []
        for _ in range(rng.randint(1, 4)):
            w = [rng.choice(["The", "We", "It"])] + [rng.choice(nouns) for _ in range(rng.randint(2, 6))]
            if rng.random() < 0.5:
                w.insert(2, rng.choice(["e.g.", "Dr.", "approx.", "v1.5", "(cf.", "etc.,"]))
            if rng.random() < 0.2:
                w += ["by", "J.", "Smith"]
            s.append(" ".join(w) + rng.choice([".", ".", ".", "!", "?", "..."]))
        out.append(" ".join(s))
    return out


def test_equal_to_the_plain_version(spark):
    texts = [*corpus(300, 1), "", "no mark at all", "One. e.g. two", "...", "a . b", "“Quoted.” Next (one.) Then"]
    df = spark.createDataFrame(list(enumerate([*texts, None])), "id INT, text STRING").repartition(4)
    bounds = S.learn(df)
    abbr, starters, tied, counts = plain(texts)
    assert {r.t for r in bounds.abbreviations.collect()} == abbr and {"e.g", "dr", "cf"} <= abbr
    assert {r.w for r in bounds.starters.collect()} == starters and {"the", "we", "it"} <= starters
    assert {(r.t, r.w) for r in bounds.collocations.collect()} == tied
    got = {r.id: (r.n_sentences, r.n_inner_periods) for r in S.count_sentences(df, ["id"], bounds).collect()}
    assert [got[i] for i in range(len(texts))] == counts and got[len(texts)] == (0, 0)


def test_abbreviations_and_versions_end_no_sentence(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus(400, 2))], "id INT, text STRING")
    new = spark.createDataFrame([(1, "The tool e.g. model runs v1.5 here. We saw Dr. House. It ran!"), (2, "The river")], "id INT, text STRING")
    got = {r.id: r.n_sentences for r in S.count_sentences(new, ["id"], S.learn(df)).collect()}
    assert got == {1: 3, 2: 1}


def test_empty(spark):
    none = spark.createDataFrame([], "id INT, text STRING")
    bounds = S.learn(none)
    assert bounds.abbreviations.count() == 0 and S.count_sentences(none, ["id"], bounds).count() == 0
