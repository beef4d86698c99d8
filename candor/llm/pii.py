"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, URL schemes, a digit before a dot, a plus
sign before a digit, two neighbouring digits, and identifier cues. From each anchor a small parser
expands to the left and right, validates the candidate and says where that kind goes on
looking, so every character is read a bounded number of times.

Base kinds (leftmost, not overlapping within a kind; a candidate that fails its check is dropped):
email, ip (four parts of at most 255), card (14 to 19 digits, Luhn), phone (10 to 15 digits).
Kinds the anchors add: url (scheme, host with a dot), account (a bank account number that
passes mod 97, or 6 to 17 digits after an account cue), ssn (3-2-4 digits after its cue).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "ssn")
RANK = {k: i for i, k in enumerate(KINDS)}
DIGITS = frozenset("0123456789")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = LETTERS | DIGITS | frozenset("._%+-")
SCHEMES = ("http", "https", "ftp")
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "kontonummer", "cuenta", "compte")
SSN_CUES = ("ssn",)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){0,3}")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?:[/?#][^\s\"'<>]*)?")
_GAP = re.compile(r"(?: ?(?:number|no|nr)\b)?[ .:#=]{1,4}", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![0-9])")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    found: dict[str, str] = {"@": "@", "://": "/"}
    for d in DIGITS:
        found[d + "."] = "."
        found["+" + d] = "+"
        for e in DIGITS:
            found |= {d + e: "d", f"{d} {e}": "d", f"{d}-{e}": "d"}
    for kind, cues in (("a", ACCOUNT_CUES), ("s", SSN_CUES)):
        for cue in cues:
            found |= dict.fromkeys((cue, cue.upper(), cue.capitalize()), kind)
    for word, kind in found.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def small(part: str) -> bool:
    """A number of at most 255, leading zeros allowed."""
    rest = part.lstrip("0")
    return len(rest) < 4 and int(rest or "0") <= 255


def find_spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start, then kind; code points, end exclusive."""
    out = []
    seen = dict.fromkeys("@.d+/as", 0)  # where each kind goes on looking
    for last, (width, kind) in anchors.iter(text):
        at = last + 1 - width
        floor = seen[kind]
        if at < floor:
            continue
        if kind == "d":
            end = _GROUPED.match(text, at).end()
            seen["d"] = end
            if end - at >= 14:
                digits = text[at:end].replace(" ", "").replace("-", "")
                if len(digits) <= 19 and len(digits) >= 14 and luhn(digits):
                    out.append((at, end, "card"))
        elif kind == ".":
            start = at
            while start > floor and text[start - 1] in DIGITS:
                start -= 1
            run = _DOTTED.match(text, start)
            parts = run.group().split(".")
            seen["."] = run.end()
            if len(parts) == 4 and all(map(small, parts)):
                out.append((start, run.end(), "ip"))
        elif kind == "@":
            start = at
            while start > floor and text[start - 1] in LOCAL:
                start -= 1
            domain = _DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                seen["@"] = domain.end()
                out.append((start, domain.end(), "email"))
        elif kind == "+":
            m = _PHONE.match(text, at)
            if m:
                seen["+"] = m.end()
                if 10 <= sum(c in DIGITS for c in m.group()) <= 15:
                    out.append((at, m.end(), "phone"))
        elif kind == "/":
            start = at
            while start > floor and at - start < 6 and text[start - 1] in LETTERS:
                start -= 1
            m = _URL.match(text, at + 3) if text[start:at].lower() in SCHEMES else None
            if m:
                end = start + len(text[start:m.end()].rstrip(".,;:!?)]}"))
                seen["/"] = m.end()
                out.append((start, end, "url"))
        else:
            gap = _GAP.match(text, last + 1)
            if gap and (at == 0 or not text[at - 1].isalnum()):
                found = account(text, gap.end()) if kind == "a" else _SSN.match(text, gap.end())
                if found:
                    seen[kind] = found.end()
                    out.append((found.start(), found.end(), "account" if kind == "a" else "ssn"))
    return sorted(out, key=lambda s: (s[0], RANK[s[2]]))


def account(text: str, at: int) -> re.Match | None:
    """A valid IBAN (its longest valid prefix of whole groups), else a run of 6 to 17 digits."""
    m = _IBAN.match(text, at)
    while m:
        if mod97(m.group().replace(" ", "")):
            return m
        m = _IBAN.match(text, at, m.end() - 1)
    return _ACCOUNT.match(text, at)


def as_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Each span (overlapping ones together) becomes ``<KIND>`` of the first."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, counts by base kind, ``base_sha256``, ``spans`` (text form) and ``found`` (array of structs).

    NULL and empty texts have no spans. Every row is answered, repeated rows and NULL ``doc_id``
    included; an empty table gives no rows; other columns are ignored.
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            spans = [find_spans(t.as_py(), anchors) for t in batch.column("text")]
            base = [[s for s in x if s[2] in BASE] for x in spans]
            cols = [batch.column("doc_id")]
            cols += [pa.array([sum(s[2] == k for s in x) for x in base], pa.int64()) for k in BASE]
            cols.append(pa.array([hashlib.sha256(as_text(x).encode()).hexdigest() for x in base], pa.string()))
            cols.append(pa.array([as_text(x) for x in spans], pa.string()))
            cols.append(pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in x] for x in spans], FOUND))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "found"])

    return src.mapInArrow(scan, "doc_id LONG, " + ", ".join(f"n_{k} LONG" for k in BASE)
                          + ", base_sha256 STRING, spans STRING, found ARRAY<STRUCT<start: INT, end: INT, kind: STRING>>")


FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def redact_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced in ``text`` (NULL stays NULL) and ``n_chars``, where present, set anew."""
    place = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            texts = [None if t is None else redact(t, find_spans(t, anchors)) for t in (v.as_py() for v in batch.column(place))]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    out = docs.mapInArrow(clean, docs.schema)
    return out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType)) if n_chars in docs.columns else out
