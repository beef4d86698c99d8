"""Language identification of mixed-language text.

Words are runs of letters of one script. A word may only be of a language that uses its script
(learned shares, ``MIN_SCRIPT_SHARE``). Its score for a language is the mean log probability
of its character n-grams (1 to 4, with word borders) and of the whole word, hashed to ``BUCKETS``
features, times ``SHARPNESS``. A Viterbi pass over the words of a text, with ``SWITCH`` as the price of
changing language, labels spans; the text's language is the one with most letters.

Learning counts features over at most ``FIT_ROWS`` labelled rows per language, chosen by a hash of the
id, so the model's size is bounded by the number of languages. Prediction reads only texts.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.llm import common as C

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
FIT_ROWS = 4000  # documented bound of the sample, per language
FIT_PARTITIONS = 16
SMOOTHING = 0.5
SHARPNESS = 4.0
SWITCH = 12.0
MIN_SCRIPT_SHARE = 0.01
IMPOSSIBLE = -40.0
FORMS = 1 << 14  # distinct words whose features are hashed at once
UNKNOWN = "und"
MIN_SCORE = 0.5  # ``rejected``: below this share of letters no language is dominant

# Script ranges by code point (first, last, script).
SCRIPT_RANGES = (
    (0x0041, 0x024F, 1),  # Latin
    (0x0250, 0x02AF, 1),
    (0x0370, 0x03FF, 2),  # Greek
    (0x0400, 0x052F, 3),  # Cyrillic
    (0x0530, 0x058F, 4),  # Armenian
    (0x0590, 0x05FF, 5),  # Hebrew
    (0x0600, 0x077F, 6),  # Arabic
    (0x0900, 0x097F, 7),  # Devanagari
    (0x0980, 0x09FF, 8),  # Bengali
    (0x0B80, 0x0BFF, 9),  # Tamil
    (0x0E00, 0x0E7F, 10),  # Thai
    (0x10A0, 0x10FF, 11),  # Georgian
    (0x1100, 0x11FF, 12),  # Hangul
    (0x1E00, 0x1EFF, 1),
    (0x1F00, 0x1FFF, 2),
    (0x3040, 0x30FF, 13),  # Kana
    (0x3400, 0x4DBF, 14),  # Han
    (0x4E00, 0x9FFF, 14),
    (0xAC00, 0xD7AF, 12),
    (0x20000, 0x2FA1F, 14),
)
N_SCRIPTS = 15  # 0 stands for all others
NO_LETTER, MARK = 255, 254  # a mark belongs to the character before it


class Alphabet:
    """Per code point: letter or not, lower case, script; filled for code points as they appear."""

    def __init__(self) -> None:
        self.known = np.zeros(0x110000, dtype=bool)
        self.script = np.full(0x110000, NO_LETTER, dtype=np.uint8)
        self.lower = np.zeros(0x110000, dtype=np.uint32)

    def learn(self, points: np.ndarray) -> None:
        for c in np.unique(points[~self.known[points]]).tolist():
            ch = chr(c)
            self.known[c] = True
            low = ch.lower()
            self.lower[c] = ord(low) if len(low) == 1 else c
            if ch.isalpha():
                self.script[c] = next((s for a, b, s in SCRIPT_RANGES if a <= c <= b), 0)
            elif unicodedata.category(ch)[0] == "M":
                self.script[c] = MARK


@dataclass
class Words:
    """Words of some texts: text number, start and end in code points of that text, script, distinct form."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    form: np.ndarray
    grams: np.ndarray  # feature buckets of the distinct forms, form by form (16 bits each)
    bounds: np.ndarray


def find_words(texts: list[str], alphabet: Alphabet) -> Words:
    off = np.cumsum([0, *map(len, texts)])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    alphabet.learn(points)
    border = np.zeros(len(points) + 1, dtype=bool)
    border[off] = True
    script = alphabet.script[points]
    mark = script == MARK
    if mark.any():
        script = script[np.maximum.accumulate(np.where(~mark | border[:-1], np.arange(len(points)), 0))]
        script[script == MARK] = NO_LETTER
    letter = script != NO_LETTER
    border[1:-1] |= script[1:] != script[:-1]
    starts = np.flatnonzero(letter & border[:-1])
    ends = np.flatnonzero(letter & border[1:]) + 1
    symbols = C.mix(alphabet.lower[points].astype(np.uint64) + np.uint64(1 << 32))
    whole = C.span_hashes(symbols, starts, ends)
    _, first, form = np.unique(whole, return_index=True, return_inverse=True)
    text = np.searchsorted(off, starts, side="right") - 1
    parts = [features(symbols, starts[f], ends[f], whole[f]) for f in np.split(first, range(FORMS, len(first), FORMS))]
    grams = np.concatenate([g for g, _ in parts])
    bounds = np.cumsum(np.concatenate([[0], *(np.diff(b) for _, b in parts)]))
    return Words(text, starts - off[text], ends - off[text], script[starts], form, grams, bounds)


_EDGE = np.uint64(0xA0761D6478BD642F)
_PLACE = C.constants(max(ORDERS), 8)


def features(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams (with a border symbol at both ends) and the whole form, per form."""
    n = ends - starts
    size = n + 2
    at = np.cumsum(size) - size
    flat = np.full(int(size.sum()), _EDGE, dtype=np.uint64)
    inner = np.repeat(at + 1 - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    flat[inner] = symbols[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    owner = np.repeat(np.arange(len(n)), size)
    stop = np.repeat(at + size, size)
    pos = np.arange(len(flat))
    buckets, owners = [(whole ^ _EDGE)], [np.arange(len(n))]
    acc = np.zeros(len(flat), dtype=np.uint64)
    for k in ORDERS:
        shifted = np.zeros(len(flat), dtype=np.uint64)
        shifted[:len(flat) - k + 1] = flat[k - 1:]
        acc = acc + shifted * _PLACE[k - 1]
        ok = pos + k <= stop
        if k == 1:
            ok &= flat != _EDGE
        buckets.append(acc[ok] + np.uint64(k))
        owners.append(owner[ok])
    owner_all = np.concatenate(owners)
    order = np.argsort(owner_all, kind="stable")
    hashed = (C.mix(np.concatenate(buckets)) >> np.uint64(40)) % np.uint64(BUCKETS)
    return hashed[order].astype(np.uint16), np.searchsorted(owner_all[order], np.arange(len(n) + 1))


# ---------------------------------------------------------------------------------------------
# Learning
# ---------------------------------------------------------------------------------------------

@dataclass
class Model:
    langs: list[str] = field(default_factory=list)
    logp: np.ndarray | None = None  # (BUCKETS, languages)
    uses: np.ndarray | None = None  # (N_SCRIPTS, languages)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    alphabet = Alphabet()
    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        texts = batch.column("text").to_pylist()
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lo, hi in C.row_chunks(np.array([len(t) for t in texts])):
            words = find_words(texts[lo:hi], alphabet)
            n_forms = len(words.bounds) - 1
            own = langs[lo:hi][words.text]
            for lang in set(own):
                here = own == lang
                times = np.bincount(words.form[here], minlength=n_forms)
                table = tables.setdefault(lang, np.zeros(BUCKETS + N_SCRIPTS))
                table[:BUCKETS] += np.bincount(words.grams, weights=np.repeat(times, np.diff(words.bounds)), minlength=BUCKETS)
                table[BUCKETS:] += np.bincount(words.script[here], weights=(words.end - words.start)[here], minlength=N_SCRIPTS)
    for lang, table in tables.items():
        some = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(table[some].astype(np.int64))],
                                         names=["lang", "bucket", "n"])


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS) -> Model:
    """Feature counts over at most about ``fit_rows`` rows per language, never a held-out row.

    Rows with NULL text or NULL ``lang`` are not used. Without labelled rows the model has no languages.
    The driver receives one count per language and feature, which ``BUCKETS`` bounds.
    """
    src = docs.where(~held_out(F.col(doc_id))).select(
        F.xxhash64(F.col(doc_id), F.lit("fit")).alias("h"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    per_lang = {r["lang"]: r["count"] for r in src.groupBy("lang").count().collect()}
    if not per_lang:
        return Model()
    span = 1 << 20
    share = F.create_map(*[F.lit(x) for k, n in per_lang.items() for x in (k, int(min(1.0, fit_rows / n) * span))])
    sample = src.where(F.pmod("h", F.lit(span)) < share[F.col("lang")]).select("text", "lang").repartition(FIT_PARTITIONS)
    counts = sample.mapInArrow(_count, "lang STRING, bucket INT, n LONG").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(per_lang)
    table = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    column = np.array([langs.index(x) for x in counts.column("lang").to_pylist()], dtype=np.int64)
    table[counts.column("bucket").to_numpy(), column] = counts.column("n").to_numpy()
    grams, scripts = table[:BUCKETS] + SMOOTHING, table[BUCKETS:]
    uses = scripts >= MIN_SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(langs, np.log(grams / grams.sum(axis=0)).astype(np.float32), uses & (scripts > 0))


# ---------------------------------------------------------------------------------------------
# Prediction
# ---------------------------------------------------------------------------------------------

def word_scores(words: Words, model: Model) -> np.ndarray:
    """``(words, languages)``; languages without the word's script are out unless no language has it."""
    sums = np.add.reduceat(model.logp[words.grams], words.bounds[:-1], axis=0)
    sums *= SHARPNESS / np.diff(words.bounds)[:, None]
    able = model.uses[words.script]
    return np.where(able.any(axis=1)[:, None], np.where(able, sums[words.form], IMPOSSIBLE * SHARPNESS), 0.0)


def viterbi(scores: np.ndarray, begins: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best labels of several sequences (rows ``begins[i]`` to ``begins[i] + counts[i]`` of ``scores``).

    All sequences advance together, longest first. Ties prefer staying, then the first language.
    """
    order = np.argsort(-counts, kind="stable")
    base, n = begins[order], counts[order]
    langs = np.arange(scores.shape[1])
    back = np.zeros(scores.shape, dtype=np.int16)
    value = np.zeros((len(n), scores.shape[1]))
    steps = int(n[0]) if len(n) else 0
    active = np.searchsorted(-n, -np.arange(1, steps + 1), side="right")
    for t in range(steps):
        m = active[t]
        at, v = base[:m] + t, value[:m]
        top = v.max(axis=1)
        moved = top - switch if t else top - np.inf
        take = moved[:, None] > v
        back[at] = np.where(take, v.argmax(axis=1)[:, None], langs)
        value[:m] = np.where(take, moved[:, None], v) + scores[at]
    label = np.zeros(len(scores), dtype=np.int16)
    now = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = base[:m] + t
        label[at] = now[:m]
        now[:m] = back[at, now[:m]]
    return label


def by_length(batch: pa.RecordBatch, text_at: int) -> Iterator[pa.RecordBatch]:
    """The rows in chunks of texts of about one length, which the Viterbi pass then takes in few steps."""
    sizes = np.diff(C.text_buffers(batch.column(text_at))[1])
    order = np.argsort(sizes, kind="stable")
    for lo, hi in C.row_chunks(sizes[order]):
        yield batch.take(pa.array(order[lo:hi]))


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, spans``: spans are ``(start, end, lang)`` in code points.

    ``score`` is the share of the text's letters in spans of ``lang_pred``. NULL texts and texts without
    letters (and all texts, if no language was learned) are ``und`` with score 0 and no spans. Every
    row is answered, repeated rows and NULL ``doc_id`` included. Other columns are never read.
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet()
        for batch in batches:
            for rows in by_length(batch, batch.schema.get_field_index("text")):
                own = labelled(rows.column("text").to_pylist(), model, alphabet)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), *own],
                                                 names=["doc_id", "held_out", "lang_pred", "score", "spans"])

    return src.mapInArrow(label, "doc_id LONG, held_out BOOLEAN, lang_pred STRING, score DOUBLE, spans ARRAY<STRUCT<start: INT, end: INT, lang: STRING>>")


def labelled(texts: list[str], model: Model, alphabet: Alphabet) -> list[pa.Array]:
    words = find_words(texts, alphabet) if model.langs else None
    if words is None or not len(words.text):
        empty = pa.ListArray.from_arrays(pa.array([0] * (len(texts) + 1), pa.int32()), pa.array([], SPAN))
        return [pa.array([UNKNOWN] * len(texts)), pa.array([0.0] * len(texts)), empty]
    counts = np.bincount(words.text, minlength=len(texts))
    best = viterbi(word_scores(words, model), np.cumsum(counts) - counts, counts)
    letters = np.zeros((len(texts), len(model.langs)))
    np.add.at(letters, (words.text, best), words.end - words.start)
    total = letters.sum(axis=1)
    names = np.array([*model.langs, UNKNOWN], dtype=object)
    pred = np.where(total > 0, letters.argmax(axis=1), len(model.langs))
    score = letters.max(axis=1) / np.maximum(total, 1)
    new = np.ones(len(best), dtype=bool)
    new[1:] = (best[1:] != best[:-1]) | (words.text[1:] != words.text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(best)) - 1
    spans = pa.StructArray.from_arrays([pa.array(words.start[first], pa.int32()), pa.array(words.end[last], pa.int32()), pa.array(names[best[first]], pa.string())],
                                       fields=list(SPAN))
    at = np.searchsorted(words.text[first], np.arange(len(texts) + 1))
    return [pa.array(names[pred], pa.string()), pa.array(score), pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans)]


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])


def with_language(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that have a language, with ``lang`` set to it; no join, rows pass through as they are.

    Left out: NULL texts, texts without letters, and texts of which no language has ``min_score`` of the letters.
    """
    text_at, lang_at = docs.columns.index(text), docs.columns.index(lang)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet()
        for batch in batches:
            for rows in by_length(batch, text_at):
                pred, score, _ = labelled([t or "" for t in rows.column(text_at).to_pylist()], model, alphabet)
                good = (score.to_numpy() >= min_score) & (score.to_numpy() > 0)
                yield rows.set_column(lang_at, rows.schema.field(lang_at), pred.cast(rows.schema.field(lang_at).type)).filter(pa.array(good))

    return docs.mapInArrow(label, docs.schema)
