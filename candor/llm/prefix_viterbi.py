"""Encoding and decoding with the pieces of a SentencePiece model.

A text becomes marked words: a space is written as the mark, one mark is put in front, and the text is
split before every run of marks. No piece has a mark after another character (checked when the model is
loaded), so the best segmentation of a text is that of its words, one by one.

A task keeps the ids of the words it has met, at most ``KEPT_WORDS`` of them between chunks. The distinct marked words
that a chunk adds are sorted, which is a depth-first walk of their trie: a word shares the forward scores of the prefix that
it has in common with the word before, and only the rest is computed. Each position carries the longest end of its prefix that begins
a piece; that end names all pieces that end there, which are looked up once for it.
The forward score of a position is the best, over pieces that end there, of the score before the piece
plus the piece's score; equal scores prefer the longer last piece. A character that no piece covers costs
the lowest piece score less ``UNKNOWN_COST`` and is written as its UTF-8 bytes.

Segments have the highest sum of the model's scores. (For a model of this type the library's plain encoding joins
pairs greedily instead; its n-best search, with the type set to unigram, finds the same sums as this module.)
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from candor.llm import common as C

MARK = "▁"
UNKNOWN_COST = 10.0
CHUNK_CHARS = 8 * C.CHUNK
KEPT_WORDS = 1 << 19
KEPT_ENDS = 1 << 20


def marked_words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The marked words of all texts, less the mark that each has in front and with spaces for further ones; where each text's begin, and their number."""
    rows = pa.array([t or None for t in texts], pa.large_string())
    space = " "
    if any(MARK in t or "  " in t or t.startswith(" ") for t in texts):
        # Of a run of marks, the first parts two words; a text without marks has none left to be taken for it.
        rows, space = pc.replace_substring_regex(pc.replace_substring(rows, MARK, " "), "([^ ]) ( *)", rf"\1{MARK}\2"), MARK
    parts = pc.split_pattern(rows, space)
    return parts.flatten(), np.cumsum([0, *pc.fill_null(pc.list_value_length(parts), 0).to_pylist()])


class End(dict):
    """The longest end of a prefix that begins a piece, as a table from the next character to the end that follows, filled when first asked.

    ``pieces`` are those that it ends in, short ones first: score, and length and id.
    """

    __slots__ = ("of", "word", "pieces")

    def __init__(self, of: Pieces, word: str, pieces: list[tuple[float, tuple[int, int]]]):
        self.of, self.word, self.pieces = of, word, pieces

    def __missing__(self, ch: str) -> End:
        found = self[ch] = self.of.end(self.word + ch)
        return found


class Pieces:
    """Piece scores, a trie of reversed pieces, and byte pieces of the model file at ``path``."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.names = [sp.id_to_piece(i) for i in range(n)]
        self.byte_of = {i: int(self.names[i][3:-1], 16) for i in range(n) if sp.is_byte(i)}
        self.byte_ids = [i for i, _ in sorted(self.byte_of.items(), key=lambda x: x[1])]
        normal = [i for i in range(n) if i not in special]
        if len(self.byte_ids) != 256 or any(MARK in self.names[i].lstrip(MARK) for i in normal):
            raise ValueError("the model needs 256 byte pieces and marks at the front of pieces only")
        self.unknown = min(sp.get_score(i) for i in normal) - UNKNOWN_COST
        self.ends: dict = {}
        for i in normal:
            node = self.ends
            for ch in reversed(self.names[i]):
                node = node.setdefault(ch, {})
            node[""] = (sp.get_score(i), i)
        self.fronts = {""} | {self.names[i][:k] for i in normal for k in range(1, len(self.names[i]) + 1)}
        self.raw = pa.array([bytes([self.byte_of[i]]) if i in self.byte_of else name.encode() for i, name in enumerate(self.names)], pa.large_binary())
        self._forget_ends()
        self.ids_of: dict[str, bytes] = {}  # of words as ``marked_words`` writes them

    def _forget_ends(self) -> None:
        self.known = {"": End(self, "", [])}
        self.asked = 0

    def end(self, word: str) -> End:
        """The ``End`` of ``word``."""
        self.asked += 1
        while word not in self.fronts:
            word = word[1:]
        found = self.known.get(word)
        if found is None:
            pieces, node = [], self.ends
            for size, ch in enumerate(reversed(word), 1):
                node = node.get(ch)
                if node is None:
                    break
                if "" in node:
                    score, i = node[""]
                    pieces.append((score, (size, i)))
            found = self.known[word] = End(self, word, pieces)
        return found

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Ids of each of ``words``, which must be sorted (by any order of the characters)."""
        if self.asked > KEPT_ENDS:
            self._forget_ends()
        best = [0.0]  # forward score of each position of the current word
        came = [(0, -1)]  # length of the best last piece, its id (-1: bytes)
        ends = [self.known[""]]
        unknown, no_piece = self.unknown, (1, -1)
        out, before = [], ""
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1:], came[shared + 1:], ends[shared + 1:]
            end, at = ends[shared], shared
            for ch in word[shared:]:
                end = end[ch]
                top, last = best[at] + unknown, no_piece
                at += 1
                for score, piece in end.pieces:
                    total = best[at - piece[0]] + score
                    if total >= top:
                        top, last = total, piece
                best.append(top)
                came.append(last)
                ends.append(end)
            before = word
            ids = []
            while at:
                size, piece = came[at]
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids += [self.byte_ids[b] for b in reversed(word[at - 1].encode())]
                at -= size
            ids.reverse()
            out.append(ids)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, by way of the distinct marked words of all of them."""
        words, at = marked_words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        ids_of = self.ids_of
        if len(ids_of) > KEPT_WORDS:
            ids_of.clear()
        new = sorted(filterfalse(ids_of.__contains__, distinct))
        encoded = self.encode_sorted([MARK + w.replace(" ", MARK) for w in new])
        ends = np.cumsum([0, *map(len, encoded)])
        raw = np.fromiter(chain.from_iterable(encoded), np.uint32, int(ends[-1])).tobytes()
        ids_of.update(zip(new, map(raw.__getitem__, map(slice, (4 * ends[:-1]).tolist(), (4 * ends[1:]).tolist()))))
        joined = pa.array(list(map(ids_of.__getitem__, distinct)), pa.large_binary()).take(coded.indices)
        flat = np.frombuffer(joined.buffers()[2] or b"", np.uint32)
        cuts = np.frombuffer(joined.buffers()[1], np.int64)[at] // 4 if len(joined) else at
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``: pieces joined, byte pieces as UTF-8, marks as spaces, less the mark in front."""
        if not len(ids):
            return ""
        joined = self.raw.take(pa.array(ids)).buffers()[2]
        return str(joined, "utf-8", "replace").replace(MARK, " ")[1:]


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, ids_crc32, decoded_equal`` for every row.

    ``decoded_equal`` says that decoding gives the text back; it is false only for texts that hold the mark
    itself, which the model reads as a space. NULL and empty texts have no ids. Repeated rows and NULL ``doc_id``
    are each answered; an empty table gives no rows; other columns are ignored.
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in C.row_chunks(np.array([len(t) for t in texts]), CHUNK_CHARS):
                ids = pieces.encode(texts[lo:hi])
                at = np.cumsum([0, *map(len, ids)])
                for a, b in C.row_chunks(np.diff(at), C.CHUNK):  # lists of a batch count in 32 bits
                    flat = np.concatenate(ids[a:b]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(at[a:b + 1] - at[a], pa.int32()), pa.array(flat))
                    crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids[a:b]]
                    same = [pieces.decode(x) == t for x, t in zip(ids[a:b], texts[lo + a:lo + b])]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo + a, b - a), lists, pa.array(crc, pa.int64()), pa.array(same)],
                                                     names=["doc_id", "ids", "ids_crc32", "decoded_equal"])

    return src.mapInArrow(run, "doc_id LONG, ids ARRAY<INT>, ids_crc32 LONG, decoded_equal BOOLEAN")


def decode(encoded: DataFrame, model: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in ``out``; NULL ids give NULL."""
    kept = [c for c in encoded.columns if c != out]
    place = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            texts = [None if v is None else pieces.decode(np.array(v, dtype=np.int64)) for v in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    rows = encoded.select(*kept)
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(out, StringType())]))
