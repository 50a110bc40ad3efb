"""SentencePiece encoding and decoding by a streaming Viterbi search.

The pieces and scores come from a public SentencePiece model file. The encoder finds the segmentation with
the largest sum of scores. It keeps the best score of the last ``max_len`` places only (no longer piece can
reach back further) and the back pointers since the last commit; whenever the best paths to all places that
can still be extended meet in one boundary, the ids up to it are final and leave the window. A boundary that no
piece crosses (before a space that follows another character) is such a meeting point always, so texts are fed
word by word, and the ids of a word seen before come from a bounded table.

Characters outside the vocabulary become their UTF-8 bytes. As the model does, a space is put
before the text and spaces are written U+2581; a literal U+2581 becomes its bytes, so decoding gives back every text
exactly. Equal sums: the longest last piece wins.

Defined results: a null text has null ids, decoded to null; an empty text has no ids. Each row is
encoded by itself, so repeated rows and other columns don't matter.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.llm.common import kept, list_array, texts_of

SPACE = "▁"
LITERAL = "\ud800"  # stands for a literal U+2581 while encoding; no UTF-8 text holds it
CACHED_WORDS = 500_000
PLAIN = 64  # longer runs without a space are committed in parts
_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@dataclass(frozen=True)
class Pieces:
    """Vocabulary of a model: scores by piece, the bytes each id stands for, the ids of single bytes."""

    scores: dict[str, tuple[int, float]]
    spelled: tuple[bytes, ...]
    byte_ids: tuple[int, ...]
    unknown: float

    @property
    def max_len(self) -> int:
        return max(map(len, self.scores), default=1)


def load_pieces(path: str) -> Pieces:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, spelled, byte_ids = {}, [], [0] * 256
    for i in range(m.get_piece_size()):
        piece = m.id_to_piece(i)
        if m.is_byte(i):
            byte_ids[value := int(piece[3:5], 16)] = i
            spelled.append(bytes([value]))
        elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            spelled.append(b"")
        else:
            scores[piece] = (i, m.get_score(i))
            spelled.append(piece.replace(SPACE, " ").encode())
    return Pieces(scores, tuple(spelled), tuple(byte_ids), min((s for _, s in scores.values()), default=0.0) - 10)


class Codec:
    def __init__(self, pieces: Pieces, cached: int = CACHED_WORDS):
        self.pieces, self.cached = pieces, cached
        self.max_len = pieces.max_len
        #: Scores of pieces, and with -inf the beginnings of pieces that are none themselves.
        self.trie = {p[:n]: -math.inf for p in pieces.scores for n in range(1, len(p))} | {p: s for p, (_, s) in pieces.scores.items()}
        self.ids = {p: i for p, (i, _) in pieces.scores.items()}
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in pieces.scores)
        self.words: dict[str, bytes] = {}

    def _bytes_of(self, char: str) -> list[int]:
        raw = SPACE.encode() if char == LITERAL else char.encode("utf-8", "surrogatepass")
        return [self.pieces.byte_ids[b] for b in raw]

    def _spell(self, run: str, start: int, end: int) -> list[int]:
        i = self.ids.get(run[start:end])
        return self._bytes_of(run[start]) if i is None else [i]

    def short(self, run: str) -> list[int]:
        """Ids of a run that is committed as a whole."""
        get, longest, unknown, n = self.trie.get, self.max_len, self.pieces.unknown, len(run)
        score, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
        for i in range(n):
            here = score[i]
            for j in range(i + 1, min(i + longest, n) + 1):
                s = get(run[i:j])
                if s is None:
                    break
                if here + s > score[j]:
                    score[j], back[j] = here + s, i
            if run[i] not in self.ids and here + unknown > score[i + 1]:
                score[i + 1], back[i + 1] = here + unknown, i
        parts, p = [], n
        while p:
            parts.append(self._spell(run, back[p], p))
            p = back[p]
        return [i for part in reversed(parts) for i in part]

    def stream(self, run: str) -> Iterator[list[int]]:
        """Ids of a run of characters in committed parts.

        ``score`` holds the places from which or to which a piece can still come; ``back`` the starts of the
        best last pieces since the last commit.
        """
        get, longest, unknown, n, done = self.trie.get, self.max_len, self.pieces.unknown, len(run), 0
        score: dict[int, float] = {0: 0.0}
        back: dict[int, int] = {}
        for i in range(n):
            here = score.pop(i)
            for j in range(i + 1, min(i + longest, n) + 1):
                s = get(run[i:j])
                if s is None:
                    break
                if here + s > score.get(j, -math.inf):
                    score[j], back[j] = here + s, i
            if run[i] not in self.ids and here + unknown > score.get(i + 1, -math.inf):
                score[i + 1], back[i + 1] = here + unknown, i
            if (i + 1) % PLAIN == 0 and i + 1 < n and (met := self._meeting(back, i + 1, done)) > done:
                yield self._path(run, back, done, met)
                done = met
        if n > done:
            yield self._path(run, back, done, n)

    def _meeting(self, back: dict[int, int], at: int, done: int) -> int:
        """The last boundary that the best paths to ``at`` and to all later places reached so far share."""
        live = {p for p in back if p >= at}
        while len(live) > 1:
            last = max(live)
            live.discard(last)
            live.add(back[last])
        return max(live.pop(), done)

    def _path(self, run: str, back: dict[int, int], done: int, end: int) -> list[int]:
        parts: list[list[int]] = []
        p = end
        while p > done:
            parts.append(self._spell(run, back[p], p))
            p = back[p]
        for p in [p for p in back if p <= end]:
            del back[p]
        return [i for part in reversed(parts) for i in part]

    def _word(self, word: str) -> bytes:
        run = SPACE + word
        ids = np.array(self.short(run) if len(run) <= PLAIN else [i for part in self.stream(run) for i in part], "<u4").tobytes()
        if len(run) <= PLAIN:
            if len(self.words) >= self.cached:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as unsigned 32-bit integers."""
        if not text:
            return np.zeros(0, "<u4")
        if SPACE in text:
            text = text.replace(SPACE, LITERAL)
        if not self.cuts:
            return np.array([i for part in self.stream(SPACE + text.replace(" ", SPACE)) for i in part], "<u4")
        words = text.split(" ")
        if "" in words:  # spaces in a row, or at an end
            words = [run[1:] for run in _RUNS.findall(SPACE + text.replace(" ", SPACE))]
        known = self.words.get
        return np.frombuffer(b"".join([known(w) or self._word(w) for w in words]), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        spelled = self.pieces.spelled
        return b"".join([spelled[i] for i in ids.tolist()])[1:].decode("utf-8", "replace")


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``ids`` and ``decoded``: whether decoding them gives the text again."""
    shared, key = docs.sparkSession.sparkContext.broadcast(pieces), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(key, lambda: Codec(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = texts_of(part.column(1))
                ids = [codec.encode(t) if t else np.zeros(0, "<u4") for t in texts]
                same = [None if t is None else codec.decode(x) == t for t, x in zip(texts, ids, strict=True)]
                flat = list_array(np.concatenate(ids).astype(np.int32), np.array([len(x) for x in ids]), pa.int32())
                column = pa.ListArray.from_arrays(flat.offsets, flat.values, mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([part.column(0), column, pa.array(same, pa.bool_())], names=["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>, decoded boolean").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, pieces: Pieces, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: the id and the text its ids stand for."""
    shared, key = encoded.sparkSession.sparkContext.broadcast(pieces), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(key, lambda: Codec(shared.value))
        for batch in batches:
            texts = [None if x is None else codec.decode(np.array(x, dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"id {kind}, text string").withColumnRenamed("id", id_col)
