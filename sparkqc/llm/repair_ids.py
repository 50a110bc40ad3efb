"""Token ids in binary files, compressed by a Re-Pair grammar per shard.

Documents are range-dealt by id and sorted, encoded with a public tokenizer (an end id closes each document) and
packed into shards of about ``shard_ids`` ids. In each shard frequent pairs of symbols become nonterminals, again and
again: a round counts all pairs, gives the most frequent a rule each, and replaces the places that no better pair
overlaps, until no pair within documents stands ``MIN_PAIRS`` times. No rule crosses the end of a document, so a document is a run of symbols and can be decoded alone; the expansion
lengths of the rules give the place of every id without decoding.

A shard is one binary value: a header of six unsigned 64-bit integers (version, documents, ids, rules, symbols, first new symbol), then little-endian
arrays: document ids and null marks, first symbol of each document, ids before each document, rules (left, right), their
expansion lengths, and the symbols. Shards are rows (part, seq, n_ids, payload) of a Parquet table in a folder that all
executors share; (part, seq) is the order of ids.

The tokenizer drops white space between words, so a text is encoded word by word, each distinct word of some megabytes of texts once, with a bounded table of known pieces; the ids are
those of the whole text. Defined results: null and empty texts have the end id alone; null ids come first; rows with equal ids are in
the order of their texts. Other columns are not read.
"""

from __future__ import annotations

import operator
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqc.llm.common import kept
from sparkqc.operators.ranking import cumulative_sums
from sparkqc.session import ensure_checkpoint_dir

END = 1
SHARD_IDS = 1_000_000
ROUNDS = None  # until no pair is frequent
RULES_PER_ROUND = 4096  # the others come in the rounds after it
MIN_PAIRS = 12
CACHED_WORDS = 600_000
TEXT_BYTES = 1 << 22  # texts that are encoded together
_BUCKETS = 18
SHARD_SCHEMA = "part long, seq long, n_ids long, payload binary"


# ---- tokenizer -------------------------------------------------------------------------------------------------

def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is a visible Latin-1 character, else the next letter from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return [chr(x) if x in own else chr(0x100 + sum(y not in own for y in range(x))) for x in range(256)]


class WordEncoder(dict):
    """Ids of whole texts by way of their words between spaces and line ends, which the tokenizer never joins.

    Texts are cut into words in Arrow columns, and each distinct word of a batch is encoded once. Words of visible Latin-1 characters are cut
    as the tokenizer's pattern cuts them and go to the library's BPE model piece by piece; all others, and any that may hold a special token, go
    through its whole pipeline. The ids of pieces, and of words that are not letters and marks, are kept as bytes, up to a bound.
    """

    #: Letters, then marks that make one piece: an apostrophe may begin a piece, "<" a special token.
    _usual = r"^(?P<body>[A-Za-zªµºÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:;=-@\[-`{-~]*)$"
    _plain = re.compile(r"[!-~\xA1-\xAC\xAE-\xFF]+")
    _cut = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xAA\xB5\xBA\xDF-\xF6\xF8-\xFF]+|[0-9\xB2\xB3\xB9\xBC-\xBE]|[^\sa-z0-9\xAA\xB5\xBA\xDF-\xF6\xF8-\xFF\xB2\xB3\xB9\xBC-\xBE]+")

    def __init__(self, definition: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(_byte_letters()))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cached = cached
        self.pieces: dict[str, bytes] = {"": b""}

    def _piece(self, piece: str) -> bytes:
        if (ids := self.pieces.get(piece)) is None:
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            ids = self.pieces[piece] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return ids

    def __missing__(self, word: str) -> bytes:
        if self._plain.fullmatch(word) and not ("<" in word and any(t in word for t in self.special)):
            ids = b"".join(map(self._piece, self._cut.findall(word.lower())))
        else:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids

    def _pieces_of(self, column: pa.StringArray) -> list[bytes]:
        found = pc.dictionary_encode(pc.fill_null(column, ""))
        ids = [self._piece(p) for p in found.dictionary.to_numpy(zero_copy_only=False)]
        return [ids[i] for i in found.indices.to_numpy().tolist()]

    def _ids_of(self, words: pa.StringArray) -> list[bytes]:
        """Ids of distinct words: of letters with marks behind them, as most are, by their two pieces; of the others one by one."""
        usual = pc.extract_regex(words, self._usual)
        bodies, marks = pc.struct_field(usual, "body"), pc.struct_field(usual, "marks")
        ids = list(map(operator.add, self._pieces_of(pc.utf8_lower(bodies)), self._pieces_of(marks)))
        others = np.flatnonzero(pc.is_null(bodies).to_numpy(zero_copy_only=False))
        for i, w in zip(others.tolist(), words.take(pa.array(others)).to_pylist(), strict=True):
            ids[i] = self[w]
        return ids

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self) > self.cached:
            self.clear()
        if len(self.pieces) > self.cached:
            self.pieces = {"": b""}
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(column, ""), "\n", " "), " ")
        words = pc.dictionary_encode(cut.flatten())
        known = self._ids_of(words.dictionary)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        which = words.indices.to_numpy()
        n = sizes[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat((np.cumsum(sizes) - sizes)[which] - upto[:-1], n)
        place += np.arange(len(place))
        ids = np.frombuffer(b"".join(known), "<u4")[place].tobytes()
        bounds = (4 * upto[cut.offsets.to_numpy()]).tolist()
        return [ids[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]


# ---- grammar ---------------------------------------------------------------------------------------------------

def _frequent_pairs(keys: np.ndarray, most: int | None, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that stand ``least`` times or more, the most frequent first, and for every place the rank of its pair (or a large number).

    Pairs are counted by one sort of plain numbers, a pair and its place each. Where these need more than 64 bits, places whose bucket
    holds fewer than ``least`` are left out and the others sorted by their pairs. All counts are exact.
    """
    n, never = len(keys), np.iinfo(np.int32).max
    dealt, right = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
    bits, place = int(max(dealt.max(initial=0), right.max(initial=0))).bit_length(), n.bit_length()
    if 2 * bits + place <= 64:
        dealt <<= np.uint64(bits)
        dealt |= right
        dealt <<= np.uint64(place)
        dealt |= np.arange(n, dtype=np.uint64)
        dealt.sort()
        order = (dealt & np.uint64((1 << place) - 1)).view(np.int64)
        dealt >>= np.uint64(place)
    else:
        bucket = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BUCKETS)).view(np.int64)
        order = np.flatnonzero((np.bincount(bucket, minlength=1 << _BUCKETS) >= least)[bucket])
        order = order[np.argsort(keys[order], kind="stable")]
        dealt = keys[order]
    fresh = np.ones(len(dealt), bool)
    fresh[1:] = dealt[1:] != dealt[:-1]
    begins = np.flatnonzero(fresh)
    counts = np.diff(begins, append=len(dealt))
    best = np.flatnonzero(counts >= least)
    pairs = keys[order[begins[best]]]
    by = np.lexsort((pairs, -counts[best]))[:most]
    rank = np.full(len(counts), never, np.int32)
    rank[best[by]] = np.arange(len(by), dtype=np.int32)
    ranks = np.full(n, never, np.int32)
    ranks[order] = np.repeat(rank, counts)
    return pairs[by], ranks


def compress(ids: np.ndarray, ends: np.ndarray, rounds: int | None = ROUNDS, most: int | None = RULES_PER_ROUND, least: int = MIN_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, marks of the last symbol of each document, rules as pairs, first new symbol).

    Without ``rounds`` it goes on until no pair stands ``least`` times; every round makes a rule, so it ends.
    """
    symbols, last, n = ids.astype(np.uint32), ends.copy(), len(ids)
    first = int(symbols.max(initial=0)) + 1
    rules: list[np.ndarray] = []
    new = first
    never = np.iinfo(np.int32).max
    # Symbols stay at their places, so a round touches only the places it counts; n, the last item of these lists, is no place.
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    rank = np.full(n + 1, never, np.int32)  # of the pair that starts at a place
    alive = np.ones(n, bool)
    open_ = np.zeros(n + 1, bool)  # places whose pair may be frequent: pairs only grow rarer, but for those with a new symbol
    open_[:max(0, n - 1)] = ~last[:-1]
    while rounds is None or len(rules) < rounds:
        at = np.flatnonzero(open_)
        keys = symbols[at].astype(np.uint64)
        keys <<= np.uint64(32)
        keys |= symbols[after[at]]
        pairs, ranks = _frequent_pairs(keys, None, least)
        if not len(pairs):
            break
        open_[at] = ranks < never
        pairs = pairs[:most]
        now = np.flatnonzero(ranks < len(pairs))
        at, here = at[now], ranks[now]
        rank[at] = here
        ahead, behind = rank[before[at]], rank[after[at]]
        rank[at] = never
        best = (here <= ahead) & (here <= behind)
        begins = np.flatnonzero(here != ahead)
        # neighbours of one rank are a run of one symbol: every second place of it
        inner = np.flatnonzero(best & (here == ahead))
        if len(inner):
            best[inner[(inner - begins[np.searchsorted(begins, inner, side="right") - 1]) % 2 == 1]] = False
        at, here = at[best], here[best]
        taken = np.bincount(here, minlength=len(pairs)) > 0
        used, which = np.flatnonzero(taken), (np.cumsum(taken) - 1)[here]
        gone = after[at]
        symbols[at] = new + which.astype(np.uint32)
        last[at] = last[gone]
        after[at] = follow = after[gone]
        before[follow] = at
        alive[gone] = open_[gone] = False
        open_[at] = ~last[at] & (follow < n)
        ahead = before[at]
        ahead = ahead[ahead >= 0]
        open_[ahead] = ~last[ahead]
        rules.append(np.stack([pairs[used] >> np.uint64(32), pairs[used] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        new += len(used)
    return symbols[alive], last[alive], np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), first


def pack(doc_ids: list[int | None], coded: list[bytes]) -> bytes:
    """One shard from documents in order and their ids, end ids included."""
    lengths = np.array([len(x) // 4 for x in coded], np.int64)
    ends = np.zeros(int(lengths.sum()), bool)
    ends[np.cumsum(lengths) - 1] = True
    symbols, last, rules, first = compress(np.frombuffer(b"".join(coded), "<u4"), ends)
    spans = np.ones(first + len(rules), np.int64)
    for n, (a, b) in enumerate(rules.tolist()):
        spans[first + n] = spans[a] + spans[b]
    starts = np.concatenate([[0], np.flatnonzero(last) + 1])
    header = np.array([1, len(doc_ids), int(lengths.sum()), len(rules), len(symbols), first], "<u8")
    arrays = [np.array([x or 0 for x in doc_ids], "<i8"), np.array([x is None for x in doc_ids], "u1"), starts.astype("<u4"),
              np.concatenate([[0], np.cumsum(lengths)]).astype("<u8"), rules.astype("<u4"), spans[first:].astype("<u4"), symbols.astype("<u4")]
    return b"".join([header.tobytes(), *(a.tobytes() for a in arrays)])


class Shard:
    """Random access to a packed shard."""

    def __init__(self, payload: bytes):
        version, docs, self.n_ids, n_rules, n_symbols, self.first = (int(x) for x in np.frombuffer(payload, "<u8", 6))
        if version != 1:
            raise ValueError(f"shard version {version}")
        at = 48

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        ids, null = read("<i8", docs), read("u1", docs)
        self.doc_ids = [None if z else int(x) for x, z in zip(ids, null, strict=True)]
        self.starts, self.before = read("<u4", docs + 1), read("<u8", docs + 1)
        self.rules = read("<u4", 2 * n_rules).reshape(-1, 2)
        self.spans, self.symbols = read("<u4", n_rules), read("<u4", n_symbols)
        self._table: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all symbols one after another, where each symbol's begin, and how many it has."""
        if self._table is None:
            spelled: list[bytes] = []
            for a, b in self.rules.tolist():
                spelled.append((a.to_bytes(4, "little") if a < self.first else spelled[a - self.first])
                               + (b.to_bytes(4, "little") if b < self.first else spelled[b - self.first]))
            spans = np.concatenate([np.ones(self.first, np.int64), self.spans.astype(np.int64)])
            self._table = (np.concatenate([np.arange(self.first, dtype="<u4"), np.frombuffer(b"".join(spelled), "<u4")]), np.concatenate([[0], np.cumsum(spans)[:-1]]), spans)
        return self._table

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, begins, spans = self._expansions()
        n = spans[symbols]
        ends = np.cumsum(n)
        place = np.repeat(begins[symbols] - (ends - n), n)
        place += np.arange(len(place))
        return flat[place]

    def document(self, n: int) -> np.ndarray:
        """Ids of the n-th document, decoded alone."""
        return self.expand(self.symbols[self.starts[n]:self.starts[n + 1]])

    def documents(self, most: int = 1 << 18) -> Iterator[np.ndarray]:
        """Ids of all documents in order, some at a time."""
        n = 0
        while n < len(self.doc_ids):
            end = max(n + 1, int(np.searchsorted(self.before, int(self.before[n]) + most, side="right")) - 1)
            ids = self.expand(self.symbols[self.starts[n]:self.starts[end]])
            at = (self.before[n:end + 1] - self.before[n]).astype(np.int64)
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                yield ids[lo:hi]
            n = end

    def id_at(self, place: int) -> int:
        """The id at a place of the shard: expansion lengths lead to its symbol, then down its rules."""
        lengths = np.where(self.symbols < self.first, 1, self.spans[np.maximum(self.symbols.astype(np.int64) - self.first, 0)] if len(self.spans) else 1)
        upto = np.cumsum(lengths)
        n = int(np.searchsorted(upto, place, side="right"))
        x, place = int(self.symbols[n]), place - int(upto[n] - lengths[n])
        while x >= self.first:
            a, b = (int(v) for v in self.rules[x - self.first])
            size = 1 if a < self.first else int(self.spans[a - self.first])
            x, place = (a, place) if place < size else (b, place - size)
        return x


# ---- Spark -----------------------------------------------------------------------------------------------------

def write_ids(docs: DataFrame, tokenizer_file: str, path: str, shard_ids: int = SHARD_IDS, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode ``docs`` in ascending id order into shards below ``path``."""
    with open(tokenizer_file, encoding="utf-8") as f:  # a vocabulary file on the driver; executors get it by broadcast
        shared, key = docs.sparkSession.sparkContext.broadcast(f.read()), uuid.uuid4().hex
    close = int(end).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = kept(key, lambda: WordEncoder(shared.value)), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        coded: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([held], pa.int64()), pa.array([pack(ids, coded)], pa.binary())],
                                              names=["part", "seq", "n_ids", "payload"])

        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
            cuts = [0, *(np.flatnonzero(np.diff(upto // TEXT_BYTES)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                piece = batch.slice(lo, hi - lo)
                for i, x in zip(piece.column(0).to_pylist(), encoder.encode(piece.column(1)), strict=True):
                    ids.append(i)
                    coded.append(x + close)
                    held += len(x) // 4 + 1
                    if held >= shard_ids:
                        yield flush()
                        ids, coded, held, seq = [], [], 0, seq + 1
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(run, SHARD_SCHEMA).write.parquet(path)
    return path


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32``, decoded from the files."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    before = cumulative_sums(shards.select("part", "seq", "n_ids"), [], ["part", "seq"], weight="n_ids").select("part", "seq", F.col("cum_before").alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = Shard(payload.as_py())
                found = [(len(x), zlib.crc32(x)) for x in shard.documents()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(shard.before[:-1].astype(np.int64) + base),
                     pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.join(before, ["part", "seq"]).select("before", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def shard_folder(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"token-shards-{uuid.uuid4().hex}")
