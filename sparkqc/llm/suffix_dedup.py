"""Removal of repeated byte strings with suffix arrays.

A byte goes if it is covered by a string of ``length`` bytes that also starts anywhere else: in another document, or
elsewhere in the same one. Matches lie within one document; all strings are judged on the input.

1. Candidates. Each string of ``length`` bytes (a window) is named by the smallest hash of its ``K``-byte grams. Equal windows have
   equal names, so all places of a repeated window have one name. Consecutive windows with one name are a stretch: about one
   for every ``length / 2`` bytes, with a name and a 96-bit hash of its bytes. Names with one stretch alone are settled.
2. Classes. Equal stretches are one class; with two members it is repeated as a whole, and one member stands for it.
3. Shards. Stretches of names that have several classes are dealt by name to shards of about ``SHARD`` bytes. A shard
   builds its suffix array by Larsson-Sadakane refinement: suffixes are sorted by their first bytes, then only those in groups of several are
   sorted on by the rank of the suffix behind what is known to be equal, which doubles what is known.
   Kasai's rule gives the common prefixes of neighbours, in lanes: it runs along all stretches at once, a step at a time.
   Neighbours with ``length`` bytes in common are repeated.
4. Merging. Names with more bytes than a shard (a passage that very many documents share) are dealt to several shards. What each of them
   leaves open goes out as sorted 128-bit names of windows, cut at fixed bounds by binary search; for each part one
   task looks the windows of every shard up among those of all, by binary search again.
5. The repeated places of a class are those of all its members; spans of a document are united.

No pairs of places are made anywhere, and no group of places meets in one task: hot names are counted by partial aggregates,
hot classes are joined with one row each. Hash names decide which stretches are compared, and equal 96-bit (128-bit) hashes of
stretches (windows) count as equal bytes.

Defined results: a null or empty text has 0 bytes and no span; texts under ``length`` bytes have none; a text of any
length is handled whole, in pieces; rows with equal id and text are places of their own (so both are repeated) and get the same
result; a null id is an id like others. Cuts may fall inside a character: what is left is binary. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.llm.common import U64, mix64, staged

LENGTH = 400
K = 24
SHARD = 1 << 20
PIECE = 1 << 19  # windows of a text that are looked at together
SEGMENT = 1 << 20
LANE = 1024
_PLACE = U64((1 << 24) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
SPANS = "array<struct<a:long,b:long>>"


# ---- hashes ----------------------------------------------------------------------------------------------------

def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(20, n.bit_length())
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        have = _POWERS[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have


class Hashes:
    """Hashes of any substrings of ``raw``."""

    def __init__(self, raw: np.ndarray):
        self.sums = []
        for base in _BASES:
            sums = np.zeros(len(raw) + 1, U64)
            np.cumsum((raw.astype(U64) + U64(1)) * _powers(base, len(raw))[0][:len(raw)], out=sums[1:])
            self.sums.append(sums)

    def of(self, begin: np.ndarray | slice, end: np.ndarray | slice, which: int) -> np.ndarray:
        sums, down = self.sums[which], _POWERS[_BASES[which]][1]
        low = begin if isinstance(begin, np.ndarray) else slice(begin.start, begin.stop)
        return mix64((sums[end] - sums[begin]) * down[low])


def stretches(texts: list[bytes], length: int, k: int) -> tuple[np.ndarray, ...]:
    """``(text, start, windows, anchors, name, f1, f2)`` of every stretch; ``texts`` hold at most a few segments."""
    found: list[tuple[np.ndarray, ...]] = []
    pieces = [(i, at, t[at:at + PIECE + length - 1]) for i, t in enumerate(texts) for at in range(0, max(0, len(t) - length + 1), PIECE)]
    lo = 0
    while lo < len(pieces):
        hi, size = lo, 0
        while hi < len(pieces) and (hi == lo or size + len(pieces[hi][2]) <= SEGMENT):
            size += len(pieces[hi][2])
            hi += 1
        found.append(_stretches(pieces[lo:hi], length, k))
        lo = hi
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, U64, U64, U64))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _stretches(pieces: list[tuple[int, int, bytes]], length: int, k: int) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    sizes = np.array([len(p[2]) for p in pieces], np.int64)
    begins = np.cumsum(sizes) - sizes
    hashes = Hashes(raw)
    n = len(raw) - k + 1
    grams = hashes.of(slice(0, n), slice(k, len(raw) + 1), 0)
    wide = length - k + 1
    padded = np.full(-(-n // wide) * wide, np.iinfo(U64).max, U64)
    padded[:n] = (grams & ~_PLACE) | np.arange(n, dtype=U64)  # the smallest hash, the first of equal ones
    blocks = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = sizes - length + 1  # of each piece, one at least
    piece = np.repeat(np.arange(len(pieces)), windows)
    at = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows) + begins[piece]
    anchor = (np.minimum(back[at], ahead[at + wide - 1]) & _PLACE).astype(np.int64)
    name = grams[anchor]
    first = np.ones(len(at), bool)
    first[1:] = (name[1:] != name[:-1]) | (piece[1:] != piece[:-1])
    lows = np.flatnonzero(first)
    highs = np.concatenate([lows[1:], [len(at)]])
    moved = np.ones(len(at), np.int64)
    moved[1:] = anchor[1:] != anchor[:-1]
    moves = np.concatenate([[0], np.cumsum(moved)])
    start, end = at[lows], at[highs - 1] + length
    texts, offsets = (np.array([p[i] for p in pieces], np.int64) for i in (0, 1))
    own = piece[lows]
    return (texts[own], offsets[own] + start - begins[own], highs - lows, moves[highs] - moves[lows + 1] + 1, name[lows], hashes.of(start, end, 0), hashes.of(start, end, 1) >> U64(32))


# ---- suffix arrays ---------------------------------------------------------------------------------------------

def _order(high: np.ndarray, low: np.ndarray, top: int) -> np.ndarray:
    """Stable order by (high, low), both below ``top``."""
    bits = max(1, int(top).bit_length())
    place = max(1, len(high).bit_length())
    if 2 * bits + place <= 64:  # one sort of plain numbers
        packed = (high.astype(U64) << U64(bits + place)) | (low.astype(U64) << U64(place)) | np.arange(len(high), dtype=U64)
        packed.sort()
        return (packed & U64((1 << place) - 1)).astype(np.int64)
    return np.lexsort((low, high))


def suffix_array(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffix array of ``text``, strings of numbers from 1 to 255 that each end with eight zeros.

    ``left`` has the bytes from a place to the end of its string; a suffix ends there, and equal suffixes are in the order of their places.
    """
    n = len(text)
    head = np.zeros(n, U64)
    inside = np.ones(n, bool)
    known = 5
    for i in range(known):
        step = np.zeros(n, np.uint8)
        step[:n - i] = text[i:]
        inside &= step > 0
        head = (head << U64(8)) | np.where(inside, step, 0).astype(U64)
    place = max(1, n.bit_length())
    if 8 * known + place <= 64:
        packed = (head << U64(place)) | np.arange(n, dtype=U64)
        packed.sort()
        order = (packed & U64((1 << place) - 1)).astype(np.int64)
    else:
        order = np.argsort(head, kind="stable")
    rank = np.empty(n, np.int64)
    head = head[order]
    first = np.ones(n, bool)
    first[1:] = head[1:] != head[:-1]
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = group
    open_ = _in_groups(group) & (left[order] >= known)  # an ended suffix equals the others of its group
    places = np.flatnonzero(open_)
    while len(places):
        suffixes = order[places]
        behind = np.where(suffixes + known < n, rank[np.minimum(suffixes + known, n - 1)], 0)
        by = _order(group[places], behind, n)
        order[places] = suffixes = suffixes[by]
        behind, before = behind[by], group[places]
        fresh = np.ones(len(places), bool)
        fresh[1:] = (behind[1:] != behind[:-1]) | (before[1:] != before[:-1])
        named = np.maximum.accumulate(np.where(fresh, places, 0))
        group[places] = named
        rank[suffixes] = named
        known *= 2
        places = places[_in_groups(named) & (left[suffixes] >= known)]
    return order


def _in_groups(group: np.ndarray) -> np.ndarray:
    """Which members of a sorted list of groups are not alone."""
    same = group[1:] == group[:-1]
    out = np.zeros(len(group), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def common_prefixes(text: np.ndarray, order: np.ndarray, left: np.ndarray, begins: np.ndarray, sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For every place the suffix before its own in the array, and their common prefix up to ``most`` (Kasai's rule).

    The strings at ``begins`` are cut into lanes of LANE places; ``left`` has the bytes to the end of each string.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = np.zeros(n + 8, U64)
    for i in range(8):
        words[:n - i] |= text[i:].astype(U64) << U64(8 * i)
    out = np.zeros(n, np.int32)
    cuts = -(-sizes // LANE)
    lane_at = np.repeat(begins, cuts) + LANE * (np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts))
    lane_size = np.minimum(LANE, np.repeat(begins + sizes, cuts) - lane_at)
    by = np.argsort(-lane_size, kind="stable")
    lane_at, lane_size = lane_at[by], lane_size[by]
    shared = np.zeros(len(lane_at), np.int64)
    for step in range(int(lane_size.max(initial=0))):
        lanes = int(np.searchsorted(-lane_size, -step, side="left"))
        here = lane_at[:lanes] + step
        other = before[here]
        have = np.maximum(shared[:lanes] - 1, 0)
        upto = np.minimum(np.minimum(left[here], np.where(other >= 0, left[other], 0)), most)
        have = np.minimum(have, upto)
        going = np.flatnonzero(have < upto)
        wide = np.zeros(1, np.int64)
        while len(going):  # eight bytes, as is mostly enough, then all that may follow at once
            a, b = here[going] + have[going], other[going] + have[going]
            differ = words[np.minimum(a[:, None] + wide, n)] ^ words[np.minimum(b[:, None] + wide, n)]
            at = (differ != 0).argmax(1)
            first = differ[np.arange(len(at)), at]
            low = first & (~first + U64(1))  # the lowest bit that differs
            same = np.where(first == 0, 8 * len(wide), 8 * at + (np.bitwise_count(low - U64(1)) >> 3).astype(np.int64))
            have[going] = np.minimum(have[going] + same, upto[going])
            going = going[(first == 0) & (have[going] < upto[going])]
            wide = np.arange(0, most, 8)
        shared[:lanes] = have
        out[here] = have
    return before, out


def repeated_windows(contents: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the contents in one array, the array, marks of repeated windows, marks of windows after an equal one in the suffix array)."""
    sizes = np.array([len(c) for c in contents], np.int64)
    begins = np.cumsum(sizes + 8) - sizes - 8
    plain = np.frombuffer(b"".join(c + bytes(8) for c in contents), np.uint8)
    text = plain + np.uint8(1)  # UTF-8 has no byte 255
    owner = np.repeat(np.arange(len(sizes)), sizes + 8)
    left = np.maximum(0, begins[owner] + sizes[owner] - np.arange(len(text)))
    text = np.where(left > 0, text, 0).astype(np.uint8)
    order = suffix_array(text, left)
    before, shared = common_prefixes(text, order, left, begins, sizes, length)
    later = shared >= length
    marks = later.copy()
    marks[before[later]] = True
    return begins, plain, marks, later


def spans_of(starts: np.ndarray, length: int) -> list[dict[str, int]]:
    """Maximal runs of bytes covered by windows at sorted ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    lows = starts[np.concatenate([[0], cut + 1])]
    highs = starts[np.concatenate([cut, [len(starts) - 1]])] + length
    return [{"a": int(a), "b": int(b)} for a, b in zip(lows, highs, strict=True)]


# ---- Spark -----------------------------------------------------------------------------------------------------

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, key, text)``: (id, key) names a row by what it holds, so it is the same in every rerun."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == U64 else x.astype(np.int64))


def document_stretches(keyed: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """``(id, key, start, windows, anchors, name, f1, f2)``."""
    id_type = keyed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                own, start, windows, anchors, name, f1, f2 = stretches(_texts(part.column(2)), length, k)
                rows = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), _longs(start), _longs(windows), _longs(anchors), _longs(name), _longs(f1), _longs(f2).cast(pa.int64())],
                    names=["id", "key", "start", "windows", "anchors", "name", "f1", "f2"])

    rows = keyed.where(F.octet_length("text") >= length)
    return rows.mapInArrow(run, f"id {id_type}, key long, start long, windows long, anchors long, name long, f1 long, f2 long")


def _contents(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``(name, part, parts, f1, f2, content)`` of the stretches that stand for their classes."""
    lists = wanted.groupBy(F.col("rep.id").alias("_id"), F.col("rep.key").alias("_key")).agg(
        F.collect_list(F.struct("name", "part", "parts", "f1", "f2", F.col("rep.start").alias("start"), "windows")).alias("items"))
    joined = keyed.where(F.octet_length("text") >= length).join(lists.hint("merge"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).select("text", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["name", "part", "parts", "f1", "f2"]
        for batch in batches:
            for text, items in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
                raw = text.as_py()
                for at in range(0, len(items), 1000):
                    some = items[at:at + 1000]
                    cut = [raw[x["start"]:x["start"] + x["windows"] + length - 1] for x in some]
                    yield pa.RecordBatch.from_arrays([*(pa.array([x[c] for x in some], pa.int64()) for c in names), pa.array(cut, pa.binary())], names=[*names, "content"])

    return joined.mapInArrow(run, "name long, part long, parts long, f1 long, f2 long, content binary")


def _solve(contents: DataFrame, length: int, shard: int) -> DataFrame:
    """``(name, parts, f1, f2, spans, places, windows)``: repeated spans of each class; of names in several shards also the windows left
    open, one for each group of equal ones, by their 128-bit names."""
    def solved(held: list[tuple]) -> pa.RecordBatch:
        begins, plain, marks, later = repeated_windows([h[5] for h in held], length)
        hashes = Hashes(plain) if any(h[2] > 1 for h in held) else None
        spans, places, windows = [], [], []
        for begin, h in zip(begins.tolist(), held, strict=True):
            n = len(h[5]) - length + 1
            spans.append(spans_of(np.flatnonzero(marks[begin:begin + n]), length))
            if h[2] > 1:
                at = np.flatnonzero(~later[begin:begin + n])  # one of each group of equal windows
                both = np.stack([hashes.of(at + begin, at + begin + length, i) for i in (0, 1)], 1)
                places.append(at.astype("<i8").tobytes())
                windows.append(both.astype("<u8").tobytes())
            else:
                places.append(None)
                windows.append(None)
        cols = [pa.array([h[i] for h in held], pa.int64()) for i in (0, 2, 3, 4)]
        return pa.RecordBatch.from_arrays([*cols, pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(places, pa.binary()), pa.array(windows, pa.binary())],
                                          names=["name", "parts", "f1", "f2", "spans", "places", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(5)]
            for *row, content in zip(*cols, batch.column(5), strict=True):
                if size >= shard and last != (row[0], row[1]):
                    yield solved(held)
                    held, size = [], 0
                last = (row[0], row[1])
                held.append((*row, content.as_py()))
                size += len(held[-1][5])
        if held:
            yield solved(held)

    dealt = contents.repartition("name", "part").sortWithinPartitions("name", "part", "f1", "f2")
    return dealt.mapInArrow(run, f"name long, parts long, f1 long, f2 long, spans {SPANS}, places binary, windows binary")


def _merge(found: DataFrame, length: int) -> DataFrame:
    """``(name, f1, f2, spans)``: windows of names in several shards that stand in more than one of them."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                both = np.frombuffer(row["windows"], "<u8").reshape(-1, 2)
                by = np.lexsort((both[:, 1], both[:, 0]))
                both, places = both[by], np.frombuffer(row["places"], "<i8")[by]
                pieces = 4 * row["parts"]
                bounds = np.array([(i << 64) // pieces for i in range(1, pieces)], U64)
                cuts = [0, *np.searchsorted(both[:, 0], bounds).tolist(), len(both)]
                full = [(p, lo, hi) for p, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if hi > lo]
                for at in range(0, len(full), 1000):
                    some = full[at:at + 1000]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([row[c]] * len(some), pa.int64()) for c in ("name", "f1", "f2")), pa.array([x[0] for x in some], pa.int64()),
                         pa.array([places[lo:hi].tobytes() for _, lo, hi in some], pa.binary()), pa.array([both[lo:hi].tobytes() for _, lo, hi in some], pa.binary())],
                        names=["name", "f1", "f2", "piece", "places", "windows"])

    def look_up(rows: list[dict]) -> pa.RecordBatch:
        high, low = np.frombuffer(b"".join(r["windows"] for r in rows), "<u8").reshape(-1, 2).T
        every = np.sort(high)
        maybe = np.flatnonzero(np.searchsorted(every, high, side="right") - np.searchsorted(every, high, side="left") > 1)
        maybe = maybe[np.lexsort((low[maybe], high[maybe]))]
        same = np.flatnonzero((high[maybe[1:]] == high[maybe[:-1]]) & (low[maybe[1:]] == low[maybe[:-1]]))
        several = np.zeros(len(high), bool)
        several[maybe[same]] = several[maybe[same + 1]] = True
        out, at = [], 0
        for r in rows:
            places = np.frombuffer(r["places"], "<i8")
            out.append(spans_of(np.sort(places[several[at:at + len(places)]]), length))
            at += len(places)
        return pa.RecordBatch.from_arrays([*(pa.array([r[c] for r in rows], pa.int64()) for c in ("name", "f1", "f2")), pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                                          names=["name", "f1", "f2", "spans"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (held[-1]["name"], held[-1]["piece"]) != (row["name"], row["piece"]):
                    yield look_up(held)
                    held = []
                held.append(row)
        if held:
            yield look_up(held)

    open_ = found.where("parts > 1").select("name", "parts", "f1", "f2", "places", "windows")
    dealt = open_.mapInArrow(deal, "name long, f1 long, f2 long, piece long, places binary, windows binary")
    return dealt.repartition("name", "piece").sortWithinPartitions("name", "piece").mapInArrow(merge, f"name long, f1 long, f2 long, spans {SPANS}")


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD, k: int = K) -> DataFrame:
    """``(id, key, spans)`` of documents with repeated strings: covered byte ranges, which may overlap. ``key`` is ``xxhash64(text)``."""
    keyed = _keyed(docs, id_col, text_col)
    every = document_stretches(keyed, length, k)
    names = every.groupBy("name").agg(F.count(F.lit(1)).alias("_n"), F.max("anchors").alias("_own")).where("_n > 1 OR _own > 1").select(F.col("name").alias("_name"))
    met = staged(every.join(names.hint("merge"), F.col("name") == F.col("_name"), "left_semi"), "stretches")

    classes = met.groupBy("name", "f1", "f2").agg(F.count(F.lit(1)).alias("members"), F.max("anchors").alias("anchors"), F.first("windows").alias("windows"),
                                                  F.min(F.struct("id", "key", "start")).alias("rep"))
    classes = staged(classes, "stretch-classes")
    several = classes.groupBy("name").agg(F.count(F.lit(1)).alias("_n"), F.max("anchors").alias("_own"), F.sum(F.col("windows") + (length + 7)).alias("_bytes")).where("_n > 1 OR _own > 1")
    several = several.select(F.col("name").alias("_name"), F.ceil(F.col("_bytes") / F.lit(shard)).cast("long").alias("parts"))
    wanted = classes.join(several, F.col("name") == F.col("_name")).withColumn("part", F.pmod(F.xxhash64("f1", "f2"), F.col("parts")))
    contents = _contents(keyed, wanted, length)
    found = staged(_solve(contents, length, shard), "stretch-spans")

    whole = classes.where("members > 1").select("name", "f1", "f2", F.array(F.struct(F.lit(0).cast("long").alias("a"), (F.col("windows") + (length - 1)).alias("b"))).alias("spans"))
    solved = found.where(F.size("spans") > 0).select("name", "f1", "f2", "spans").unionByName(_merge(found, length).where(F.size("spans") > 0)).unionByName(whole)
    results = solved.groupBy(F.col("name").alias("_n"), F.col("f1").alias("_1"), F.col("f2").alias("_2")).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    placed = met.join(results, (F.col("name") == F.col("_n")) & (F.col("f1") == F.col("_1")) & (F.col("f2") == F.col("_2")))
    shifted = placed.select("id", "key", F.transform("spans", lambda s: F.struct((s["a"] + F.col("start")).alias("a"), (s["b"] + F.col("start")).alias("b"))).alias("spans"))
    return shifted.groupBy("id", "key").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD, k: int = K) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes``, ``spans`` (removed byte ranges, maximal and in order) and ``kept`` (binary)."""
    keyed = _keyed(docs, id_col, text_col)
    found = repeated_spans(docs, length, id_col, text_col, shard, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            united, kept = [], []
            for text, spans in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
                raw, runs, left, at = text.as_py() or b"", [], [], 0
                for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                for a, b in runs:
                    left.append(raw[at:a])
                    at = b
                left.append(raw[at:])
                united.append([{"a": a, "b": b} for a, b in runs])
                kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(united, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(kept, pa.binary())], names=["id", "spans", "kept"])

    id_type = keyed.schema["id"].dataType.simpleString()
    long_enough = F.octet_length("text") >= length
    spans = found.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "spans").hint("merge")
    cut = keyed.where(long_enough).join(spans, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left").select("id", "text", "spans")
    cut = cut.mapInArrow(run, f"id {id_type}, spans {SPANS}, kept binary")
    short = keyed.where(~F.coalesce(long_enough, F.lit(False))).select("id", F.lit(None).cast(SPANS).alias("spans"), F.coalesce(F.encode("text", "utf-8"), F.lit(b"")).alias("kept"))
    both = cut.unionByName(short.withColumn("spans", F.coalesce("spans", F.array().cast(SPANS))))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return both.select(F.col("id").alias(id_col), (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), "spans", "kept")


def digest(cut: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` of the rows of ``remove_repeats``."""
    removed = F.col("n_bytes") - F.octet_length("kept")
    return cut.select(id_col, "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, row_number() OVER () AS r FROM documents),
w AS (SELECT r, UNNEST(range(0, length(x) // 2 - 399)) AS i, x FROM d WHERE length(x) >= 800),
h AS (SELECT r, i, md5(substr(x, 2 * i + 1, 800)) AS m FROM w),
m AS (SELECT r, i FROM h QUALIFY count(*) OVER (PARTITION BY m) > 1),
g AS (SELECT r, i, i - 400 > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -10000) AS fresh FROM m),
s AS (SELECT r, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY r ORDER BY i) AS k FROM g),
p AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM s GROUP BY r, k),
q AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS e FROM p),
k AS (SELECT q.r, count(*) AS n, sum(b - a) AS gone, max(b) AS z, string_agg(substr(x, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) AS t FROM q JOIN d ON q.r = d.r GROUP BY q.r)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN x ELSE t || substr(x, 2 * z + 1) END)) AS kept_sha256
FROM d LEFT JOIN k ON d.r = k.r
"""
