"""N-gram Jaccard join with parity sketches.

A document is the set of its word shingles, as 64-bit hashes. Tokens are XOR-ed into sketches, so tokens that two sets
share cancel, and sketches can differ by no more than the symmetric difference of the sets:

* A pair of sets of up to ``hi`` tokens with a Jaccard similarity of ``num / den`` differs by at most
  ``d = 2 hi (den - num) / (den + num)`` tokens. Sets are split into size bands; a set takes part in its own band and, if a
  larger partner may stand there, in the next.
* Pigeonhole: a band's sketch has some more than ``d`` chunks, each the XOR of the hashes of its tokens. A differing token changes
  one chunk, so some chunks are equal; a set with more non-empty chunks than tokens by which any partner of the band can differ has an equal one
  among these and needs no keys for empty chunks, which unlike sets share too. Equal (band, chunk, XOR) is the join key.
* A second sketch of 512 parity bits goes with each set. Its Hamming distance is a lower bound of the symmetric
  difference too, and pairs beyond their own d are not emitted.
* Pairs that are left are held to a third sketch, whose size grows with the set, and then verified on the sets themselves.

Equal sets are one class and take part once. Buckets of near copies would give all pairs, of which the components need
few: first the neighbours in each bucket (sorted by sketch) are verified and joined to components, in rounds over one key in 64, in 8 and all, then only
pairs across components, bucket by bucket in blocks of bounded size. Keys are shuffled once, with nothing but an id, and
only those that several rows share go on. Each set carries its smallest keys, so a pair that shares a
smaller key is left to that key's bucket. No bucket is capped, and no link between components is lost.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing; with fewer words
than a shingle, the whole sequence is one shingle. A null id gets a null component. Rows that share an id may be linked through it. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.llm.common import U64, forget, let_go, list_array, mix64, staged, texts_of
from sparkqc.llm.components import components

SEGMENT = 1 << 19  # a word of eight bytes and its powers for each byte: what a worker keeps and needs at a time grows with it
SKETCH_BITS = 512
BAND_RATIO = 1.4
BLOCK = 512  # documents of a bucket that one task compares with as many others
SEEN = 200_000
SAMPLE = 20_000  # rows that are looked at for hot keys
HOT = 50
ROUNDS = (63, 7, 0)  # keys without these bits take part in a round
LEAST = 8  # smallest keys that a set carries
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words that link at ``num / den``."""

    words: int = 5
    num: int = 80
    den: int = 100

    def differing(self, both: int) -> int:
        """Most tokens by which two sets of ``both`` tokens together can differ."""
        return both * (self.den - self.num) // (self.den + self.num)

    def bands(self, upto: int) -> list[int]:
        """Upper sizes of the bands; a partner of a set is in its own band or a neighbouring one."""
        out = [1]
        while out[-1] < upto:
            out.append(max(int(out[-1] * BAND_RATIO), out[-1] * self.den // self.num, out[-1] + 1))
        return out


# ---- shingles --------------------------------------------------------------------------------------------------

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, _BASE, U64), np.full(size, pow(_BASE, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        _POWERS[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _POWERS[size]


def _segments(blob: bytes) -> Iterator[tuple[int, int]]:
    """Parts of about SEGMENT bytes that end between words."""
    at = 0
    while at < len(blob):
        end = at + SEGMENT
        if end < len(blob):
            end = blob.rfind(b" ", at, end) + 1 or (blob.find(b" ", end) + 1 or len(blob))
        yield at, min(end, len(blob))
        at = end


def word_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every word of ``blob`` (words end at spaces and at \\t\\n\\v\\f\\r)."""
    hashes, places = [], []
    for lo, hi in _segments(blob):
        raw = np.frombuffer(blob, np.uint8, hi - lo, lo)
        word = ~_SPACE[raw]
        edge = np.diff(word.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _powers(len(raw))
        sums = np.zeros(len(raw) + 1, U64)
        np.cumsum(raw * up[:len(raw)], out=sums[1:])
        hashes.append(mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)))
        places.append(starts + lo)
    return (np.concatenate(hashes), np.concatenate(places)) if hashes else (np.zeros(0, U64), np.zeros(0, np.int64))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    out: list[np.ndarray] = []
    at = 0
    factors = np.array([pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64) for i in range(words)], U64)
    while at < len(texts):
        parts, size, first = [], 0, at
        while at < len(texts) and (size < SEGMENT or at == first):
            parts.append((texts[at] or "").encode("utf-8", "surrogatepass"))
            size += len(parts[-1]) + 1
            at += 1
        hashes, places = word_hashes(b" ".join(parts).lower())
        starts = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        bounds = np.searchsorted(places, starts)
        n = max(0, len(hashes) - words + 1)
        joined = np.zeros(n, U64)
        for i in range(words):
            joined += hashes[i:i + n] * factors[i]
        joined = mix64(joined)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if hi - lo >= words:
                out.append(np.unique(joined[lo:hi - words + 1]))
            elif hi > lo:
                out.append(mix64(np.array([(hashes[lo:hi] * factors[:hi - lo]).sum(dtype=U64) + U64(hi - lo)])))
            else:
                out.append(np.zeros(0, U64))
    return out


# ---- sketches --------------------------------------------------------------------------------------------------

def parity_bits(tokens: np.ndarray) -> bytes:
    """A bit of the sketch is the parity of the tokens that fall on it."""
    return np.packbits((np.bincount((tokens >> U64(55)).astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


def chunk_keys(tokens: np.ndarray, sim: Similarity, bands: list[int]) -> np.ndarray:
    """Join keys of a set (sorted distinct tokens) in its own band and, if a larger partner may stand there, the next."""
    n = len(tokens)
    own = int(np.searchsorted(bands, n))
    mixed = mix64(tokens)
    running = np.concatenate([np.zeros(1, U64), np.bitwise_xor.accumulate(mixed)])
    keys = []
    for band in (own, own + 1):
        if band > own and bands[own] >= n * sim.den // sim.num:
            break
        d = sim.differing(2 * bands[band])
        if d == 0:  # only equal sets link
            continue
        k = d + 2 + d // 16
        chunk = ((tokens >> U64(32)) * U64(k)) >> U64(32)
        cut = np.searchsorted(chunk, np.arange(k + 1, dtype=U64))
        xors = running[cut[1:]] ^ running[cut[:-1]]
        full = cut[1:] > cut[:-1]
        name = np.arange(k, dtype=U64) + U64((band + 1) << 32)
        key = mix64(xors ^ mix64(name))
        partner = min(bands[band], n * sim.den // sim.num)
        keys.append(key[full] if int(full.sum()) > sim.differing(n + partner) else key)
    return np.concatenate(keys) if keys else np.zeros(0, U64)


def least_keys(keys: np.ndarray) -> bytes:
    """The smallest join keys of a set; places beyond its last key hold the largest number, which is smaller than none."""
    out = np.full(LEAST, np.iinfo(np.int64).max)
    few = np.sort(keys.view(np.int64))[:LEAST]
    out[:len(few)] = few
    return out.tobytes()


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of sketches given as unsigned 64-bit words, along the last axis."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


# ---- Spark -----------------------------------------------------------------------------------------------------

def _each(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def _bands_for(bands: list[int], n: int, sim: Similarity) -> list[int]:
    return sim.bands(4 * n) if n * sim.den // sim.num >= bands[-2] else bands


def sketches(docs: DataFrame, sim: Similarity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n, s1, s2, sketch, least)``: set size, a 128-bit name of the set, parity bits and smallest join keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        bands = sim.bands(1024)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n, s1, s2, bits, least = [], [], [], [], []
                for tokens in shingle_sets(texts_of(part.column(1)), sim.words):
                    n.append(len(tokens))
                    bands = _bands_for(bands, len(tokens), sim)
                    s1.append(int(np.bitwise_xor.reduce(tokens, initial=0)))
                    s2.append(int((tokens * U64(0x94D049BB133111EB) >> U64(7)).sum(dtype=U64)))
                    bits.append(parity_bits(tokens))
                    least.append(least_keys(chunk_keys(tokens, sim, bands)) if len(tokens) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(np.array(s1, U64).view(np.int64)), pa.array(np.array(s2, U64).view(np.int64)), pa.array(bits, pa.binary()), pa.array(least, pa.binary())],
                    names=["id", "n", "s1", "s2", "sketch", "least"])

    return _each(docs, id_col, text_col).mapInArrow(run, "id long, n long, s1 long, s2 long, sketch binary, least binary")


def join_keys(docs: DataFrame, sim: Similarity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, id)``: the join keys of every set. A copy of a set that its task has met before has none: a combiner on the map side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen: set[bytes] = set()
        bands = sim.bands(1024)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys = []
                for tokens in shingle_sets(texts_of(part.column(1)), sim.words):
                    name = np.stack([np.bitwise_xor.reduce(tokens, initial=0), (tokens * U64(0x94D049BB133111EB) >> U64(7)).sum(dtype=U64)]).tobytes()
                    if name in seen or not len(tokens):
                        keys.append(np.zeros(0, U64))
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(name)
                    bands = _bands_for(bands, len(tokens), sim)
                    keys.append(chunk_keys(tokens, sim, bands))
                ids = np.repeat(part.column(0).to_numpy(), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(ids)], names=["key", "id"])

    return _each(docs.where(F.col(id_col).isNotNull()), id_col, text_col).mapInArrow(run, "key long, id long")


def hot_keys(docs: DataFrame, sim: Similarity, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key)``: keys that many of SAMPLE hash-drawn rows share; at most SAMPLE / HOT for each place of a key, so they can be broadcast."""
    drawn = docs.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(23)), F.lit(max(1, rows // SAMPLE))) == 0)
    return join_keys(drawn, sim, id_col, text_col).groupBy("key").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= HOT).select("key")


def shared_keys(keys: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows of ``keys`` (key, id) whose key stands in several rows.

    Keys meet once, dealt and sorted by key, with one row held back. Hot keys are known to be shared, so their rows needn't meet and are dealt by id too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

        def several(key: np.ndarray, ids: np.ndarray, sure: np.ndarray) -> pa.RecordBatch:
            same = key[1:] == key[:-1]
            keep = sure | np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(key) else sure
            return pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(ids[keep])], names=["key", "id"])

        for batch in batches:
            key, ids, sure = (np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held))
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if sure[-1] or cut < len(key) - 1:
                cut = len(key) - 1  # known to be shared: one row is enough to tell what follows
                sure[cut:] = True
            yield several(key[:cut], ids[:cut], sure[:cut])
            held = key[cut:], ids[cut:], sure[cut:]
        yield several(*held)

    known = F.broadcast(hot.select(F.col("key").alias("_hot")))
    marked = keys.join(known, F.col("key") == F.col("_hot"), "left").select("key", "id", F.col("_hot").isNotNull().alias("sure"))
    dealt = marked.repartition("key", F.when(F.col("sure"), F.pmod(F.xxhash64("id"), F.lit(4096)))).sortWithinPartitions("key")
    return dealt.mapInArrow(run, "key long, id long")


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """key, id, n, component and sketch words of a batch of bucket rows."""
    bits = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), U64).reshape(-1, SKETCH_BITS // 64)
    return *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "rep", "n", "component")), bits


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of equal ``names``, joined across batches."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        cols = [rows.column(c).to_numpy() for c in names]
        change = np.zeros(len(rows) - 1, bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        whole = rows.slice(0, cuts[-1]).combine_chunks()
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo > 1:
                yield whole.slice(lo, hi - lo).to_batches()[0]
        held = rows.slice(cuts[-1])
    if held is not None and len(held) > 1:
        yield held.combine_chunks().to_batches()[0]


def _pairs_out(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def _may_link(sim: Similarity, n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes and Hamming distance allow a link."""
    return hamming(x, y) <= (n + m) * (sim.den - sim.num) // (sim.den + sim.num)


def _emit(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for a, b in found:
        if len(a):
            held.append((a, b))
            size += len(a)
        if size > 50_000:
            yield _pairs_out(held)
            held, size = [], 0
    if held:
        yield _pairs_out(held)


def neighbour_pairs(buckets: DataFrame, sim: Similarity) -> DataFrame:
    """Pairs (a, b) of neighbours in each bucket in sketch order that are in different components and may link; one pair a row at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for batch in batches:
                key, rep, n, comp, bits = _rows(batch)
                same = np.flatnonzero((key[1:] == key[:-1]) & (comp[1:] != comp[:-1]))
                ok = same[_may_link(sim, n[same], n[same + 1], bits[same], bits[same + 1])]
                yield rep[ok], rep[ok + 1]
        yield from _emit(found())

    sorted_rows = buckets.repartitionByRange("key", "sketch", "rep").sortWithinPartitions("key", "sketch", "rep")
    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


def cross_pairs(buckets: DataFrame, sim: Similarity) -> DataFrame:
    """All pairs (a, b) of a bucket in different components that may link; large buckets go in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for group in _groups(batches, ["key", "i", "j"]):
                key, rep, n, comp, bits = _rows(group)
                least = np.frombuffer(b"".join(group.column("least").to_pylist()), np.int64).reshape(-1, LEAST)
                i, j, block = (group.column(c).to_numpy() for c in ("i", "j", "block"))
                left = np.flatnonzero(block == i)
                right = np.flatnonzero(block == j)
                inside = i[0] == j[0]
                for at in range(0, len(left), 64):
                    rows = left[at:at + 64]
                    ok = (comp[rows][:, None] != comp[right][None, :]) & _may_link(sim, n[rows][:, None], n[right][None, :], bits[rows][:, None], bits[right][None, :])
                    if inside:
                        ok &= rep[rows][:, None] < rep[right][None, :]
                    x, y = np.nonzero(ok)
                    for lo in range(0, len(x), 4096):
                        a, b = rows[x[lo:lo + 4096]], right[y[lo:lo + 4096]]
                        earlier = ((least[a][:, :, None] == least[b][:, None, :]) & (least[a][:, :, None] < key[0])).any(axis=(1, 2))
                        yield rep[a[~earlier]], rep[b[~earlier]]
        yield from _emit(found())

    sized = buckets.join(buckets.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")), "key")
    placed = sized.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "key", "rep", "n", "component", "sketch", "least", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long").distinct()


def wide_sketch(tokens: np.ndarray, sim: Similarity) -> bytes:
    """Parity bits in proportion to the set: four for each token by which a partner of its size can differ, 512 at least."""
    bits = max(SKETCH_BITS, 1 << (4 * sim.differing(2 * len(tokens))).bit_length())
    return np.packbits((np.bincount((tokens >> U64(64 - bits.bit_length() + 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def sketch_distance(x: bytes, y: bytes) -> int:
    """Differing parities; the longer sketch is folded: two neighbouring parities add up to one."""
    a, b = (np.unpackbits(np.frombuffer(v, np.uint8)) for v in (x, y))
    while len(a) > len(b):
        a = a[0::2] ^ a[1::2]
    while len(b) > len(a):
        b = b[0::2] ^ b[1::2]
    return int((a ^ b).sum())


def likely(pairs: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs whose wide sketches allow a link: no pair that has the similarity goes, and few others need their sets compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "_n", "_m", "_x", "_y"))
            keep = np.array([sketch_distance(p, q) <= (i + j) * (sim.den - sim.num) // (sim.den + sim.num) for i, j, p, q in zip(n, m, x, y, strict=True)], bool)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    left = sets.select(F.col("id").alias("_a"), F.size("tokens").alias("_n"), F.col("wide").alias("_x")).hint("merge")
    right = sets.select(F.col("id").alias("_b"), F.size("tokens").alias("_m"), F.col("wide").alias("_y")).hint("merge")
    both = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    return both.select("a", "b", "_n", "_m", "_x", "_y").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs whose sets have the similarity."""
    left = sets.select(F.col("id").alias("_a"), F.col("tokens").alias("_x")).hint("merge")
    right = sets.select(F.col("id").alias("_b"), F.col("tokens").alias("_y")).hint("merge")
    both = staged(likely(pairs, sets, sim), "likely-pairs").join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    shared = both.select("a", "b", F.size(F.array_intersect("_x", "_y")).cast("long").alias("c"), (F.size("_x") + F.size("_y")).cast("long").alias("t"))
    return shared.where(F.col("c") * sim.den >= (F.col("t") - F.col("c")) * sim.num).select("a", "b")


def _open(buckets: DataFrame) -> DataFrame:
    """Rows of the buckets (key, rep, component) that hold several components."""
    spans = buckets.groupBy(F.col("key").alias("_key")).agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo < _hi").select("_key")
    return buckets.join(spans.hint("merge"), F.col("key") == F.col("_key"), "left_semi")


def _token_sets(docs: DataFrame, sim: Similarity, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = shingle_sets(texts_of(part.column(1)), sim.words)
                yield pa.RecordBatch.from_arrays([part.column(0), list_array(np.concatenate(found).view(np.int64), np.array([len(x) for x in found]), pa.int64()),
                                                  pa.array([wide_sketch(x, sim) for x in found], pa.binary())], names=["id", "tokens", "wide"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, tokens array<long>, wide binary")


def _named(rows: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """``rows`` with the ids in ``column`` replaced by their components, where they have one."""
    known = names.select(F.col("id").alias("_id_of"), F.col("component").alias("_name"))
    return rows.join(known, F.col(column) == F.col("_id_of"), "left").withColumn(column, F.coalesce("_name", column)).drop("_id_of", "_name")


def _links_of(links: DataFrame, renamed: list[DataFrame]) -> DataFrame:
    """Links between the components so far."""
    for names in renamed:
        links = _named(_named(links, "a", names), "b", names)
    return staged(links.where("a <> b").distinct(), "links")


def near_duplicates(docs: DataFrame, sim: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    known = staged(sketches(docs, sim, id_col, text_col), "sketches")
    filled = known.where("n > 0 AND id IS NOT NULL")
    classes = staged(filled.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"), F.first("sketch").alias("sketch"), F.first("least").alias("least")), "classes")
    of_class = lambda rows: rows.join(classes.select(F.col("s1").alias("_1"), F.col("s2").alias("_2"), F.col("n").alias("_n"), "rep"),
                                      (F.col("s1") == F.col("_1")) & (F.col("s2") == F.col("_2")) & (F.col("n") == F.col("_n"))).drop("_1", "_2", "_n")
    hot = staged(hot_keys(docs, sim, known.count(), id_col, text_col), "hot-keys")
    crowd = staged(shared_keys(join_keys(docs, sim, id_col, text_col), hot), "shared-keys")
    # one row per key and class, of keys that several classes have; ids that stand at several sets stand for each of them
    reps = of_class(filled.select("id", "s1", "s2", "n")).select(F.col("id").alias("_i"), "rep").distinct()
    met = staged(crowd.join(reps.hint("merge"), F.col("id") == F.col("_i")).select("key", "rep").distinct(), "keys-of-classes")
    parts = classes.select(F.col("rep").alias("_r"), "n", "sketch", "least").hint("merge")
    with_parts = lambda rows: rows.join(parts, F.col("rep") == F.col("_r")).drop("_r")
    buckets = staged(_open(met.withColumn("component", F.col("rep"))), "buckets")
    forget(hot, crowd, met)
    involved = buckets.select(F.col("rep").alias("_r")).distinct().hint("merge")  # grows with the data: never a broadcast
    sets = staged(_token_sets(docs.join(involved, F.col(id_col) == F.col("_r"), "left_semi"), sim, id_col, text_col), "token-sets")

    # neighbours are joined in rounds over more and more keys, so that pairs of what has met already need no look at their sets
    renamed = []
    for mask in ROUNDS:
        some = buckets.where(F.col("key").bitwiseAND(F.lit(mask)) == 0)
        links = staged(verified(neighbour_pairs(with_parts(some), sim), sets, sim), "links")
        renamed.append(components(_links_of(links, renamed)))
        buckets, was = staged(_open(_named(buckets, "component", renamed[-1])), "buckets"), buckets
        forget(links, was)
    links = staged(verified(cross_pairs(with_parts(buckets), sim), sets, sim), "links")
    renamed.append(components(_links_of(links, renamed)))
    forget(links, buckets, sets)
    named = of_class(known.where("n > 0").select("id", "n", "s1", "s2"))
    for names in renamed:
        named = _named(named, "rep", names)
    named = named.select("id", "n", F.when(F.col("id").isNotNull(), F.col("rep")).alias("component_id"))
    alone = known.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    out = staged(named.unionByName(alone), "near-duplicates")
    forget(known, classes, *renamed)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
