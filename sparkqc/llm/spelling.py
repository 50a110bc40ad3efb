"""Spelling variants: words one edit apart, grouped under their most frequent form, found with asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced character leads from one to the other. For a pair take the longer word s
(of L characters; of equally long ones the greater in order) and the other one, t:

1. s contributes two disjoint chunks, its first and its last q = L / 2 characters. One edit leaves at least one of them whole.
2. t contributes positional grams of q characters. A chunk that is left whole stands in t at a shift of one at most: the first
   chunk at shift 0 (an edit before it leaves the last chunk whole as well), the last chunk at shift 0 or, if t is shorter, -1. Grams at other
   positions certify nothing and are not sent. Lengths, position and gram are the join key.
3. What the chunk leaves over of s and t differs by the one edit. Where a key has few chunks or few grams (at most ``bucket`` pairs), the rests are
   compared. Where it has more (a common beginning or ending), its words contribute chunks and grams of their rests in turn,
   until rests have one character, where only as many words can meet as there are letters. So no key makes all its pairs, however many
   words share a chunk.
4. Pairs are verified by their edit distance. A pair stands once: it counts at the first chunk wherever that is whole.

A word's form is its near word with the largest count, if that is at least ``ratio`` times its own; its root is where forms lead
to. Counts grow along forms, so there are no rings; roots are found by pointer doubling.

Words are counted over all texts before anything is joined: each batch counts its own, Spark adds them up. Defined results: a null
text has no words; a null id counts as an empty one in the noise below; a run of letters of any length is a word; equal counts go to the word that
is smaller in code-point order; rows that repeat count again; without words or near words there are no rows or null forms. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkqc.llm.common import staged, texts_of

MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2
BUCKET = 1024
NOISE = 97
HELD = 400_000
_RUN = re.compile("[a-zÀ-ÿ]+")


# ---- words -----------------------------------------------------------------------------------------------------

def runs(text: str | None) -> list[str]:
    """Runs of letters, A-Z lower-cased."""
    return _RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")) if text else []


def misspelt(run: str, start: int, every: int) -> str:
    """The test's noise: one run in ``every`` loses a character; ``start`` is the crc32 of what stands before the run."""
    h = zlib.crc32(run.encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, noise: int | None = None, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of words with so many characters and occurrences; ``noise`` deletes characters as ``misspelt`` says."""
    def out(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for i, text in zip(texts_of(batch.column(0)), texts_of(batch.column(1)), strict=True):
                here = Counter(runs(text))
                if noise is None:
                    found.update({w: n for w, n in here.items() if len(w) >= min_letters})
                else:
                    start = zlib.crc32(f"{'' if i is None else i}:".encode())
                    for w, n in here.items():
                        w = misspelt(w, start, noise)
                        if len(w) >= min_letters:
                            found[w] += n
                if len(found) > HELD:
                    yield out(found)
                    found = Counter()
        yield out(found)

    counted = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- chunks and grams ------------------------------------------------------------------------------------------

def _part(word: Column, begin: Column, size: Column) -> Column:
    return word.substr((begin + 1).cast("int"), size.cast("int"))


def _chunks(rows: DataFrame) -> DataFrame:
    """The two chunks of what is left, ``[a, b)``, of every word; ``cap``: a pair counts here only if the words differ before it."""
    size = F.col("b") - F.col("a")
    q = F.floor(size / 2)
    first = F.struct(F.xxhash64("key", F.lit(0), size, _part(F.col("word"), F.col("a"), q)).alias("key"), (F.col("a") + q).alias("a"), F.col("b").alias("b"), F.col("cap").alias("cap"))
    last = F.struct(F.xxhash64("key", F.lit(1), size, _part(F.col("word"), F.col("b") - q, q)).alias("key"), F.col("a").alias("a"), (F.col("b") - q).alias("b"),
                    F.least("cap", F.col("a") + q).alias("cap"))
    return rows.select("word", "n", F.explode(F.array(first, last)).alias("c")).select("word", "n", "c.*", (F.col("c.b") - F.col("c.a")).alias("size"))


def _grams(rows: DataFrame) -> DataFrame:
    """The grams of what is left of every word that a chunk of a partner with ``size`` characters left can stand at."""
    q = F.floor(F.col("size") / 2)
    left = F.col("b") - F.col("a")
    first = F.struct(F.xxhash64("key", F.lit(0), F.col("size"), _part(F.col("word"), F.col("a"), q)).alias("key"), (F.col("a") + q).alias("a"), F.col("b").alias("b"))
    last = F.struct(F.xxhash64("key", F.lit(1), F.col("size"), _part(F.col("word"), F.col("b") - q, q)).alias("key"), F.col("a").alias("a"), (F.col("b") - q).alias("b"))
    fits = rows.where(left >= q)
    return fits.select("word", "n", "size", q.alias("q"), F.explode(F.array(first, last)).alias("c")).select("word", "n", "c.*", (F.col("size") - F.col("q")).alias("size"))


def _differ_by_one(s: str, t: str, sa: Column, sb: Column, ta: Column, tb: Column) -> Column:
    """The rests ``s[sa:sb]`` and ``t[ta:tb]`` are one edit apart."""
    return F.levenshtein(_part(F.col(s), sa, sb - sa), _part(F.col(t), ta, tb - ta), 1) == 1


def near_pairs(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(s, t, s_n, t_n)``: every pair of near words of ``words`` (word, n; distinct words) once."""
    whole = F.lit(0x7FFFFFFF).cast("long")
    length = F.length("word").cast("long")
    start = words.select("word", "n", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("a"), length.alias("b"))
    chunks = _chunks(start.withColumn("cap", whole))
    grams = _grams(start.withColumn("size", F.explode(F.array(length, length + 1))))
    found: DataFrame | None = None
    longest = words.agg(F.max(length)).first()[0] or 0
    while longest > 0:
        longest -= longest // 2  # what a chunk leaves
        chunks, grams = staged(chunks, "word-chunks"), staged(grams, "word-grams")
        c = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("_c"), F.max("size").alias("_s"))
        g = grams.groupBy(F.col("key").alias("_g")).agg(F.count(F.lit(1)).alias("_m"))
        met = c.join(g.hint("merge"), F.col("key") == F.col("_g")).select("key", "_s", (F.col("_c") * F.col("_m")).alias("_pairs"))
        many = (F.col("_pairs") > bucket) & (F.col("_s") > 1)
        met = staged(met.select(F.col("key").alias("_key"), many.alias("_many")), "word-keys")
        on = F.col("key") == F.col("_key")
        here = chunks.join(met.where("NOT _many").hint("merge"), on).drop("_many", "_key")
        other = grams.select(F.col("key").alias("_k"), F.col("word").alias("t"), F.col("n").alias("t_n"), F.col("a").alias("ta"), F.col("b").alias("tb"))
        both = here.join(other.hint("merge"), F.col("key") == F.col("_k"))
        order = (F.length("word") > F.length("t")) | ((F.length("word") == F.length("t")) & (F.col("word") > F.col("t")))
        once = F.substring("word", F.lit(1), F.col("cap").cast("int")) != F.substring("t", F.lit(1), F.col("cap").cast("int"))
        near = both.where(order & once & _differ_by_one("word", "t", F.col("a"), F.col("b"), F.col("ta"), F.col("tb")))
        near = staged(near.select(F.col("word").alias("s"), "t", F.col("n").alias("s_n"), "t_n"), "word-pairs")
        found = near if found is None else found.unionByName(near)
        crowded = met.where("_many").select("_key").hint("merge")
        chunks = _chunks(chunks.join(crowded, on, "left_semi"))
        grams = _grams(grams.join(crowded, on, "left_semi"))
        if met.where("_many").isEmpty():
            break
    return found if found is not None else words.select(F.col("word").alias("s"), F.col("word").alias("t"), F.col("n").alias("s_n"), F.col("n").alias("t_n")).where(F.lit(False))


# ---- forms -----------------------------------------------------------------------------------------------------

def variants(words: DataFrame, ratio: int = RATIO, bucket: int = BUCKET) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every row of ``words`` (word, n; distinct words)."""
    pairs = near_pairs(words, bucket)
    ways = pairs.select(F.col("s").alias("word"), F.col("t").alias("other"), F.col("t_n").alias("m")).unionByName(
        pairs.select(F.col("t").alias("word"), F.col("s").alias("other"), F.col("s_n").alias("m")))
    best = ways.groupBy(F.col("word").alias("_w")).agg(F.count(F.lit(1)).alias("near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("first"))
    rows = words.join(best.hint("merge"), F.col("word") == F.col("_w"), "left").withColumn("_is", -F.col("first.m") >= F.col("n") * ratio)
    rows = staged(rows.select("word", "n", F.coalesce("near", F.lit(0)).alias("n_near"), F.when(F.col("_is"), F.col("first.other")).alias("form"), F.when(F.col("_is"), -F.col("first.m")).alias("form_n")), "word-forms")
    at = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # where it leads to, then from there on: chains halve in every round
        at = staged(at, "word-roots")
        on = at.select(F.col("word").alias("_from"), F.col("root").alias("_to")).hint("merge")
        further = at.join(on, F.col("root") == F.col("_from"), "left")
        if further.where("_to IS NOT NULL").isEmpty():
            break
        at = further.select("word", F.coalesce("_to", "root").alias("root"))
    roots = at.select(F.col("word").alias("_w"), "root").hint("merge")
    return rows.join(roots, F.col("word") == F.col("_w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, noise: int | None = None, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO, bucket: int = BUCKET,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of ``docs`` with their forms and roots; see ``word_counts`` and ``variants``."""
    return variants(staged(word_counts(docs, noise, min_letters, min_count, id_col, text_col), "words"), ratio, bucket)
