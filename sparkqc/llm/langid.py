"""Language identification with word-first backoff.

``fit`` learns, per language, log frequencies of whole words and of character n-grams
(1 to ``max_n`` characters of the word between ``^`` and ``$``). ``predict`` scores a known
word by its log frequency in each language; an unknown word is cut, left to right, into the
longest known n-grams, falling back to shorter ones, and scored by their log frequencies. The
language with the largest sum wins; ``score`` is its posterior share over all languages.

Fitting reads the labelled rows twice: a count per language over all of them, then a hash
sample of about ``docs_per_lang`` rows per language (whole texts), so the model is bounded by
``docs_per_lang``, ``min_word``, ``min_gram`` and MAX_LANGS (the languages with most rows) whatever the table's size. Prediction reads every
whole text once and shuffles nothing.

Defined results: a null text or one without a letter is ``und`` with score 0; with nothing to
learn from, every text is ``und``; equal sums go to the language with more labelled rows, then to the
smaller name. Repeated rows are predicted each by itself; other columns are not read. A row whose
id is null is never held out and never learned from.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkqc.llm.common import kept, staged, texts_of

UNDETERMINED = "und"
DOCS_PER_LANG = 1500
MAX_LANGS = 1000
MAX_N = 4
MIN_WORD = 2
MIN_GRAM = 3
FLOOR = 1e-7  # share of a string that a language never shows
CACHED_WORDS = 150_000
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """``words`` and ``grams`` map a string to its log frequency in each of ``langs``."""

    langs: tuple[str, ...]
    words: dict[str, tuple[float, ...]]
    grams: dict[str, tuple[float, ...]]
    floor: tuple[float, ...]
    max_n: int


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def has_letter(words: list[str]) -> bool:
    return any(w.isalpha() for w in words) or any(c.isalpha() for w in words for c in w)


def _sample(labelled: DataFrame, docs_per_lang: int) -> tuple[DataFrame, list[tuple[str, int]]]:
    most = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS)
    counts = [(r["lang"], r["n"]) for r in most.collect()]
    spark = labelled.sparkSession
    share = spark.createDataFrame([(k, min(1.0, docs_per_lang / n)) for k, n in counts] or [("", 0.0)], "lang string, _share double")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return labelled.join(F.broadcast(share), "lang").where(draw < F.col("_share")).select("lang", "text"), counts


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[tuple[str, str], int] = {}
        for lang, text in zip(texts_of(batch.column(0)), texts_of(batch.column(1)), strict=True):
            for w in words_of(text):
                found[lang, w] = found.get((lang, w), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(found.values(), pa.int64())],
            names=["lang", "gram", "n"])


def grams_of(word: str, max_n: int) -> Iterator[str]:
    marked = f"^{word}$"
    for n in range(1, max_n + 1):
        for i in range(len(marked) - n + 1):
            yield marked[i:i + n]


def _gram_counts(max_n: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], int] = {}
            for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for g in grams_of(word, max_n):
                    found[lang, g] = found.get((lang, g), 0) + n
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(found.values(), pa.int64())],
                names=["lang", "gram", "n"])
    return count


def _log_table(rows: list, langs: list[str]) -> dict[str, tuple[float, ...]]:
    """Log of each string's share of its language, plus a floor that is the same in all languages."""
    at = {k: i for i, k in enumerate(langs)}
    counts: dict[str, list[int]] = {}
    for r in rows:
        counts.setdefault(r["gram"], [0] * len(langs))[at[r["lang"]]] += r["n"]
    totals = [sum(v[i] for v in counts.values()) or 1 for i in range(len(langs))]
    return {k: tuple(math.log(x / t + FLOOR) for x, t in zip(v, totals, strict=True)) for k, v in counts.items()}


def fit(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, max_n: int = MAX_N, min_word: int = MIN_WORD,
        min_gram: int = MIN_GRAM, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from rows with id, text and language that are not held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    labelled = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample, counts = _sample(labelled, docs_per_lang)
    langs = [k for k, _ in counts]
    shape = "lang string, gram string, n long"
    counted = sample.mapInArrow(_word_counts, shape).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    kept = staged(counted.repartition(docs.sparkSession.sparkContext.defaultParallelism, "gram"), "langid-words")
    words = kept.groupBy("gram").agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by")).where(F.col("all") >= min_word)
    word_rows = words.select("gram", F.explode("by").alias("b")).select("gram", "b.lang", "b.n").collect()
    grams = kept.mapInArrow(_gram_counts(max_n), shape).groupBy("gram", "lang").agg(F.sum("n").alias("n")).where(F.col("n") >= min_gram)
    gram_rows = grams.collect()
    return LanguageModel(tuple(langs), _log_table(word_rows, langs), _log_table(gram_rows, langs), (math.log(FLOOR),) * len(langs), max_n)


def backoff(word: str, model: LanguageModel) -> tuple[float, ...]:
    """Log frequencies of an unknown word: the longest known n-grams from left to right."""
    marked, i, out = f"^{word}$", 0, [0.0] * len(model.langs)
    while i < len(marked):
        for n in range(min(model.max_n, len(marked) - i), 0, -1):
            if (found := model.grams.get(marked[i:i + n])) is not None:
                break
        else:
            n, found = 1, model.floor
        out = [a + b for a, b in zip(out, found, strict=True)]
        i += n
    return tuple(out)


class Scorer:
    """Log frequencies of words as rows of one matrix; rows of new words are added up to a bound, then forgotten."""

    def __init__(self, model: LanguageModel, cached: int = CACHED_WORDS):
        self.model, self.cached = model, len(model.words) + cached
        self.known = {w: i for i, w in enumerate(model.words)}
        self.rows = np.zeros((max(1024, len(model.words)), len(model.langs)))
        if model.words:
            self.rows[: len(model.words)] = np.array(list(model.words.values()))
        self.size = len(model.words)

    def _row(self, word: str) -> int:
        if self.size == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.size] = backoff(word, self.model)
        self.known[word] = self.size
        self.size += 1
        return self.size - 1

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.langs or not has_letter(words):
            return UNDETERMINED, 0.0
        if self.size > self.cached:
            self.size = len(self.model.words)
            self.known = {w: i for i, w in enumerate(self.model.words)}
        known, rows = self.known, []
        for w in words:
            i = known.get(w)
            rows.append(self._row(w) if i is None else i)
        total = self.rows[rows].sum(axis=0)
        best = int(np.argmax(total))
        return self.model.langs[best], float(1.0 / np.exp(total - total[best]).sum())


def annotate(docs: DataFrame, model: LanguageModel, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the prediction and its score in two more columns; columns of these names are replaced."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    rows = docs.drop(pred_col, score_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(key, lambda: Scorer(shared.value))
        for batch in batches:
            found = [scorer.predict(t) for at in range(0, batch.num_rows, 1000) for t in texts_of(batch.column(text_col).slice(at, 1000))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[*batch.schema.names, pred_col, score_col])

    shape = T.StructType([*rows.schema.fields, T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    return rows.mapInArrow(run, shape)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``lang_pred`` and ``score``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return annotate(rows, model).select(F.col("id").alias(id_col), "lang_pred", "score")
