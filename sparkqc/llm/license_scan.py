"""Licence scan with a positional rare-token index.

Licence templates are short word sequences. The corpus gives each licence word its document
frequency, hence its IDF. For a file the operator posts the positions of its licence words; each template is
looked up by its highest-IDF words (a rare word at position p proposes the start p - offset); the
postings of all the template's words are intersected by relative position, which gives the share of the
template's IDF found in place; and a start counts only if that share reaches the template's threshold and every
mandatory key phrase stands where the template has it.

A template with threshold 1 is a phrase: its rarest word alone proposes every place, so all places
are found. Longer templates are looked up by as many of their rarest words as guarantee a hit: their IDF
together exceeds what the threshold lets a match lose.

Texts are lower-cased (A-Z only) and cut into words of digits, letters and non-ASCII characters; they are
read whole. Null and empty texts have no words and no labels. Repeated rows are scanned each by itself; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.llm.common import texts_of

# Base phrases and their labels.
BASE_PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Label, words, mandatory key phrase, share of the IDF that must match.
TEXT_TEMPLATES = (
    ("mit-notice", "released under the mit license", "mit license", 0.8),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted", 0.8),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0", 0.8),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3", 0.8),
    ("gpl-2.0", "gnu general public license version 2", "general public license version 2", 0.8),
    ("lgpl", "gnu lesser general public license", "lesser general public license", 0.8),
    ("agpl", "gnu affero general public license", "affero general public license", 0.8),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms", 0.8),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license", 0.8),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify", 0.8),
    ("cc-by", "this work is licensed under a creative commons attribution", "creative commons attribution", 0.8),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software", 0.8),
    ("warranty-disclaimer", "the software is provided as is without warranty of any kind express or implied", "without warranty of any kind", 0.8),
)

#: Word bytes are 0-9, a-z and everything from 0x80 up; all others become a space.
_BREAKS = bytes(32 if x < 0x30 or 0x3A <= x <= 0x60 or 0x7B <= x <= 0x7F else x for x in range(256))


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    key: tuple[int, tuple[bytes, ...]]  # place of the mandatory phrase within the words, and the phrase
    threshold: float
    base: bool = False


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_BREAKS).split() if text else []


def templates(base: Sequence = BASE_PHRASES, texts: Sequence = TEXT_TEMPLATES) -> tuple[Template, ...]:
    out = [Template(label, w := tuple(words_of(p)), (0, w), 1.0, True) for label, p in base]
    for label, words, key, threshold in texts:
        w, k = tuple(words_of(words)), tuple(words_of(key))
        place = next(i for i in range(len(w)) if w[i:i + len(k)] == k)
        out.append(Template(label, w, (place, k), threshold))
    return tuple(out)


def document_frequency(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of texts, and in how many each licence word stands: one pass over all texts, partial sums per batch."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, int] = {b"": batch.num_rows}
            for text in texts_of(batch.column(0)):
                for w in vocabulary.intersection(words_of(text)):
                    found[w] = found.get(w, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found]), pa.array(found.values(), pa.int64())], names=["w", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    df = {r["w"].encode(): r["n"] for r in rows}  # at most one row per licence word
    return df.pop(b"", 0), df


def idf_of(n_docs: int, df: dict[bytes, int], vocabulary: set[bytes]) -> dict[bytes, float]:
    return {w: math.log((1 + n_docs) / (1 + df.get(w, 0))) + 1e-9 for w in vocabulary}


@dataclass(frozen=True)
class Index:
    """Per template: the offsets that propose starts (rarest words first), and the IDF of each word."""

    templates: tuple[Template, ...]
    probes: tuple[tuple[int, ...], ...]
    weights: tuple[tuple[float, ...], ...]
    vocabulary: frozenset[bytes]


def build_index(temps: Sequence[Template], idf: dict[bytes, float]) -> Index:
    probes, weights = [], []
    for t in temps:
        w = [idf[x] for x in t.words]
        rare, lost, allowed = [], 0.0, (1 - t.threshold) * sum(w)
        for i in sorted(range(len(w)), key=lambda i: (-w[i], i)):
            rare.append(i)
            lost += w[i]
            if lost > allowed * (1 + 1e-9):  # a match can't do without all of these
                break
        probes.append(tuple(rare))
        weights.append(tuple(w))
    return Index(tuple(temps), tuple(probes), tuple(weights), frozenset(x for t in temps for x in t.words))


def places(words: list[bytes], index: Index) -> list[tuple[int, int, float]]:
    """(template number, start, share of its IDF found in place) of every accepted place."""
    postings: dict[bytes, set[int]] = {}
    for i, w in enumerate(words):
        if w in index.vocabulary:
            postings.setdefault(w, set()).add(i)
    out: list[tuple[int, int, float]] = []
    if not postings:
        return out
    none: set[int] = set()
    for n, (t, probes, weights) in enumerate(zip(index.templates, index.probes, index.weights, strict=True)):
        starts = {p - i for i in probes for p in postings.get(t.words[i], none)}
        if not starts:
            continue
        total, (at, key) = sum(weights), t.key
        for s in starts:
            if any(s + at + i not in postings.get(k, none) for i, k in enumerate(key)):
                continue
            share = sum(x for i, (w, x) in enumerate(zip(t.words, weights, strict=True)) if s + i in postings.get(w, none)) / total
            if share >= t.threshold - 1e-9:
                out.append((n, s, min(1.0, share)))
    return out


def scan(docs: DataFrame, temps: Sequence[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_words`` and ``places``, the accepted places as
    (label, base, start, n_words of the template, share)."""
    temps = tuple(temps or templates())
    vocabulary = {w for t in temps for w in t.words}
    shared = docs.sparkSession.sparkContext.broadcast(build_index(temps, idf_of(*document_frequency(docs, vocabulary, text_col), vocabulary)))
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("length", pa.int64()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            n, found = [], []
            for text in texts_of(batch.column(1)):
                words = words_of(text)
                n.append(len(words))
                found.append([{"label": index.templates[k].label, "base": index.templates[k].base, "start": s, "length": len(index.templates[k].words), "share": x}
                              for k, s, x in sorted(places(words, index), key=lambda p: (p[1], p[0]))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(found, kind)], names=["id", "n_words", "places"])

    id_kind = docs.schema[id_col].dataType.simpleString()
    shape = f"id {id_kind}, n_words long, places array<struct<label:string,base:boolean,start:long,length:long,share:double>>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, shape).withColumnRenamed("id", id_col)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_base, first_word and last_word of the base phrases; labels and the best share of all templates."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    names = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda p: p["label"]))), ",")
    return scanned.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"))
