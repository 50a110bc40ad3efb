import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkqc.llm import spelling as sp


def apart(s, t):
    """Exactly one insertion, deletion or replacement."""
    if len(s) < len(t):
        s, t = t, s
    if len(s) == len(t):
        return sum(a != b for a, b in zip(s, t, strict=True)) == 1
    return len(s) == len(t) + 1 and any(s[:i] + s[i + 1:] == t for i in range(len(s)))


def brute_variants(counts, ratio=2):
    near = {w: [] for w in counts}
    for s, t in itertools.combinations(counts, 2):
        if apart(s, t):
            near[s].append(t)
            near[t].append(s)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items())


def brute_counts(rows, noise):
    out = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            out[run if h % noise else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def vocabulary(rng, letters="abé", sizes=(5, 9), n=500):
    words = {"".join(rng.choice(list(letters), int(rng.integers(*sizes)))) for _ in range(n)}
    return {w: int(rng.integers(3, 200)) for w in sorted(words)}


@pytest.mark.parametrize("bucket", [1, 40, 100_000])
@pytest.mark.parametrize("letters", ["abé", "abcdefghijklmnopqrstuvwxyz"])
def test_variants_equal_brute_force(spark, bucket, letters):
    rng = np.random.default_rng(len(letters))
    counts = vocabulary(rng, letters)
    for w in list(counts)[:60]:
        at = int(rng.integers(0, len(w)))
        for other in (w[:at] + w[at + 1:], w[:at] + "é" + w[at:], w[:at] + "z" + w[at + 1:]):
            if len(other) >= 5:
                counts.setdefault(other, int(rng.integers(3, 2000)))
    counts |= {"x" * n: 3 + n for n in range(5, 40)} | {"commonbeginning" + w: n for w, n in list(counts.items())[:80]}
    found = sp.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), bucket=bucket).collect()
    assert sorted(tuple(r) for r in found) == brute_variants(counts)


def test_documents_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    words = list(vocabulary(rng, "abcé", (3, 8), 300))
    rows = [(i, " ".join(rng.choice(words, 120))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "12 3"), (103, "Éclair ÉCLAIR eclair×" * 5), (104, "a" * 3000 + " " + "A" * 2999 + "b"), (104, "a" * 3000), (104, "aA" * 1500), (105, "Straße straße,STRASSE; straSSe strasse")]
    rows += [rows[0], rows[0]]
    found = sp.group_spellings(spark.createDataFrame(rows, "doc_id long, text string"), noise=13).collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted(brute_variants(brute_counts(rows, 13)), key=str)


def test_one_row_per_pair(spark):
    counts = vocabulary(np.random.default_rng(9), "ab", (5, 8), 400)
    for bucket in (1, 1000):
        pairs = [frozenset((r.s, r.t)) for r in sp.near_pairs(spark.createDataFrame(list(counts.items()), "word string, n long"), bucket).collect()]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {frozenset(p) for p in itertools.combinations(counts, 2) if apart(*p)}


def test_empty_null_ids_and_extra_columns(spark):
    assert sp.group_spellings(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = [(None, "letter letter letter lettre lettre lettre letters letters letters letters letters letters", 1, "w")]
    found = sp.group_spellings(spark.createDataFrame(rows, "doc_id long, text string, n int, word string")).collect()
    assert sorted(tuple(r) for r in found) == [("letter", "letters", "letters", 3, 1, 6), ("letters", None, "letters", 6, 1, None), ("lettre", None, "lettre", 3, 0, None)]
