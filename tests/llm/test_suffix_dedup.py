import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkqc.llm import suffix_dedup as sd


def brute(rows, length):
    """Every window of every text by its bytes."""
    raws = [(d, (t or "").encode()) for d, t in rows]
    seen = {}
    for _, r in raws:
        for i in range(len(r) - length + 1):
            seen[r[i:i + length]] = seen.get(r[i:i + length], 0) + 1
    out = []
    for d, r in raws:
        gone = np.zeros(len(r) + 1, np.int8)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = 1
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        out.append((d, len(r), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, length, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sd.digest(sd.remove_repeats(docs, length, **kw)).collect()
    return sorted([tuple(r) for r in found], key=str)


def passages(rng, n, alphabet="abcdé f"):
    return "".join(rng.choice(list(alphabet), n))


def case(rng, size=260):
    shared = [passages(rng, n) for n in (30, 39, 40, 41, 55, 90, 200)]
    rows = [(i, "".join(passages(rng, int(rng.integers(0, size))) + shared[int(rng.integers(0, len(shared)))][int(rng.integers(0, 9)):] for _ in range(int(rng.integers(0, 4))))) for i in range(60)]
    base = passages(rng, 300)
    rows += [(100 + i, base) for i in range(9)]
    rows += [(200 + i, base[:150 - i] + passages(rng, 3) + base[150 - i:]) for i in range(9)]
    rows += [(300, "a" * 500), (301, "ab" * 300), (302, ("line one two three\n") * 30), (303, "a" * 39), (304, "a" * 40), (305, "a" * 41)]
    return rows + [(400, None), (401, ""), (402, "x"), (None, base), (None, None), (403, passages(rng, 60)), (403, passages(rng, 60))]


@pytest.mark.parametrize("shard", [1 << 20, 700])
@pytest.mark.parametrize("k", [8, 24])
def test_equals_brute_force(spark, shard, k):
    rows = case(np.random.default_rng(shard + k))
    assert got(spark, rows, 40, shard=shard, k=k) == brute(rows, 40)


def test_long_texts_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 97)
    monkeypatch.setattr(sd, "SEGMENT", 300)
    monkeypatch.setattr(sd, "LANE", 16)
    rng = np.random.default_rng(4)
    texts = [(i, "é" * i + passages(rng, 900)) for i in range(4)]
    texts.append((9, texts[0][1][100:700] + texts[2][1][50:90] + texts[2][1][50:95]))
    raws = [t.encode() for _, t in texts]
    own, start, windows, *_ = sd.stretches(raws, 40, 12)
    covered = sorted((int(o), int(s) + j) for o, s, w in zip(own, start, windows, strict=True) for j in range(int(w)))
    assert covered == [(o, i) for o, r in enumerate(raws) for i in range(len(r) - 39)]
    marks = []
    for o, s, w in zip(own.tolist(), start.tolist(), windows.tolist(), strict=True):
        marks.append(raws[o][s:s + w + 39])
    begins, _, hit, _ = sd.repeated_windows(marks, 40)
    seen = {}
    for m in marks:
        for i in range(len(m) - 39):
            seen[m[i:i + 40]] = seen.get(m[i:i + 40], 0) + 1
    for b, m in zip(begins.tolist(), marks, strict=True):
        assert hit[b:b + len(m) - 39].tolist() == [seen[m[i:i + 40]] > 1 for i in range(len(m) - 39)]


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for alphabet in (1, 2, 4):
        strings = [bytes(rng.integers(0, alphabet, int(rng.integers(1, 60))).astype(np.uint8) + 97) for _ in range(20)] + [b"a" * 70, b"a" * 70]
        text = np.frombuffer(b"".join(s + bytes(8) for s in strings), np.uint8)
        sizes = np.array([len(s) for s in strings])
        begins = np.cumsum(sizes + 8) - sizes - 8
        owner = np.repeat(np.arange(len(sizes)), sizes + 8)
        left = np.maximum(0, begins[owner] + sizes[owner] - np.arange(len(text)))
        order = sd.suffix_array(text, left)
        suffix = lambda i: text[i:i + left[i]].tobytes()
        assert order.tolist() == sorted(range(len(text)), key=lambda i: (suffix(i), i))
        before, shared = sd.common_prefixes(text, order, left, begins, sizes, 1000)
        for b, size in zip(begins.tolist(), sizes.tolist(), strict=True):
            for i in range(b, b + size):
                x, y = suffix(i), suffix(before[i])
                n = next((j for j, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
                assert shared[i] == n


def test_empty_and_extra_columns(spark):
    assert got(spark, [], 40) == []
    rows = [(1, "x" * 50, 1, "a", 2.0), (2, "x" * 50, 3, None, 1.0), (2, None, 3, None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans long, name string, key double")
    found = sd.remove_repeats(docs, 40).collect()
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept), [tuple(s) for s in r.spans]) for r in found) == [(1, 50, b"", [(0, 50)]), (2, 0, b"", []), (2, 50, b"", [(0, 50)])]
    assert docs.where(F.lit(False)).count() == 0


def test_hot_passage_over_many_shards(spark):
    rng = np.random.default_rng(8)
    passage = passages(rng, 70)
    rows = [(i, passages(rng, 60) + passage + passages(rng, 60)) for i in range(150)]
    assert got(spark, rows, 40, shard=2000) == brute(rows, 40)


def test_planted_passages_of_over_50_words_go_and_clean_documents_stay(spark):
    rng = np.random.default_rng(50)

    def text(n):
        return " ".join("".join(rng.choice(list("abcdefghijklmnop"), int(rng.integers(6, 11)))) for _ in range(n))

    rows, planted = [(i, text(150)) for i in range(80)], {}
    for p in range(20):  # each passage in two documents, among words of their own
        passage = text(51 + p)
        while len(passage) < 400:
            passage += " " + text(1)
        for d in (80 + 2 * p, 81 + 2 * p):
            rows.append((d, f"{text(40)}; {passage}; {text(40)}"))
            planted[d] = len(passage)
    short = text(51)[:395]
    rows += [(200, f"{text(90)} <{short}> {text(90)}"), (201, f"{text(90)} [{short}] {text(90)}")]  # under 400 bytes: no byte goes
    found = {r[0]: r for r in got(spark, rows, sd.LENGTH)}
    assert {d for d, r in found.items() if r[2] > 0} == set(planted)
    assert all(found[d][2] >= n and found[d][3] == 1 for d, n in planted.items())
    assert all(found[d][1] == len(t.encode()) for d, t in rows)  # n_bytes is the size of the input, whatever goes
