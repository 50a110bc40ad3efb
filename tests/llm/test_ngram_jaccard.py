import itertools

import numpy as np
import pyarrow as pa
import pytest

from sparkqc.llm import ngram_jaccard as nj
from sparkqc.llm.components import components


def brute(rows, sim):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        k = sim.words
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and both * sim.den >= (len(sets[a]) + len(sets[b]) - both) * sim.num:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_copies(rng, make_words, n_base=12):
    rows, ids = [], iter(rng.permutation(5000).tolist())
    for n in [3, 4, 8, 11, 20, 40, 90, 150, 400][:n_base]:
        base = make_words(rng, n)
        for edits in (0, 0, 1, 1, 2, 3, 5, 9):
            w = list(base)
            for p in rng.integers(0, len(w), edits):
                w[p] = f"x{rng.integers(0, 9999)}"
            rows.append((next(ids), " ".join(w)))
        rows.append((next(ids), " ".join(base + make_words(rng, max(1, n // 12)))))
    return rows


@pytest.mark.parametrize("sim", [nj.Similarity(3, 90, 100), nj.Similarity(5, 80, 100), nj.Similarity(1, 50, 100)])
def test_components_match_brute_force(spark, docs, make_words, sim):
    rng = np.random.default_rng(5)
    rows = near_copies(rng, make_words)
    rows += [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "one"), (9005, "ONE"), (9006, "one two"), (9007, "É one two three"), (9008, "é one two three")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.near_duplicates(docs(rows), sim).collect()}
    assert got == brute(rows, sim)


def test_hot_group_of_near_copies_in_blocks(spark, docs, make_words, monkeypatch):
    """A chain and a crowd in one bucket: more documents than a block, linked only in part."""
    monkeypatch.setattr(nj, "BLOCK", 16)
    rng = np.random.default_rng(6)
    base = make_words(rng, 120, 100_000)
    rows = []
    for i in range(150):
        w = list(base)
        for p in rng.integers(0, 120, int(rng.integers(0, 6))):
            w[p] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(w)))
    sim = nj.Similarity(3, 90, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.near_duplicates(docs(rows), sim).collect()}
    assert got == brute(rows, sim)


def test_empty_table_null_ids_and_clashing_columns(spark, docs):
    assert nj.near_duplicates(docs([])).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e f", 1, 2), (1, "a b c d e f", 3, 4), (1, "a b c d e f", 3, 4), (2, "A b c d e f", 3, 4)],
                                 "doc_id long, text string, n int, component_id int")
    got = sorted((r.doc_id or -1, r.component_id) for r in nj.near_duplicates(rows).collect())
    assert got == [(-1, None), (1, 1), (1, 1), (2, 1)]


def test_sketch_distance_never_exceeds_symmetric_difference():
    rng = np.random.default_rng(7)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 2**63, int(rng.integers(1, 300))).astype(np.uint64)) for _ in range(2))
        common = rng.integers(0, 2**63, 100).astype(np.uint64)
        a, b = np.union1d(a, common), np.union1d(b, common)
        x, y = (np.frombuffer(nj.parity_bits(t), np.uint64) for t in (a, b))
        assert nj.hamming(x, y) <= len(np.setxor1d(a, b))


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(8)
    sim = nj.Similarity(3, 90, 100)
    bands = sim.bands(100_000)
    for n in [10, 11, 19, 25, 60, 200, 900, 5000]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            drop = int(rng.integers(0, n // 10 + 1))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 10 + 1))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both * 100 >= (len(a) + len(b) - both) * 90 and not np.array_equal(a, b):
                assert np.intersect1d(nj.chunk_keys(a, sim, bands), nj.chunk_keys(b, sim, bands)).size


def test_words_of_very_long_texts_are_cut_at_spaces(monkeypatch):
    text = " ".join(f"word{i % 977}" for i in range(3000))
    whole = nj.shingle_sets([text], 3)[0]
    monkeypatch.setattr(nj, "SEGMENT", 64)
    assert np.array_equal(nj.shingle_sets([text], 3)[0], whole)
    assert np.array_equal(nj.shingle_sets(["x" * 500 + " y z"], 3)[0], nj.shingle_sets(["x" * 500 + "\ty  z"], 3)[0])


def test_components_of_chain_star_and_cycle(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(300, 330)] + [(1, 2), (2, 3), (3, 1)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[x] == 7 for x in range(300, 330)) and {got[1], got[2], got[3]} == {1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_wide_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    sim = nj.Similarity(5, 80, 100)
    for n in (1, 30, 900, 6000, 40_000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        for m in (0, 1, n // 20, n // 8, n):
            b = np.unique(np.concatenate([a[m:], rng.integers(0, 1 << 63, m // 2).astype(np.uint64)]))
            if len(b):
                x, y = nj.wide_sketch(a, sim), nj.wide_sketch(b, sim)
                assert len(x) >= 64 and nj.sketch_distance(x, y) <= len(np.setxor1d(a, b))


def test_long_texts_need_little_memory_in_a_worker():
    import tracemalloc

    text = "abcdefg " * 750_000
    nj.shingle_sets([text[:1000]], 3)
    tracemalloc.start()
    nj.shingle_sets([text], 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20 and sum(a.nbytes for pair in nj._POWERS.values() for a in pair) <= 16 << 20


def test_a_worker_keeps_one_table_and_near_duplicates_none(spark, docs):
    from sparkqc.llm import common

    common.let_go()
    assert common.kept("a", lambda: [1]) is common.kept("a", lambda: [2])
    assert common.kept("b", lambda: [3]) == [3] and list(common._KEPT) == ["b"]
    common.let_go()
    assert not common._KEPT

    def left(batches):
        from sparkqc.llm.common import _KEPT

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(_KEPT)])], names=["n"])

    def keep(batches):
        from sparkqc.llm.common import kept

        for batch in batches:
            kept("table of words", lambda: [0] * 1000)
            yield batch

    rows = docs([(i, f"a b c d {i}") for i in range(8)])
    assert rows.repartition(8).mapInArrow(keep, rows.schema).count() == 8
    nj.near_duplicates(rows, nj.Similarity()).collect()
    assert spark.range(64).repartition(64).mapInArrow(left, "n long").agg({"n": "max"}).first()[0] == 0
