import re

import numpy as np
import pytest

from sparkqc.llm import mixing


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(sizes):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(out.values())
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not above:
            out |= {s: weight[s] * level for s in free}
            break
        out |= {s: 2.0 * sizes[s] for s in above}
        free -= above
    return out


def corpus(seed=1, n=300):
    rng = np.random.default_rng(seed)
    names = [None, "b", "a", "é", "Z", "hot", "z9"]
    rows = []
    for i in range(n):
        s = "hot" if rng.random() < 0.4 else names[int(rng.integers(0, 7))]
        rows.append((i, " ".join(["w"] * int(rng.integers(0, 60))), "en", s, 0))
    return rows


def test_word_count(spark):
    texts = [None, "", " ", "a", " a  b ", "a\nb\tc\x0bd\x0ce\rf", "é x y", "a  b\n\nc", "x" * 9000 + " y"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.n for r in frame.select("i", mixing.word_count(frame.t).alias("n")).collect()}
    assert [got[i] for i in range(len(texts))] == [words(t) for t in texts]


def test_targets_and_taken_words(spark, docs):
    rows = corpus()
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = targets(sizes)
    sized = mixing.sizes(docs(rows))
    targeted = mixing.targets(sized)
    got = {r.source: r for r in targeted.collect()}
    assert {s: r.target for s, r in got.items()} == pytest.approx(want)
    mixed = mixing.mix(sized, targeted)
    taken = mixing.taken(mixed).collect()
    assert len(taken) == len(rows) and all(r.taken in (0, r.size, 2 * r.size) for r in taken)
    by = {s: sum(r.taken for r in mixing.taken(mixed.where(mixed.source.eqNullSafe(s))).collect()) for s in sizes}
    assert all(abs(by[s] - want[s]) <= 60 for s in sizes)


def test_shards_split_every_quota_exactly(spark, docs):
    sized = mixing.sizes(docs(corpus(2)))
    targeted = mixing.targets(sized)
    blocks = mixing.split_blocks(targeted, splits=3, blocks_per_shard=16).collect()
    assert len({(r.source, r.block) for r in blocks}) == len(blocks)
    counts = np.bincount([r.shard for r in blocks], minlength=8)
    assert counts.max() - counts.min() <= 1
    per_source = {}
    for r in blocks:
        per_source.setdefault(r.source, set()).add(r.block)
    assert all(v == set(range(len(v))) for v in per_source.values())
    again = mixing.split_blocks(targeted, splits=3, blocks_per_shard=16).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, blocks))
    other = mixing.split_blocks(targeted, splits=3, blocks_per_shard=16, seed=8).collect()
    assert sorted(map(repr, other)) != sorted(map(repr, blocks))
    copies = mixing.mix(sized, targeted).where("copy IS NOT NULL")
    assert copies.where("shard IS NULL OR place IS NULL").count() == 0
    assert copies.groupBy("_row", "copy").count().where("count > 1").count() == 0


def test_splits_are_hypergeometric(spark):
    """Over many seeds the left half's share of a source's blocks has the mean and variance of draws without replacement."""
    targeted = spark.createDataFrame([("a", 30.0), ("b", 70.0)], "source string, target double")
    left = []
    for seed in range(40):
        blocks = mixing.split_blocks(targeted, splits=1, blocks_per_shard=10, seed=seed).collect()
        left.append(sum(r.source == "a" and r.shard == 0 for r in blocks))
    assert abs(np.mean(left) - 3) < 0.6 and 0.4 < np.var(left) < 2.4  # expectation 3, variance 1.105


def taken_of(frame):
    sized = mixing.sizes(frame)
    return mixing.taken(mixing.mix(sized, mixing.targets(sized))).collect()


def test_defined_results(spark, docs):
    assert taken_of(docs([])) == []
    rows = [(1, None, "en", "a", 0), (2, "", "en", "b", 0)]
    got = taken_of(docs(rows))
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
    rows = [(None, "a b c", "en", None, 0), (7, "a b c", "en", "x", 0), (7, "a b c", "en", "x", 0), (7, "d", "en", "x", 0)]
    frame = docs(rows).selectExpr("*", "1 AS size", "2 AS target", "3 AS shard")
    got = taken_of(frame)
    assert len(got) == 4 and sum(r.taken for r in got if r.id == 7) == pytest.approx(9, abs=3)


def test_no_python_on_the_main_path(spark, docs):
    s = mixing.sizes(docs(corpus(3, 20)))
    plan = mixing.taken(mixing.mix(s, mixing.targets(s)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
