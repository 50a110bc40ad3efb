import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from conftest import SF001
from scripts.check_oracle import TABLES, digest
from sparkqc.llm import mixing, ngram_jaccard
from sparkqc.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = QUERIES[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def small(rng):
    def text(n):
        return " ".join("".join(rng.choice(["ka", "lo", "mi", "ru", "te"], 3)) + str(rng.integers(0, 99)) for _ in range(n))
    passage, base = text(60), text(80)
    near = base.split(" ")
    near[40] = "changed"
    rows = [(i, text(30), "en", f"s{i % 4}", 1) for i in range(20)]
    rows += [(20, base, "en", "s0", 1), (21, " ".join(near), "en", "s1", 1), (22, base, "en", "s1", 1), (23, f"{text(20)}\n{passage}", "en", "s2", 1), (24, f"{text(20)}\n{passage}", "en", "s2", 1),
             (25, "12345 67890", "en", "s3", 1), (26, None, "en", None, 1), (27, "", None, "s3", 1), (None, text(25), "en", "s0", 1)]
    return rows, passage


def test_stages(spark, docs):
    rows, passage = small(np.random.default_rng(3))
    first = docs(rows)
    told = cp.language(spark, first, "").cache()
    assert told.columns == first.columns
    assert {r.doc_id for r in told.collect()} == {r[0] for r in rows} - {25, 26, 27}
    cut = cp.lines(spark, told, "").cache()
    assert cut.columns == first.columns and cut.schema["n_chars"].dataType == first.schema["n_chars"].dataType
    by = {r.doc_id: r for r in cut.collect()}
    assert passage in by[23].text and passage not in by[24].text and by[24].n_chars == len(by[24].text)
    assert 22 not in by and 21 in by  # the exact copy lost every line
    kept = cp.near_duplicates(spark, cut, "").cache()
    assert {r.doc_id for r in kept.collect()} == set(by) - {21}
    mixed = cp.mixture(spark, kept, "").cache()
    assert mixed.columns == first.columns
    assert mixed.groupBy("doc_id").count().where("count > 2").count() == 0
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in kept.collect()}
    coded = cp.tokens(spark, mixed, "")
    assert coded.count() == mixed.count() and coded.where("NOT decoded OR n_tokens <> size(ids)").count() == 0


def test_rows_that_share_ids_or_have_none(spark, docs):
    rng = np.random.default_rng(5)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10 ** 6, 40))
    a, b, c, d = text(), text(), text(), text()
    rows = docs([(1, a), (1, b), (None, c), (None, c), (None, d), (2, a), (3, d), (3, d)])
    kept = sorted(((r.doc_id, r.text) for r in cp.near_duplicates(spark, rows, "").collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (None, c), (3, d)], key=str)
    same = docs([(None, "one two three", "en", s, 1) for s in "aaaabbbb"] + [(5, "four five six", "en", "a", 1), (5, "four five six", "en", "a", 1)])
    taken = cp.mixture(spark, same, "").collect()
    sized = mixing.sizes(same)
    assert sum(len(r.text.split()) for r in taken) == sum(r.taken for r in mixing.taken(mixing.mix(sized, mixing.targets(sized))).collect())


def test_mix_comes_through_the_tree(spark, monkeypatch):
    words = lambda: sorted((r.doc_id, r.taken, r.shard_words) for r in QUERIES["op7_source_mixing"](spark, SF001).collect())
    whole = words()
    split = mixing.split_blocks
    monkeypatch.setattr(mixing, "split_blocks", lambda *a: split(*a).withColumn("shard", F.lit(0)))
    assert words() != whole
    monkeypatch.setattr(mixing, "split_blocks", lambda *a: split(*a).where("shard <> 3"))
    assert sum(r[1] for r in words()) < sum(r[1] for r in whole)


def test_stages_of_an_empty_table(spark, docs):
    rows = docs([])
    for _, stage in cp.STAGES:
        rows = stage(spark, rows, "")
        assert rows.count() == 0


def test_stages_keep_extra_columns(spark, docs):
    rows = docs([(1, "some words of a text", "en", "a", 20), (2, "other words of another text", "en", "b", 27)]).withColumn("score", F.lit(1)).withColumn("size", F.lit("x"))
    out = rows
    for _, stage in cp.STAGES[:4]:
        out = stage(spark, out, "")
        assert out.columns == rows.columns


def test_run_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = cp.run(spark, SF001)
    assert got.where("NOT decoded").count() == 0
    near = ngram_jaccard.near_duplicates(docs, cp.NEAR).where("doc_id = component_id")
    assert 0 < got.select("doc_id").distinct().count() <= near.count()
