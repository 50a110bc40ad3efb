import zlib

import numpy as np

from sparkqc.llm import langid
from sparkqc.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def make(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables, int(rng.integers(1, 5)))) for _ in range(n))


def corpus(n=60):
    rng = np.random.default_rng(1)
    kinds = {"aa": ["ka", "lo", "mi", "ru"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["ción", "os", "que", "ñe"]}
    rows = []
    for i in range(n):
        lang = list(kinds)[i % 3]
        rows.append((i, make(rng, kinds[lang], 40), lang, "s", 0))
    return rows


def test_held_out_rows_are_told_apart(spark, docs):
    rows = corpus()
    model = langid.fit(docs(rows))
    got = {r.doc_id: r for r in langid.predict(docs(rows), model).collect()}
    assert all(got[i].lang_pred == lang and 0.5 < got[i].score <= 1 for i, _, lang, _, _ in rows)


def test_learns_from_no_held_out_row(spark, docs):
    rows = [(i, "held out only" if zlib.crc32(str(i).encode()) % 4 == 2 else "learned words here", "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else "yy", "s", 0) for i in range(40)]
    model = langid.fit(docs(rows), min_word=1, min_gram=1)
    assert model.langs == ("yy",) and "held" not in model.words and "learned" in model.words


def test_backoff_takes_the_longest_known_grams(spark, docs):
    model = langid.LanguageModel(("a", "b"), {}, {"^": (-1.0, -2.0), "^x": (-0.5, -3.0), "y": (-2.0, -1.0)}, (-9.0, -9.0), 4)
    assert langid.backoff("xy", model) == (-0.5 - 2.0 - 9.0, -3.0 - 1.0 - 9.0)


def test_defined_results(spark, docs):
    rows = corpus(30)
    model = langid.fit(docs(rows))
    odd = [(100, None), (101, ""), (102, "123 !!"), (103, "²"), (104, "ж"), (None, rows[0][1]), (7, rows[1][1]), (7, rows[1][1]), (105, rows[0][1] * 3000)]
    got = langid.predict(docs(odd), model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(odd)
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (100, 101, 102, 103))
    assert by[104].lang_pred in model.langs and by[None].lang_pred == "aa" and by[105].lang_pred == "aa"
    empty = langid.fit(docs([]))
    assert empty.langs == () and langid.predict(docs(rows), empty).where("lang_pred <> 'und'").count() == 0
    assert langid.predict(docs([]), model).count() == 0


def test_annotate_keeps_columns_and_replaces_clashing_ones(spark, docs):
    rows = corpus(12)
    model = langid.fit(docs(rows))
    frame = docs(rows).selectExpr("*", "7 AS score", "doc_id AS other_id")
    got = langid.annotate(frame, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "other_id", "lang_pred", "score"]
    assert got.where("lang_pred = lang").count() == 12


def test_forgetting_words_does_not_change_predictions(spark, docs):
    rows = corpus(30)
    model = langid.fit(docs(rows))
    a, b = langid.Scorer(model, cached=1), langid.Scorer(model)
    assert [a.predict(r[1] + " newword" + str(r[0])) for r in rows] == [b.predict(r[1] + " newword" + str(r[0])) for r in rows]


def test_held_out_accuracy_of_the_query(spark):
    got = QUERIES["op3_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
