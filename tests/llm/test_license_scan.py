import re

import numpy as np

from sparkqc.llm import license_scan as ls

BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(text):
    w = WORD.findall(lower(text))
    hits = [(i, label) for label, p in BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    return len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))


def rows_of(frame):
    return {r.doc_id: r for r in ls.digest(ls.scan(frame)).collect()}


def test_base_phrases_match_brute_force(spark, docs):
    rng = np.random.default_rng(0)
    pool = ["MIT", "license", "License,", "apache", "general", "public", "(the", "word", "Ünï-code", "x2", "gnu", "mit-license", "mit", "LICENSE."]
    texts = [" ".join(rng.choice(pool, int(rng.integers(0, 60)))) for _ in range(120)] + [None, "", "\n", "MIT\nLICENSE", "mit  license mit license"]
    got = rows_of(docs(list(enumerate(texts))))
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_templates(spark, docs):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    altered = "this work was licensed under the gnu general public license version 3"
    no_key = "this work is licensed under the gnu general private license version 3"
    got = rows_of(docs([(1, gpl), (2, altered), (3, no_key), (4, "licensed under the Apache License, Version 2.0."), (5, "a plain text about a license and the public")]))
    assert got[1].labels == "gpl,gpl-3.0" and got[1].score == 1.0
    assert got[2].labels == "gpl,gpl-3.0" and got[2].score == 1.0  # the exact base phrase is in it
    assert got[3].labels == "" and got[4].labels == "apache,apache-2.0" and got[5].labels == "" and got[5].score == 0.0


def test_every_template_finds_itself_and_probes_suffice():
    temps = ls.templates()
    vocabulary = {w for t in temps for w in t.words}
    rng = np.random.default_rng(2)
    index = ls.build_index(temps, {w: float(rng.random()) + 0.1 for w in vocabulary})
    for n, (t, weights) in enumerate(zip(index.templates, index.weights)):
        words = [b"x"] * 3 + list(t.words) + [b"y"] * 3
        assert (n, 3, 1.0) in [(a, b, round(c, 9)) for a, b, c in ls.places(words, index)]
        for _ in range(20):  # spoil words: found exactly if the share and the key phrase allow it
            spoilt = list(t.words)
            for i in rng.integers(0, len(spoilt), 2):
                spoilt[i] = b"zzz"
            share = sum(x for a, b, x in zip(t.words, spoilt, weights) if a == b) / sum(weights)
            key = spoilt[t.key[0]:t.key[0] + len(t.key[1])] == list(t.key[1])
            assert any(a == n and b == 0 for a, b, _ in ls.places(spoilt, index)) == (key and share >= t.threshold - 1e-9)


def test_defined_results(spark, docs):
    assert ls.scan(docs([])).count() == 0
    frame = docs([(None, "mit license"), (1, "mit license"), (1, "mit license"), (2, "word " * 50000 + "mit license")]).selectExpr("*", "1 AS places", "2 AS n_words")
    got = ls.digest(ls.scan(frame)).collect()
    assert [r.n_base for r in got] == [1] * 4
    assert max(r.first_word for r in got) == 50000
