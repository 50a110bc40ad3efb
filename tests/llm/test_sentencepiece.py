import random

import numpy as np
import pytest

from sparkqc.llm import sentencepiece_codec as sc
from sparkqc.llm.queries import tokenizer_path

TEXTS = [" a\n b  c", "hello world", "▁literal ▁", "日本語 text é", "tab\there", "   ", "x", "naïve café — “quoted”", "a" * 400, "https://example.org/" + "abc" * 90, "🙂 ok"]


@pytest.fixture(scope="module")
def pieces():
    return sc.load_pieces(tokenizer_path("piece_bpe_32k.model"))


def best_sum(codec, run):
    """Plain dynamic programme over all pieces, whole text at once."""
    best = [0.0] + [-float("inf")] * len(run)
    for e in range(1, len(run) + 1):
        for s in range(max(0, e - codec.max_len), e):
            piece = run[s:e]
            if piece in codec.pieces.scores:
                best[e] = max(best[e], best[s] + codec.pieces.scores[piece][1])
        if run[e - 1] not in codec.pieces.scores:
            best[e] = max(best[e], best[e - 1] + codec.pieces.unknown)
    return best[-1]


def total(codec, ids):
    by_id = {i: s for i, s in codec.pieces.scores.values()}
    return sum(by_id.get(i, 0.0) for i in ids)


def test_round_trip(pieces):
    codec = sc.Codec(pieces)
    assert all(codec.decode(codec.encode(t)) == t for t in TEXTS)


def test_sum_is_the_best(pieces):
    codec = sc.Codec(pieces)
    for t in ["the quick brown fox", "internationalization of things", "ererhawhth", "a" * 100]:
        run = "▁" + t.replace(" ", "▁")
        assert total(codec, codec.encode(t).tolist()) == pytest.approx(best_sum(codec, run))


def test_committed_parts_equal_the_whole_search(pieces):
    codec = sc.Codec(pieces)
    rng = random.Random(3)
    for _ in range(40):
        run = "▁" + "".join(rng.choice("abcdehinorst▁é") for _ in range(rng.randint(1, 700)))
        parts = list(codec.stream(run))
        assert [i for p in parts for i in p] == codec.short(run)
        assert len(run) < 300 or len(parts) > 1  # committed on the way, not at the end


def test_full_table_of_words_does_not_change_ids(pieces):
    small, large = sc.Codec(pieces, cached=3), sc.Codec(pieces)
    text = " ".join(f"word{i % 17} other{i}" for i in range(60))
    assert small.encode(text).tolist() == large.encode(text).tolist()


def test_frames(spark, docs, pieces):
    rows = docs([(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (101, ""), (None, "null id"), (5, "repeated"), (5, "repeated")])
    coded = sc.encode(rows, pieces)
    got = coded.collect()
    assert len(got) == len(TEXTS) + 5
    assert all(r.decoded is (None if r.doc_id == 100 else True) for r in got)
    by = {r.doc_id: r.ids for r in got}
    assert by[100] is None and by[101] == []
    back = {r.doc_id: r.text for r in sc.decode(coded, pieces).collect()}
    assert back[100] is None and all(back[i] == t for i, t in enumerate(TEXTS) if i != 5)
    assert sc.encode(docs([]), pieces).count() == 0


def test_model_without_word_cuts():
    toy = sc.Pieces({"▁": (3, -5.0), "a": (4, -2.0), "b": (5, -2.0), "a▁b": (6, -1.0), "ab": (7, -3.0)}, (b"", b"", b"", b" ", b"a", b"b", b"a b", b"ab"), tuple([0] * 256), -20.0)
    codec = sc.Codec(toy)
    assert not codec.cuts and codec.encode("ab a b").tolist() == [3, 7, 3, 6]
    assert np.array_equal(codec.encode(""), [])
