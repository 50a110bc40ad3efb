import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sparkqc.llm import repair_ids as rp
from sparkqc.llm.queries import QUERIES, tokenizer_path

FILE = tokenizer_path("word_bpe_49k.json")
TEXTS = ["Hello world, it's 2024!", "", None, "a  b\n\nc\td", "É́ Å <|endoftext|> x", "naïve café\x0b日本語 🙂", "'s 's it's", "word " * 5000, "x" * 3000, "<|startoftext|>", " ", "a\r\nb"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_give_the_ids_of_the_whole_text(tokenizer):
    encoder = rp.WordEncoder(open(FILE, encoding="utf-8").read(), cached=5)
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(TEXTS)]
        assert got == [whole(tokenizer, t)[:-1] for t in TEXTS]


def test_latin_words_are_cut_as_the_pipeline_cuts_them(tokenizer):
    encoder = rp.WordEncoder(open(FILE, encoding="utf-8").read())
    rng = random.Random(9)
    chars = [chr(x) for x in range(33, 256)] + ["'s", "'ll", "the", "ing", "ción"] * 6 + ["\u0301", "日", "Σ", "İ", "\x00"]
    words = ["".join(rng.choice(chars) for _ in range(rng.randint(1, 9))) for _ in range(4000)] + [chr(x) for x in range(33, 1500)]
    words = [w for w in words if " " not in w and "\n" not in w]
    assert [np.frombuffer(encoder[w], "<u4").tolist() for w in words] == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]


def random_documents(rng, n=40):
    base = [rng.randrange(500) for _ in range(30)]
    return [np.array([*(base * rng.randrange(0, 6)), *(rng.randrange(500) for _ in range(rng.randrange(0, 40))), 1], "<u4").tobytes() for _ in range(n)]


@pytest.mark.parametrize("seed", range(5))
def test_shard_round_trip_and_random_access(seed):
    rng = random.Random(seed)
    coded = random_documents(rng) + [np.array([7] * 501 + [1], "<u4").tobytes()]
    ids = [None, *range(1, len(coded))]
    payload = rp.pack(ids, coded)
    shard = rp.Shard(payload)
    assert shard.doc_ids == ids and [shard.document(i).tobytes() for i in reversed(range(len(coded)))] == coded[::-1]
    assert [x.tobytes() for x in shard.documents(50)] == coded
    flat = np.frombuffer(b"".join(coded), "<u4")
    assert shard.n_ids == len(flat) and all(shard.id_at(p) == flat[p] for p in rng.sample(range(len(flat)), 60))
    assert len(shard.rules) and len(shard.symbols) < len(flat) / 2
    assert [len(shard.expand(np.array([shard.first + i]))) for i in range(len(shard.rules))] == shard.spans.tolist()


def test_most_frequent_pair_becomes_a_rule():
    symbols, last, rules, first = rp.compress(np.array([5, 6] * 50 + [8, 9] * 20, np.uint32), np.array([False] * 139 + [True]), rounds=1, most=1, least=2)
    assert rules.tolist() == [[5, 6]] and first == 10 and symbols.tolist() == [10] * 50 + [8, 9] * 20 and last[-1]


def test_empty_and_tiny_shards():
    for coded in ([np.array([1], "<u4").tobytes()], [np.array([1], "<u4").tobytes()] * 3):
        shard = rp.Shard(rp.pack(list(range(len(coded))), coded))
        assert [shard.document(i).tobytes() for i in range(len(coded))] == coded


def test_files(spark, docs, tokenizer):
    rows = [(i * 3 % 101, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (500, "same"), (500, "same")]
    frame = docs(rows).selectExpr("*", "1 AS part", "2 AS payload")
    path = rp.write_ids(frame, FILE, rp.shard_folder(spark), shard_ids=50)
    got = rp.read_ids(spark, path).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, (d, t) in zip(got, ordered, strict=True):
        ids = whole(tokenizer, t)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(ids), crc(ids))
        start += len(ids)
    assert spark.read.parquet(path).count() > 1


def test_empty_table(spark, docs):
    assert rp.read_ids(spark, rp.write_ids(docs([]), FILE, rp.shard_folder(spark))).count() == 0


def test_query_matches_the_library(spark, tokenizer):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op8_token_ids"](spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for d, t in rows:
        ids = whole(tokenizer, t)
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def frequent_left(symbols, last, least):
    keys = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]
    return int((np.unique(keys[~last[:-1]], return_counts=True)[1] >= least).sum())


@pytest.mark.parametrize("kind", ["zipf", "runs", "uniform"])
def test_no_frequent_pair_is_left_without_a_rule(kind):
    rng = np.random.default_rng(8)
    n = 60_000
    ids = {"zipf": np.minimum(rng.zipf(1.3, n), 40_000), "uniform": rng.integers(0, 60, n), "runs": np.repeat(rng.integers(0, 9, n // 600), 600)}[kind].astype(np.uint32)
    ends = rng.random(len(ids)) < 0.01
    ends[-1] = True
    symbols, last, rules, first = rp.compress(ids, ends)
    assert frequent_left(symbols, last, rp.MIN_PAIRS) == 0
    spelled = [np.array([i], np.uint32) for i in range(first)]
    for a, b in rules.tolist():
        spelled.append(np.concatenate([spelled[a], spelled[b]]))
    assert (np.concatenate([spelled[s] for s in symbols]) == ids).all()
    lengths = np.array([len(spelled[s]) for s in symbols])
    assert (np.flatnonzero(ends) == np.cumsum(lengths)[last] - 1).all()


def test_pairs_that_share_a_bucket_are_all_counted(monkeypatch):
    monkeypatch.setattr(rp, "_BUCKETS", 2)  # four buckets for fifty pairs
    keys = np.repeat(np.arange(50, dtype=np.uint64) << np.uint64(32), np.arange(1, 51))
    pairs, ranks = rp._frequent_pairs(keys, None, 12)
    assert (pairs >> np.uint64(32)).tolist() == list(range(49, 10, -1))
    assert all((pairs[r] == k) if r < len(pairs) else (k >> np.uint64(32)) < 11 for k, r in zip(keys, ranks))


def test_a_long_run_of_one_id_takes_few_rounds():
    ids, ends = np.full(1 << 16, 7, np.uint32), np.zeros(1 << 16, bool)
    ends[-1] = True
    symbols, _, rules, _ = rp.compress(ids, ends)
    assert len(symbols) <= rp.MIN_PAIRS and len(rules) <= 16


def test_rounds_count_only_what_can_be_frequent(monkeypatch):
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 60_000), 40_000).astype(np.uint32)
    ends = rng.random(len(ids)) < 0.01
    ends[-1] = True
    looked, count = [], rp._frequent_pairs
    monkeypatch.setattr(rp, "_frequent_pairs", lambda keys, *a: looked.append(len(keys)) or count(keys, *a))
    symbols, last, _, _ = rp.compress(ids, ends)
    assert len(looked) > 2 and looked[0] == (~ends).sum() and looked[-1] < len(symbols) / 10
    assert frequent_left(symbols, last, rp.MIN_PAIRS) == 0


def test_a_batch_looks_up_each_piece_once(tokenizer, monkeypatch):
    rng = random.Random(5)
    bodies = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéñü") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    words = [f(b) + m for b in bodies for f in (str, str.upper, str.capitalize) for m in ("", ".", ",", "!!", "***")]
    texts = [" ".join(rng.sample(words, 200)) for _ in range(60)]
    encoder = rp.WordEncoder(open(FILE, encoding="utf-8").read())
    asked, look_up = [], encoder._piece
    monkeypatch.setattr(encoder, "_piece", lambda p: asked.append(p) or look_up(p))
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [whole(tokenizer, t)[:-1] for t in texts]
    assert len(asked) <= len(set(bodies)) + 20  # bodies and marks; by words it would be thousands


def test_whole_texts_of_odd_words(tokenizer):
    encoder = rp.WordEncoder(open(FILE, encoding="utf-8").read(), cached=50)
    rng = random.Random(6)
    chars = [chr(x) for x in range(32, 256)] + ["'s", "'LL", "the", "Ünd", "...", "?!", "<|endoftext|>", "<|", "|>", "\n", " ", " ", "  ", "́", "日", "ſ", "K", "\x00"]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    for some in (texts[:3000], texts[3000:], []):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(some)] == [whole(tokenizer, t)[:-1] for t in some]


def test_texts_are_encoded_some_megabytes_at_a_time(spark, docs, tokenizer, monkeypatch):
    monkeypatch.setattr(rp, "TEXT_BYTES", 40)
    rows = [(i, t) for i, t in enumerate(TEXTS * 2)]
    got = rp.read_ids(spark, rp.write_ids(docs(rows), FILE, rp.shard_folder(spark))).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), crc(x)) for x in (whole(tokenizer, t) for _, t in rows)]


def test_pairs_too_wide_for_one_number_are_all_counted():
    rng = np.random.default_rng(2)
    small = rng.integers(0, 9, 3000).astype(np.uint32)
    ends = rng.random(3000) < 0.01
    ends[-1] = True
    wide = small.copy()
    wide[wide == 8] = 3 << 30  # the order of symbols stays
    symbols, last, rules, first = rp.compress(small, ends)
    got = rp.compress(wide, ends)
    back = [np.where(x >= got[3], x.astype(np.int64) - got[3] + first, np.where(x == 3 << 30, 8, x)) for x in (got[0], got[2])]
    assert (back[0] == symbols).all() and (back[1] == rules).all() and (got[1] == last).all()
