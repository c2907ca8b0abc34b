"""Token counts against the library, and the merging against a plain loop."""

import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from quarry.llm import queries, token_counts
from quarry.sources.tables import read_table

SF = "/root/testdata/sf0.001"
PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    with open(PATH, "rb") as f:
        return token_counts.TokenCounter(f.read(), limit=400)   # the table turns over many times


def test_whole_table(spark, library):
    docs = read_table(spark, SF, "documents").select("doc_id", "text").collect()
    want = {r.doc_id: n for r, n in zip(docs, library([r.text or "" for r in docs]), strict=True)}
    got = queries.op12_token_counts(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(docs)
    assert {r.doc_id: r.n_bytes for r in got} == {r.doc_id: len((r.text or "").encode()) for r in docs}
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_odd_texts(counter, library):
    rng = random.Random(5)
    pool = [chr(c) for c in (*range(0x300), *range(0x2000, 0x2070), 0x558, 0x88f, 0x208f, 0x3000, 0x4e00, 0x10940, 0x1b123, 0x1f600)]
    bits = ["<|endoftext|>", "<|endof", " ", "  ", "\n", "\t", "a", " the", "'s", "'ll", "12", "!!", "é", "aaaa", "\x1c", "\x85"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    assert counter([t.encode() for t in texts]).tolist() == library(texts)


def test_long_pre_tokens(counter, library):
    rng = random.Random(6)
    texts = ["a" * n for n in (1, 2, 3, 255, 256, 257, 4001)] + [" " * 999, "!" * 1000]
    texts += ["".join(rng.choice(letters) for _ in range(n)) for letters in ("ab", "etaoinshr") for n in (250, 256, 300, 20_000)]
    assert counter([t.encode() for t in texts]).tolist() == library(texts)


def test_segments(counter, library):
    rng = random.Random(7)
    text = "".join(rng.choice([" ", "  ", "\n", "word", "12", ".", " a"]) for _ in range(4000))
    for size in (1, 7, 100):
        assert "".join(token_counts.segments(text, size)) == text
        assert sum(library(list(token_counts.segments(text, size)))) == library([text])[0]


def test_merging_against_a_loop():
    rng = random.Random(8)
    vocab, merges = {chr(c): c for c in range(512)}, []
    symbols = ["a", "b"]
    while len(merges) < 60:
        pair = rng.choice(symbols), rng.choice(symbols)
        if "".join(pair) not in vocab:
            vocab["".join(pair)] = 512 + len(merges)
            merges.append(pair)
            symbols.append("".join(pair))
    ranks = token_counts.PairRanks(vocab, merges)
    order = {m: k for k, m in enumerate(merges)}

    def plain(text):
        s = list(text)
        while pairs := [(order[p], i) for i, p in enumerate(zip(s, s[1:], strict=False)) if p in order]:
            i = min(pairs)[1]
            s[i:i + 2] = ["".join(s[i:i + 2])]
        return len(s)

    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    assert token_counts.merge_counts([t.encode() for t in texts], ranks).tolist() == [plain(t) for t in texts]
    assert [token_counts.merge_long(ranks.byte[list(t.encode())], ranks) for t in texts] == [plain(t) for t in texts]
    with pytest.raises(ValueError):
        token_counts.PairRanks({**vocab, "zz": 900}, [("z", "z"), ("z", "z")])


def test_small_cases(spark, library):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "some words"), (4, "wort " * 50_000 + "x" * 200_000), (5, "<|endoftext|>a")]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, n_tokens int, id string")
    got = sorted((tuple(r) for r in token_counts.count_tokens(table, PATH, limit=3).collect()), key=str)
    want = [(i, len((t or "").encode()), n, n > 3) for (i, t), n in zip(rows, library([t or "" for _, t in rows]), strict=True)]
    assert got == sorted(want, key=str)
    assert token_counts.count_tokens(table.limit(0), PATH).collect() == []


def test_packing_ids_equal_the_library(spark):
    from quarry.llm import packing
    path = P.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        encode = packing.WordEncoder(f.read())
    rng = random.Random(9)
    pool = [chr(c) for c in (*range(0x250), *range(0x300, 0x330), 0x2019, 0x3a3, 0x4e00, 0x1f600, 0x2126, 0x1e9e, 0x37e)]
    bits = ["'s", "'ll", "<|endoftext|>", "<|", "don't", "ABC", " ", "\n", "\t", "1", "23", "...", "!?", "é", "é", "İ", "ß", "x" * 150, "\x1c"]
    texts = ["".join(rng.choice(p) for _ in range(rng.randint(0, 40))) for p in (pool, bits, pool[:0x180]) for _ in range(600)]
    ids, lens = encode([t.encode() for t in texts])
    want = [e.ids + [2] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert lens.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
