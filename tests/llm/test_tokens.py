import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from vigil.llm import bpe, token_counts as tc

BITS = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "1", "23", "é", "日本", "🙂", "<|endoftext|>", "\t", "!", "...", "the", "ing", "՘", "　", "x" * 70, "A", "====", "가"]


def sample(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(BITS) for _ in range(r.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tik():
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_prefix_matches_the_library(library):
    counter = tc.counter(public_tokenizers.path("byte_bpe_50k.json"))
    n = lambda t: len(library.encode(t, add_special_tokens=False))
    for text in sample(250, 3):
        table = counter.table(text)
        counts = [n(text[:p]) for p in range(len(text) + 1)]
        assert [table.count(p) for p in range(len(text) + 1)] == counts
        for budget in (0, 1, 4, 9):
            assert table.longest_within(budget) == max(p for p, c in enumerate(counts) if c <= budget)


def test_op6_rows(spark, library):
    texts = [*sample(300, 4), None, "", "y" * 20000, "word " * 3000]
    df = spark.createDataFrame([(k if k else None, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    for r in tc.token_counts(df, limit=8, tables=True).collect():
        text = texts[r.doc_id or 0] or ""
        want = len(library.encode(text, add_special_tokens=False))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want, len(text.encode()), want > 8)
        assert (r.piece_counts or [0])[-1] == want
        assert len(library.encode(text[: r.fit_chars], add_special_tokens=False)) <= 8
    assert tc.token_counts(df.limit(0)).count() == 0


def test_codec_matches_tiktoken(tik):
    c = bpe.codec()
    texts = sample(1500, 5)
    for text, ids in zip(texts, c.encode(texts)):
        want = tik.encode_ordinary(text)
        assert ids == struct.pack(f"<{len(want)}I", *want)
        assert c.decode(ids) == text.encode()
    for text in texts[:100]:
        spans = c.offsets(text)
        ids = tik.encode_ordinary(text)
        assert len(spans) == len(ids)
        assert all(c.bytes_of[i] in text[a:b].encode() for (a, b), i in zip(spans, ids))
        assert "".join(c.decode_text([i] for i in ids)) == text
    with pytest.raises(ValueError):
        c.decode([10**6])


def test_op8_rows(spark, tik):
    texts = [*sample(200, 6), None, "", "日本語" * 5000]
    df = spark.createDataFrame([(k if k else None, t, "z") for k, t in enumerate(texts)], "doc_id long, text string, ids string")
    for r in bpe.round_trip(df).collect():
        text = texts[r.doc_id or 0] or ""
        ids = tik.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(df)).collect()}
    assert all(back[k if k else None] == (t or "") for k, t in enumerate(texts))
    assert bpe.round_trip(df.limit(0)).count() == 0


def test_every_prefix_equals_the_library():
    import random
    from tokenizers import Tokenizer
    from vigil.llm import token_counts as TC
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, c, rng = Tokenizer.from_file(path), TC.counter(path), random.Random(11)
    units = ["a", "the", "\n", " ", "  ", "\t", "'s", "'", "'re", "'ll", "=", "==", "!?", "7", "42", "é", "日", "\u00a0", "<|endoftext|>", "<|", "x'", "\u0301", "\U0001f600"]
    for _ in range(400):
        text = "".join(rng.choice(units) for _ in range(rng.randint(0, 12)))
        t = c.table(text)
        # a prefix that ends inside an added token's string is no longer that token
        want = [len(lib.encode(text[:p], add_special_tokens=False).ids) for p in range(len(text) + 1)]
        assert [t.count(p) for p in range(len(text) + 1)] == want, repr(text)
        for budget in (0, 1, 3, 6):
            assert t.longest_within(budget) == max(p for p, n in enumerate(want) if n <= budget), (repr(text), budget)


@pytest.mark.parametrize("text", ["=" * 20_000, "\n" * 20_000 + "x", "a" * 20_000, " " * 20_000 + "word", "'" * 20_000])
def test_long_runs_take_linear_time(text):
    import time
    from vigil.llm import token_counts as TC
    t0 = time.time()
    t = TC.counter(public_tokenizers.path("byte_bpe_50k.json")).table(text)
    assert t.longest_within(8) > 0 and time.time() - t0 < 20
