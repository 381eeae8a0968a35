import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import bpe
from vartab.llm.common import table
from vartab.llm.queries import op2_byte_bpe, vocabulary


@pytest.fixture(scope="module")
def vocab():
    return vocabulary()


@pytest.fixture(scope="module")
def reference(vocab):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def hard_texts():
    rng = random.Random(1)
    some = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\ta  b", "a" * 5000, "&&&&&" * 200, " \n\n \t x" * 50,
            "日本語テキスト한국어 текст العربية \U0001f389\U0001f389", "0123456789" * 300, "<|endoftext|>", "é" * 999, "Zz9/+" * 500,
            "\x00\x01� ", " " * 2000, "abcabcab" * 321, "it's they'll WE'RE 'tis", "qwertyuiopasdfghjklzxcvbnm" * 100,
            "x  y  z", " ŉ ʼn ǅ ɐɐ aɐ"]
    some += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8000)),
             "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xa0, 0x3000), rng.randrange(0x4e00, 0x9fff)]))
                     for _ in range(4000))]
    some += ["".join(rng.choice(" \n\tab'sé1.,") for _ in range(40)) for _ in range(300)]
    return some


def test_same_as_the_library(vocab, reference):
    texts = hard_texts()
    got = vocab.encode(texts)
    for t, g in zip(texts, got, strict=True):
        assert ids_of(g) == reference.encode_ordinary(t), t[:60]
    assert vocab.decode(got) == [t.encode() for t in texts]


def test_small_cache_gives_the_same(vocab, reference):
    small = bpe.Vocabulary(vocab.ranks, vocab.pattern, cache_words=20)
    texts = hard_texts()[-50:] + ["several words of a longer text, one after another"] * 3
    assert [ids_of(g) for g in small.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_pattern_without_the_space_rule(vocab):
    plain = bpe.Vocabulary(vocab.ranks, r"\w+|\W", space_starts_word=False)
    other = tiktoken.Encoding("plain", pat_str=r"\w+|\W", mergeable_ranks=vocab.ranks, special_tokens={})
    texts = ["some words,  and signs!", "", "a b"]
    assert [ids_of(g) for g in plain.encode(texts)] == [other.encode_ordinary(t) for t in texts]


def test_texts_with_every_private_sign(vocab, reference):
    """No sign is left to mark cuts with."""
    texts = ["".join(map(chr, range(0xE000, 0xF900))) + " some words follow  here", "other words", ""]
    got = vocab.encode(texts)
    assert [ids_of(g) for g in got] == [reference.encode_ordinary(t) for t in texts]
    assert vocab.decode(got) == [t.encode() for t in texts]


def expected(reference, text):
    ids = np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_whole_table(spark, reference):
    texts = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    rows = op2_byte_bpe(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(reference, texts[r.doc_id])


def test_odd_rows(odd_docs, no_docs, vocab, reference):
    rows = bpe.round_trip(odd_docs, vocab).collect()
    want = [(r.doc_id, *expected(reference, r.text)) for r in odd_docs.collect()]
    assert sorted(map(str, [tuple(r) for r in rows])) == sorted(map(str, want))
    assert bpe.round_trip(no_docs, vocab).collect() == []


def test_encode_then_decode(odd_docs, vocab):
    texts = sorted((r.text or "").encode() for r in odd_docs.collect())
    assert sorted(bytes(r["bytes"]) for r in bpe.decode(bpe.encode(odd_docs, vocab), vocab).collect()) == texts
