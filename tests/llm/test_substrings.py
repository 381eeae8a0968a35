import hashlib
import random

import numpy as np
import pytest

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import substrings
from vartab.llm.common import table
from vartab.llm.queries import op4_substring_dedup
from vartab.llm.words import hash_windows, hash_words


def brute(rows, w):
    low = -(1 << 63)
    words = [((low if i is None else i), (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, x in words:
        for k in range(len(x) - w + 1):
            q = tuple(x[k:k + w])
            least[q] = min(least.get(q, i), i)
    out = []
    for (i, x), (doc, _) in zip(words, rows, strict=True):
        seen, gone = set(), [False] * len(x)
        for k in range(len(x) - w + 1):
            q = tuple(x[k:k + w])
            if least[q] < i or q in seen:
                gone[k:k + w] = [True] * w
            seen.add(q)
        kept = b" ".join(a for a, g in zip(x, gone, strict=True) if not g)
        out.append((doc, len(x), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in substrings.dedup_substrings(df, **kw).collect()), key=str)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = sorted((tuple(r) for r in op4_substring_dedup(spark, SF_SMALL).collect()), key=str)
    assert got == brute(rows, 20) and any(r[2] for r in got)


@pytest.mark.parametrize("kw", [{}, {"block_bytes": 3000, "shard_windows": 100}])
def test_odd_rows(odd_docs, no_docs, kw):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert run(odd_docs.filter("length(text) < 1000 or text is null"), window=3, **kw) == brute(
        [r for r in rows if len(r[1] or "") < 1000], 3)
    assert run(odd_docs, window=20) == brute(rows, 20)
    assert run(no_docs) == []


def test_random_texts_over_many_blocks_and_shards(spark):
    rng = random.Random(3)
    parts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(5, 12))) for _ in range(12)]
    rows = [(rng.randint(0, 30), rng.choice([" ", "\n", "  "]).join(rng.choice(parts) for _ in range(rng.randint(0, 6))))
            for _ in range(60)] + [(None, parts[0] + " " + parts[1])] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs, window=6, block_bytes=300, shard_windows=20) == brute(rows, 6)


def test_kept_text(spark):
    text = "a b c d e f"
    docs = spark.createDataFrame([(2, "x " + text + " y"), (1, text)], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in substrings.dedup_substrings(docs, window=6, with_text=True).collect()}
    assert got == {1: text, 2: "x y"}


def test_sketch_never_undercounts():
    rng = np.random.default_rng(4)
    cells = np.unique(rng.integers(0, 1 << 38, 5000, dtype=np.uint64))
    twice = rng.random(len(cells)) < 0.3
    a, b = substrings.unpack_cells(substrings.pack_cells(cells, twice))
    assert (a == cells).all() and (b == twice).all()


def test_window_hashes_are_by_content(monkeypatch):
    texts = [b"a b c d e", b"", b"x a b c d e\ty", b"b c", " é b c d e".encode()]
    whole = hash_words(texts)
    monkeypatch.setattr("vartab.llm.words.PIECE", 4)  # pieces cut between words
    assert (hash_words(texts).hashes == whole.hashes).all() and (hash_words(texts).first == whole.first).all()
    h, start = hash_windows(whole, 3)
    runs = [w.split() for w in texts]
    seen = {}
    for x, s in zip(h.tolist(), start.tolist(), strict=True):
        i = int(np.searchsorted(whole.first, s, side="right") - 1)
        k = s - whole.first[i]
        seen.setdefault(x, set()).add(tuple(runs[i][k:k + 3]))
    assert all(len(v) == 1 for v in seen.values()) and len(seen) == len(set().union(*seen.values()))
