import random

import numpy as np
import public_tokenizers
import tiktoken

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import packing
from vartab.llm.common import table
from vartab.llm.queries import op5_packed_rows, vocabulary


def best_fit(lengths, most):
    """Best fit decreasing by looking at every row; the rooms that are left."""
    room = []
    for n in sorted((n for n in lengths if n), reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
        else:
            room.append(most - n)
    return sorted(room)


def test_same_rooms_as_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        most = rng.randint(1, 70)
        lengths = [rng.randint(0, most) for _ in range(rng.randint(0, 60))]
        rows = packing.pack(lengths, most)
        assert sorted(i for r in rows for i in r) == [i for i, n in enumerate(lengths) if n]
        assert sorted(most - sum(lengths[i] for i in r) for r in rows) == best_fit(lengths, most)


def put_together(rows, dtype="<u2"):
    found = {}
    for r in rows:
        ids, positions = np.frombuffer(r.input_ids, dtype), np.frombuffer(r.position_ids, dtype)
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= len(ids) and r.n_segments == len(r.doc_ids)
        for doc, row, start, a, b in zip(r.doc_ids, r.doc_rows, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
            found.setdefault((r.partition, row, doc), {})[start] = ids[a:b].tolist()
    return sorted(str((k[2], sum((v[s] for s in sorted(v)), []))) for k, v in found.items())


def test_lossless_over_the_table(spark):
    v = vocabulary()
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    want = [(r.doc_id, coder.encode_ordinary(r.text or "")) for r in table(spark, SF_SMALL, "documents").collect()]
    assert put_together(op5_packed_rows(spark, SF_SMALL).collect()) == sorted(str(w) for w in want if w[1])


def test_long_blanks(spark, monkeypatch):
    v = vocabulary()
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    monkeypatch.setattr(packing, "_BLANKS", packing.re.compile(packing._BLANKS.pattern.replace("1000", "3")))
    own = packing.Coder(v.ranks, v.pattern)
    for blank in (" ", "\n", "\t ", " \u3000\x85", "\r\n"):
        for n in (1, 2, 3, 4, 9, 5000):
            for before, after in (("", ""), ("x", "y"), ("1", "'s"), ("!", "\x1cé"), ("", " 5"), (" ", "\n")):
                text = f"{before}{(blank * n)[:n]}{after}{(blank * n)[:n]}{before}"
                assert own.encode(text) == coder.encode_ordinary(text)
    monkeypatch.undo()
    texts = [" " * 1_200_000 + "a", "b" + "\n" * 1_100_000, "c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack_tokens(docs, v.ranks, v.pattern).collect()
    assert sum(r.n_tokens for r in rows) == 1_200_000 + 1_100_000 + 1 + 1 - 1 + 1


def test_odd_rows_and_small_chunks(odd_docs, no_docs):
    v = vocabulary()
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    want = [(r.doc_id, coder.encode_ordinary(r.text or "")) for r in odd_docs.collect()]
    for kw in ({"row_tokens": 64}, {"row_tokens": 50, "chunk_tokens": 40}, {"row_tokens": 1}):
        rows = packing.pack_tokens(odd_docs.select("doc_id", "text").filter("length(text) < 1000 or text is null"),
                                   v.ranks, v.pattern, **kw).collect()
        assert put_together(rows) == sorted(str(w) for w in want if 0 < len(w[1]) < 500)
    rows = packing.pack_tokens(odd_docs, v.ranks, v.pattern).collect()
    assert put_together(rows) == sorted(str(w) for w in want if w[1])
    assert packing.pack_tokens(no_docs, v.ranks, v.pattern).collect() == []
