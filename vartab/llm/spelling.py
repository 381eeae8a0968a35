"""Spelling variants by k-d trees over letter counts (operator 13).

Words are counted in the tasks. Two words are near if one edit (a code point
inserted, deleted or replaced) makes one of the other. An edit adds at most one
to one letter count and takes at most one from another, so near words lie within
L1 distance two, in boxes that a k-d tree can prune: per pair of lengths (L, L)
and (L, L + 1) a word is looked for only where the counts go up by at most one and
(for L, L) down by at most one.

Trees are built twice. Upper trees, one per length, on the letter counts of a
bounded sample of the words (``SAMPLE``), have cells of about ``CELL_WORDS`` words;
every word has its home cell and visits the other cells within reach. Each cell is a
task's group: its words get a k-d tree of their own, visitors and words are searched
in it, and what the boxes leave is verified letter by letter. A cell that the upper
tree can't part further (many words of the same letters) is dealt into parts by hash
and its visitors into tiles, so no group outgrows a task. Tasks send on counts and
best partners per word, not pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.llm.common import stored

# The letters of a word, and which occurrences lose a code point.
LETTERS = "A-Za-zÀ-ÿ"
DELETE_EVERY = 31
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 7, 2, 10

SAMPLE = 65_536       # words (about) that the upper trees are built on
CELL_WORDS = 20_000   # words of a cell, as the sample has it
CELL_BYTES = 24 << 20  # of home words, or of visitors, in one group
LEAF_WORDS = 16
HELD_WORDS = 300_000  # counted in a task before they are sent on
PAIRS = 1 << 20       # found in a group before they are added up
_ROW_BYTES = 200      # what a word takes in a group beside its letters
_ROOM = 1 << 20       # cells of one length

_RUN = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_CODE = np.full(256, 255, np.uint8)
_CODE[_ALPHABET] = np.arange(len(_ALPHABET))
DIMS = len(_ALPHABET)


# --- words and their counts ----------------------------------------------------------------------------------------

def words_of(doc_id: int | None, text: str | None) -> Counter:
    """Occurrences of the words of a text, after the deletions, that are long enough."""
    start, out = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in Counter(map(itemgetter(0), _RUN.finditer(text or ""))).items():
        word = run.lower() if run.isascii() else run.translate(_LOWER)
        h = zlib.crc32(word.encode(), start)
        if h % DELETE_EVERY == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < LEAST_LENGTH:
                continue
        out[word] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words met at least twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(held)
            for a in range(0, len(words), 50_000):
                part = words[a:a + 50_000]
                yield pa.RecordBatch.from_pydict({"word": pa.array(part, pa.string()), "n": pa.array([held[w] for w in part], pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                got = words_of(doc_id, text.as_py())
                held.update(got)
                size += sum(map(len, got))
                if len(held) > HELD_WORDS or size > 64 * HELD_WORDS:
                    yield from flush()
                    held, size = Counter(), 0
        yield from flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (rows.filter("text IS NOT NULL").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT))


# --- letter counts and k-d trees -----------------------------------------------------------------------------------

def letters(words: list[bytes], length: int) -> np.ndarray:
    """Letter codes of words of one length, a row each; words are Latin-1 bytes."""
    return _CODE[np.frombuffer(b"".join(words), np.uint8)].reshape(len(words), length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each letter is in each row of codes."""
    n, length = codes.shape
    out = np.empty((n, DIMS), np.uint8 if length < 256 else np.int32)
    step = max(1, (1 << 20) // max(DIMS, length))
    for a in range(0, n, step):
        part = codes[a:a + step]
        key = part.astype(np.int64) + np.arange(len(part))[:, None] * DIMS
        out[a:a + step] = np.bincount(key.ravel(), minlength=len(part) * DIMS).reshape(-1, DIMS)
    return out


@dataclass
class Tree:
    """A k-d tree: node i sends counts of ``dim[i]`` up to ``cut[i]`` to ``left[i]``,
    others to ``right[i]``; a dim of -1 - k marks leaf k."""

    dim: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: list[np.ndarray]

    @classmethod
    def build(cls, counts: np.ndarray, most: int, rows: np.ndarray | None = None) -> Tree:
        """Leaves of at most ``most`` rows, but for rows of equal counts."""
        dim, cut, left, right, leaves = [], [], [], [], []

        def grow(at: np.ndarray) -> int:
            me = len(dim)
            for part in (dim, cut, left, right):
                part.append(0)
            if len(at) > most:
                held = counts[at]
                low, high = held.min(0), held.max(0)
                for j in np.argsort(-held.var(0, dtype=np.float32), kind="stable"):
                    if low[j] == high[j]:
                        break
                    t = min(int(np.median(held[:, j])), int(high[j]) - 1)
                    under = held[:, j] <= t
                    dim[me], cut[me] = int(j), t
                    del held
                    left[me] = grow(at[under])
                    right[me] = grow(at[~under])
                    return me
            dim[me] = -1 - len(leaves)
            leaves.append(at)
            return me

        grow(np.arange(len(counts)) if rows is None else rows)
        return cls(*(np.array(x, np.int32) for x in (dim, cut, left, right)), leaves)

    def reach(self, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``counts``) for the rows that can have a word there whose counts
        are ``up`` more and ``down`` less in all, by the leaf's box."""
        n = len(counts)
        none = np.zeros(n, np.int32)
        stack = [(0, np.arange(n), none, none, {}, {})]
        while stack:
            node, at, more, less, low, high = stack.pop()
            j = int(self.dim[node])
            if j < 0:
                yield -1 - j, at
                continue
            t, c = int(self.cut[node]), counts[at, j].astype(np.int32)
            # what the box asks in this dimension now, less what it asked before
            less2 = less + np.maximum(c - t, 0) - (np.maximum(c - high[j], 0) if j in high else 0)
            more2 = more + np.maximum(t + 1 - c, 0) - (np.maximum(low[j] - c, 0) if j in low else 0)
            go = less2 <= down
            if go.any():
                stack.append((int(self.left[node]), at[go], more[go], less2[go], low, {**high, j: t}))
            go = more2 <= up
            if go.any():
                stack.append((int(self.right[node]), at[go], more2[go], less[go], {**low, j: t + 1}, high))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two code matrices of one length differ in just one place."""
    return (a != b).sum(axis=-1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of b (one code longer) are the row of a with one code inserted."""
    head = np.logical_and.accumulate(a == b[..., :-1], axis=-1).sum(axis=-1)
    tail = np.logical_and.accumulate((a == b[..., 1:])[..., ::-1], axis=-1).sum(axis=-1)
    return head + tail >= a.shape[-1]


def near_pairs(home: np.ndarray, others: np.ndarray, shorter: np.ndarray, among_home: bool = True) -> Iterator[tuple]:
    """(kind, rows of home, rows of the kind) of the near pairs between the words of a
    cell and its visitors: kind 0 home words, 1 others of that length, 2 shorter ones.
    A pair of home words comes once."""
    counts = letter_counts(home)
    tree = Tree.build(counts, LEAF_WORDS)
    searches = [(0, home, counts, 1, 1)] if among_home else []
    searches += [(1, others, letter_counts(others), 1, 1)] if len(others) else []
    searches += [(2, shorter, letter_counts(shorter), 1, 0)] if len(shorter) else []
    for kind, codes, its_counts, up, down in searches:
        for leaf, at in tree.reach(its_counts, up, down):
            rows = tree.leaves[leaf]
            for b in range(0, len(rows), 256):
                part = rows[b:b + 256]
                step = max(1, (4 << 20) // (len(part) * home.shape[1]))
                for a in range(0, len(at), step):
                    some = at[a:a + step]
                    test = one_inserted if kind == 2 else one_replaced
                    i, j = np.nonzero(test(codes[some][:, None, :], home[part][None, :, :]))
                    i, j = some[i], part[j]
                    if kind == 0:
                        i, j = i[i < j], j[i < j]
                    if len(i):
                        yield kind, j, i


# --- the operator --------------------------------------------------------------------------------------------------

def _by_word_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, rows of words of that length), rows in slices of bounded bytes."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == length)
        step = max(1, CELL_BYTES // (length + DIMS))
        for a in range(0, len(rows), step):
            yield length, rows[a:a + step]


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def upper_trees(words: DataFrame, total: int, size: int = SAMPLE, cell_words: int = CELL_WORDS) -> dict[int, Tree]:
    """A tree per length over the letter counts of about ``size`` words, those with
    the smallest hashes; the driver gets their counts, ``DIMS`` numbers a word."""
    share = min(1.0, size / max(1, total))
    picked = words.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 40)) < int(share * (1 << 40))) if share < 1 else words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = _latin(batch["word"])
            for length, rows in _by_word_length(held):
                counts = letter_counts(letters([held[i] for i in rows], length)).astype("<i4")
                yield pa.RecordBatch.from_pydict({"length": pa.array([length] * len(rows), pa.int32()),
                                                  "counts": pa.array([c.tobytes() for c in counts], pa.binary())})

    by_length: dict[int, list[bytes]] = {}
    for r in picked.select("word").mapInArrow(run, "length int, counts binary").collect():
        by_length.setdefault(r["length"], []).append(bytes(r["counts"]))
    most = max(4, round(cell_words * share))
    return {length: Tree.build(np.frombuffer(b"".join(sorted(rows)), "<i4").reshape(-1, DIMS), most)
            for length, rows in by_length.items()}


def _no_leaves(trees: dict[int, Tree]) -> dict[int, Tree]:
    """The trees without the sample's rows, as they travel to the tasks."""
    return {k: Tree(t.dim, t.cut, t.left, t.right, []) for k, t in trees.items()}


_WHOLE = Tree(np.array([-1], np.int32), *(np.zeros(1, np.int32) for _ in range(3)), [])
HOME, SAME, SHORTER = 0, 1, 2


def _dealt(words: DataFrame, trees: dict[int, Tree], parts: dict[int, tuple[int, int]]) -> DataFrame:
    """(cell, part, tile, role, word, n): every word at home and where it visits.
    ``parts`` has (parts of the home words, tiles of the visitors) of the cells that
    are too large for one group. Of two cells of one length the words of the lower one
    visit, likewise of two parts of a cell."""
    sent = words.sparkSession.sparkContext.broadcast((_no_leaves(trees), parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, split = sent.value
        for batch in batches:
            held = _latin(batch["word"])
            hashes = np.array([zlib.crc32(w) for w in held], dtype=np.int64) if split else np.zeros(len(held), np.int64)
            for length, rows in _by_word_length(held):
                counts = letter_counts(letters([held[i] for i in rows], length))
                tree, longer = upper.get(length, _WHOLE), upper.get(length + 1, _WHOLE)
                home = np.zeros(len(rows), np.int64)
                for leaf, at in tree.reach(counts, 0, 0):
                    home[at] = leaf
                places = [(length, leaf, at, HOME) for leaf, at in tree.reach(counts, 0, 0)]
                places += [(length, leaf, at[home[at] < leaf], SAME) for leaf, at in tree.reach(counts, 1, 1)]
                places += [(length + 1, leaf, at, SHORTER) for leaf, at in longer.reach(counts, 1, 0)]
                for size, leaf, at, role in places:
                    cell = size * _ROOM + leaf
                    n_parts, tiles = split.get(cell, (1, 1))
                    mine, tile = hashes[rows[at]] % n_parts, (hashes[rows[at]] >> 13) % tiles
                    for part in range(n_parts):
                        if role == HOME:
                            own, before = at[mine == part], at[mine < part]
                            sends = [(HOME, own, np.full(len(own), t)) for t in range(tiles)] + [(SAME, before, tile[mine < part])]
                        else:
                            sends = [(role, at, tile)]
                        for kind, some, to in sends:
                            if len(some):
                                k, which = len(some), pa.array(rows[some])
                                yield pa.RecordBatch.from_arrays(
                                    [pa.array(np.full(k, cell)), pa.array(np.full(k, part, np.int32)), pa.array(to.astype(np.int32)),
                                     pa.array(np.full(k, kind, np.int32)), batch["word"].take(which), batch["n"].take(which)],
                                    ["cell", "part", "tile", "role", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "cell long, part int, tile int, role int, word string, n long")


def _search_group(group: pa.Table) -> pa.Table:
    """Per word of one group: how many near words it has there, and the best of them."""
    length = group["cell"][0].as_py() // _ROOM
    role = group["role"].to_numpy()
    words, n = group["word"].to_pylist(), group["n"].to_numpy()
    place = np.empty(len(words), np.int64)  # in code-point order
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    rows = [np.flatnonzero(role == kind) for kind in (HOME, SAME, SHORTER)]
    codes = [letters([words[i].encode("latin-1") for i in r], length - (kind == SHORTER)) for kind, r in enumerate(rows)]
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
    held: list[np.ndarray] = []

    def add() -> None:
        if not held:
            return
        a, b = np.concatenate(held, axis=1)
        held.clear()
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        near[:] += np.bincount(a, minlength=len(words))
        known = np.flatnonzero(best >= 0)
        a, b = np.concatenate([a, known]), np.concatenate([b, best[known]])
        order = np.lexsort((place[b], -n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        best[a[first]] = b[first]

    if len(rows[HOME]):
        for kind, i, j in near_pairs(codes[HOME], codes[SAME], codes[SHORTER], group["tile"][0].as_py() == 0):
            held.append(np.stack([rows[HOME][i], rows[kind][j]]))
            if sum(h.shape[1] for h in held) > PAIRS:
                add()
        add()
    found = np.flatnonzero(near)
    return pa.table({"word": group["word"].take(pa.array(found)), "n_near": pa.array(near[found]),
                     "form_n": pa.array(n[best[found]]), "form": group["word"].take(pa.array(best[found]))})


def near_words(words: DataFrame, sample: int = SAMPLE, cell_words: int = CELL_WORDS, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """(word, n_near, best struct<less long, form string>) of the words that have near
    ones, from stored (word, n); ``less`` is minus the n of ``form``."""
    total = words.count()
    trees = upper_trees(words, total, sample, cell_words)
    sizes = (_dealt(words, trees, {}).groupBy("cell")
             .agg(F.sum(F.when(F.col("role") == HOME, F.length("word") + _ROW_BYTES).otherwise(0)).alias("home"),
                  F.sum(F.when(F.col("role") != HOME, F.length("word") + _ROW_BYTES).otherwise(0)).alias("visits")))
    parts = {}
    for r in sizes.filter((F.col("home") > cell_bytes) | (F.col("visits") > cell_bytes)).collect():  # of the trees' cells
        n_parts = -(-r["home"] // cell_bytes)
        parts[r["cell"]] = (n_parts, max(1, -(-(r["visits"] + (r["home"] if n_parts > 1 else 0)) // cell_bytes)))
    found = (_dealt(words, trees, parts).groupBy("cell", "part", "tile")
             .applyInArrow(_search_group, "word string, n_near long, form_n long, form string"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of the chain that starts at each word.
    A form is ten times as frequent as its word, so with counts below 2**63 no chain
    has more than 19 links and five doublings do."""
    jump = stored(links.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(5):
        step = jump.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if jump.join(step, "root", "left_semi").isEmpty():
            break
        jump = stored(jump.join(step, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "spelling-roots")
    return jump


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
             cell_words: int = CELL_WORDS, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word met twice or more.

    Defined cases: null and empty texts have no words; a null doc_id counts as an
    empty one where it is hashed; rows that share an id or a text count each; a word
    may be as long as a text; ties of n go to the smaller word in code-point order;
    an empty table gives no rows. Other columns are not read, whatever their names."""
    words = stored(vocabulary(docs, id_col, text_col), "spelling-words")
    near = near_words(words, sample, cell_words, cell_bytes)
    formed = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    judged = stored(words.join(near, "word", "left").select(
        "word", F.when(formed, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, -F.col("best.less")).alias("form_n")), "spelling-judged")
    return (judged.join(roots(judged.filter("form IS NOT NULL")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
