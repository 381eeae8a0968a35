"""Similarity join on word shingles with Bayesian pruning (operator 7).

Documents are sets of hashed shingles of five words; two are linked when their
Jaccard similarity is at least 0.8. Texts with equal words are one vertex with a
number of copies. The steps:

1. Each text gets a key (digest of its words) and a MinHash signature; rows with
   equal keys are counted together.
2. Signatures are cut into bands; texts that agree on a band share a bucket.
   Buckets with one member go.
3. Within a bucket, pairs are compared by MinHash values in steps of ``STEP``;
   a pair is dropped as soon as the posterior probability that its similarity
   reaches the threshold, given the matches so far and a uniform prior, is below
   ``TOLERANCE``. What leaves the task is one row per member with the least
   member it hangs together with, never a pair; components of these rows are
   the sets in which links can lie.
4. Within a component, pairs are pruned the same way and the rest is verified
   exactly on the shingle sets. What leaves the task is, per member, the number
   of documents it is linked to and the least member it hangs together with.

Buckets and components beyond a size are dealt into tiles, each the pairs
between two chunks of members, so a task never holds more than two chunks.
Bands and rows are chosen so that a pair at the threshold misses every bucket
with odds of 3 in a million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vartab.llm.common import fresh, stored
from vartab.llm.graph import components
from vartab.llm.words import hash_windows, hash_words, mix

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
STEP = 32
TOLERANCE = 2e-5
BUCKET_CHUNK = 1024
COMPONENT_CHUNK = 256
BATCH_BYTES = 2 << 20

# letters and digits stay, in lower case; other ASCII signs are spaces
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def plain(text: str | None) -> bytes:
    """A text as its words are compared: lower case, without ASCII punctuation."""
    t = text or ""
    return (t if t.isascii() else t.lower()).encode("utf-8", "replace").lower().translate(_PLAIN)


def text_key(words: bytes) -> bytes:
    return hashlib.blake2b(b" ".join(words.split()), digest_size=16).digest()


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingles of text i are
    hashes[first[i]:first[i + 1]]. A text of fewer than ``size`` words is one
    shingle; one without words has none."""
    words = hash_words(texts)
    h, start = hash_windows(words, size)
    owner = np.searchsorted(words.first, start, side="right") - 1
    counts = words.counts()
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        extra = []
        for i in few.tolist():
            acc = np.uint64(counts[i])
            for x in words.hashes[words.first[i]:words.first[i + 1]]:
                acc = mix(np.array([acc ^ x], np.uint64))[0]
            extra.append(acc)
        h, owner = np.concatenate([h, np.array(extra, np.uint64)]), np.concatenate([owner, few])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(h: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """MinHash values (texts x count), of which 16 bits are kept; all ones for empty sets."""
    out = np.full((len(first) - 1, count), 0xFFFF, np.uint16)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        starts = first[:-1][some]
        for i, a in enumerate(np.random.default_rng(5).integers(1, 1 << 62, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)):
            out[some, i] = np.minimum.reduceat((h * a) >> np.uint64(32), starts).astype(np.uint16)
    return out


def least_matches(count: int, step: int, threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(n, m): after n values a pair with fewer than m matches is dropped, since
    P(similarity >= threshold | matches) < tolerance under a uniform prior."""
    grid = (np.arange(20000) + 0.5) / 20000
    out = []
    for n in [*range(step, count, step), count]:
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            mass = np.exp(logs - logs.max())
            if mass[grid >= threshold].sum() >= tolerance * mass.sum():
                out.append((n, m))
                break
    return out


def survivors(one: np.ndarray, many: np.ndarray, rule: list[tuple[int, int]]) -> np.ndarray:
    """Indexes of the rows of ``many`` that the incremental comparison with ``one`` keeps."""
    left, matches, at = np.arange(len(many)), np.zeros(len(many), np.int32), 0
    for n, m in rule:
        matches = matches + (many[left, at:n] == one[at:n]).sum(1)
        keep = matches >= m
        left, matches, at = left[keep], matches[keep], n
        if not len(left):
            break
    return left


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _sliced(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t or "") > BATCH_BYTES:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t or "")
    if part:
        yield part


def signed(docs: DataFrame, id_col: str, text_col: str, shingle: int, count: int) -> DataFrame:
    """doc_id, key, n (shingles), sig and short (its low bytes) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _sliced(batch["text"].to_pylist()):
                texts = [plain(t) for t in part]
                h, first = shingle_sets(texts, shingle)
                sig = signatures(h, first, count)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(at, len(part)), pa.array([text_key(t) for t in texts], pa.binary()),
                     pa.array(np.diff(first), pa.int32()), pa.array([s.tobytes() for s in sig], pa.binary()),
                     pa.array([s.astype(np.uint8).tobytes() for s in sig], pa.binary())],
                    ["doc_id", "key", "n", "sig", "short"])
                at += len(part)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, key binary, n int, sig binary, short binary")


def _tiled(rows: DataFrame, size: str, chunk: int, by: str) -> DataFrame:
    """Rows with ``tile`` and ``side``: groups of up to ``chunk`` are tile 0; others
    are cut into c chunks by hash, and chunk i goes to the tiles (i, j) and (j, i)."""
    c = F.ceil(F.col(size) / F.lit(chunk)).cast("int")
    mine = F.pmod(F.xxhash64(by), F.col("_c")).cast("int")
    cut = rows.withColumn("_c", c).withColumn("_mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("_c") - 1))
    return (cut.withColumn("_other", other)
            .withColumn("tile", F.least("_mine", "_other") * F.col("_c") + F.greatest("_mine", "_other"))
            .withColumn("side", (F.col("_mine") > F.col("_other")).cast("int"))
            .drop("_c", "_mine", "_other"))


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, list]]:
    """The runs of equal ``names`` of sorted batches, as lists by column."""
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        cols = [held[c].to_numpy() for c in names]
        new = np.zeros(held.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(new).tolist()
        if cuts:  # the last run may go on in the next batch
            done = held.slice(0, cuts[-1]).to_pydict()
            for a, b in zip([0, *cuts[:-1]], cuts, strict=True):
                yield {k: v[a:b] for k, v in done.items()}
            held = held.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held.to_pydict()


def _hang_together(batches: Iterator[pa.RecordBatch], rule: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Step 3: (a, b) = (member, least member of its set in the tile)."""
    a, b = [], []
    for g in _groups(batches, ["bucket", "tile"]):
        keys = g["key"]
        if len(keys) > 1:
            order = sorted(range(len(keys)), key=keys.__getitem__)
            keys = [keys[i] for i in order]
            sig = np.frombuffer(b"".join(g["short"][i] for i in order), np.uint8).reshape(len(keys), -1)
            sets, todo = _Union(len(keys)), np.arange(len(keys))
            while len(todo):  # breadth first from the least member not reached yet
                reached, todo = [int(todo[0])], todo[1:]
                for x in reached:
                    if not len(todo):
                        break
                    hit = survivors(sig[x], sig[todo], rule)
                    for y in todo[hit].tolist():
                        sets.join(x, y)
                        reached.append(y)
                    todo = np.delete(todo, hit)
            for i, k in enumerate(keys):
                if (root := sets.find(i)) != i:
                    a.append(k)
                    b.append(keys[root])
        if len(a) > 20_000:
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
            a, b = [], []
    yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _verified(batches: Iterator[pa.RecordBatch], rule: list[tuple[int, int]], threshold: float) -> Iterator[pa.RecordBatch]:
    """Step 4: per member and tile, the documents linked to it and the least
    member of its set. In a tile of two chunks only pairs across count."""
    for g in _groups(batches, ["comp", "tile"]):
        keys = g["key"]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys, side = [keys[i] for i in order], np.array([g["side"][i] for i in order])
        copies = [g["copies"][i] for i in order]
        # a tile (i, i) has one side only, and all its pairs count
        across = g["two_sided"][0]
        sig = np.frombuffer(b"".join(g["sig"][i] for i in order), np.uint16).reshape(len(keys), -1)
        members = [np.frombuffer(g["shingles"][i], np.uint64) for i in order]
        size = np.array([len(m) for m in members])
        sets, links = _Union(len(keys)), [0] * len(keys)
        for x in range(len(keys) - 1):
            rest = np.arange(x + 1, len(keys))
            if across:
                rest = rest[side[rest] != side[x]]
            # sizes alone bound the similarity
            rest = rest[np.minimum(size[rest], size[x]) >= threshold * np.maximum(size[rest], size[x])]
            rest = rest[survivors(sig[x], sig[rest], rule)]
            if not len(rest):
                continue
            flat, mine = np.concatenate([members[y] for y in rest]), members[x]
            at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
            shared = np.add.reduceat((mine[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(size[rest])[:-1]]))
            linked = rest[shared >= threshold * (size[rest] + size[x] - shared) - 1e-9]
            for y in linked.tolist():
                sets.join(x, y)
                links[x] += copies[y]
                links[y] += copies[x]
        yield pa.RecordBatch.from_pydict({
            "key": pa.array(keys, pa.binary()), "linked": pa.array(links, pa.int64()),
            "label": pa.array([keys[sets.find(i)] for i in range(len(keys))], pa.binary())})


def classes(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, id_col: str = "doc_id",
            text_col: str = "text", bands: int = BANDS, rows: int = ROWS, tolerance: float = TOLERANCE,
            bucket_chunk: int = BUCKET_CHUNK, component_chunk: int = COMPONENT_CHUNK) -> DataFrame:
    """Per row of ``docs``: doc_id, key, class_id (the least doc_id of its class:
    all that chains of links reach), n_links (rows it is linked to, copies
    included) and class_key (the key of the class, as ids may repeat; null for
    texts without words).

    Defined cases: a null text is an empty one; texts without words have no
    links and each row is its own class; texts of one to four words are linked
    to texts with the same words; rows that share a doc_id are different rows,
    and copies if their words are equal; a null doc_id is the least; an empty
    table gives no rows. Other columns are not read, whatever their names."""
    count = bands * rows
    base = stored(signed(docs, id_col, text_col, shingle, count), "signed")
    vertices = (base.filter("n > 0").groupBy("key", "n", "sig", "short")
                .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"),
                     F.max(F.col("doc_id").isNull()).alias("no_id")))
    vertices = stored(vertices, "texts")
    rule = least_matches(count, STEP, threshold, tolerance)

    # buckets: one long per band, counted before anything else is carried along
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(
        i, F.substring(F.col("sig"), i * (2 * rows) + 1, F.lit(2 * rows)))))
    in_bands = vertices.select("key", band.alias("bucket"))
    sizes = in_bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = in_bands.join(sizes, "bucket")
    tiles = _tiled(shared.join(vertices.select("key", "short"), "key"), "members", bucket_chunk, "key").select("bucket", "tile", "key", "short")
    hung = (tiles.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile")
            .mapInArrow(lambda b: _hang_together(b, rule), "a binary, b binary"))
    comps = stored(components(hung), "candidates")

    # exact verification inside the components
    weights = comps.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    inside = vertices.join(comps.withColumnRenamed("node", "key"), "key").join(weights, "label")
    wanted = inside.select("key", "label", "members", "copies", "sig")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Key and words of every text, copies once a task."""
        seen: set[bytes] = set()
        for batch in batches:
            for part in _sliced(batch["text"].to_pylist()):
                texts = {text_key(t): t for t in map(plain, part)}
                new = [k for k in texts if k not in seen]
                seen.update(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new, pa.binary()), pa.array([texts[k] for k in new], pa.binary())], ["key", "words"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, first = shingle_sets(batch["words"].to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array([h[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                ["key", "shingles"])

    texts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(once, "key binary, words binary")
    # one plan at every size: both sides meet by key, few candidates are not broadcast
    shingles = (texts.join(comps.select(F.col("node").alias("key")).hint("merge"), "key").dropDuplicates(["key"])
                .mapInArrow(sets, "key binary, shingles binary"))
    full = wanted.join(shingles, "key").withColumnRenamed("label", "comp_key")
    full = _tiled(full.withColumn("comp", F.xxhash64("comp_key")), "members", component_chunk, "key")
    chunks = F.ceil(F.col("members") / F.lit(component_chunk)).cast("int")
    two = (F.col("members") > component_chunk) & (F.floor(F.col("tile") / chunks) != F.col("tile") % chunks)
    found = (full.withColumn("two_sided", two)
             .select("comp", "tile", "side", "two_sided", "key", "copies", "sig", "shingles")
             .repartition("comp", "tile").sortWithinPartitions("comp", "tile")
             .mapInArrow(lambda b: _verified(b, rule, threshold), "key binary, linked long, label binary"))
    found = stored(found, "links")

    labels = components(found.select(F.col("key").alias("a"), F.col("label").alias("b")))
    linked = found.groupBy("key").agg(F.sum("linked").alias("linked"))
    least = F.when(F.col("no_id"), None).otherwise(F.col("least_id"))
    per_text = (vertices.select("key", "copies", "least_id", "no_id")
                .join(linked, "key", "left").join(labels.withColumnRenamed("node", "key"), "key", "left")
                .withColumn("class_key", F.coalesce("label", "key")))
    heads = per_text.groupBy("class_key").agg(
        F.min("least_id").alias("least_id"), F.max("no_id").alias("no_id")).select("class_key", least.alias("class_id"))
    per_text = (per_text.join(heads, "class_key")
                .select("key", "class_key", "class_id",
                        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = base.filter("n > 0").select("doc_id", "key").join(per_text, "key").select(
        "doc_id", "key", "class_key", "class_id", "n_links")
    empty = base.filter("n = 0").select("doc_id", "key", F.lit(None).cast("binary").alias("class_key"), F.col("doc_id").alias("class_id"),
                                        F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(empty)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every class of ``docs`` (doc_id, text and any others), with all
    its columns: the one with the least doc_id, then key. Texts without words
    all stay; of rows with equal id and words one stays, whichever."""
    rows = stored(classes(docs, threshold), "classes")
    heads = (rows.filter("class_key is not null").groupBy("class_key")
             .agg(F.min(F.struct("doc_id", "key")).alias("h")).select("h.doc_id", "h.key"))
    heads = heads.unionByName(rows.filter("class_key is null").select("doc_id", "key")).distinct()
    head_id, head_key, key, some = (fresh(docs, c) for c in ("_head_id", "_head_key", "_key", "_some"))
    heads = heads.select(F.col("doc_id").alias(head_id), F.col("key").alias(head_key))
    many = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1 or doc_id is null").limit(1).count()
    if not many:  # an id names a row, so the id decides
        return docs.join(heads, F.col("doc_id") == F.col(head_id), "left_semi").select(*docs.columns)

    schema = T.StructType([*docs.schema.fields, T.StructField(key, T.BinaryType()), T.StructField(some, T.BooleanType())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [plain(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([text_key(t) for t in texts], pa.binary()),
                 pa.array([bool(t.split()) for t in texts], pa.bool_())], [*batch.schema.names, key, some])

    kept = docs.mapInArrow(keyed, schema).join(
        heads, F.col("doc_id").eqNullSafe(F.col(head_id)) & (F.col(key) == F.col(head_key)), "left_semi")
    once = kept.filter(F.col(some)).dropDuplicates(["doc_id", key]).unionByName(kept.filter(~F.col(some)))
    return once.select(*docs.columns)
