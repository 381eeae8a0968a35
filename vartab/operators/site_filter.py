"""A Bloom filter over sites, to thin out a score table before it is shuffled.

Past the broadcast bound the sites no longer travel whole, but a filter of a few
bits each still does. It is a table of blocks: a site's hash picks one block of
``BLOCK_BITS`` bits and ``PROBES`` bits in it. Sites are dealt by block and each
block is put together by the tasks that get it, so neither the driver nor one task
sees all of them; the blocks, whose number is chosen from the counted sites, are
broadcast and every score row tests its own block where it is scanned. A row that
passes wrongly is dropped by the join that follows; no matching row is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768  # what Spark's bitmap aggregate holds
PROBES = 4
BITS_PER_SITE, LEAST_BITS_PER_SITE = 12, 4
FILTER_MAX_BYTES = 96 << 20  # packed blocks, which have no more than their own bytes in the driver
_BLOCK_BYTES = BLOCK_BITS // 8 + 64
_WORDS = BLOCK_BITS // 32


@dataclass
class SiteFilter:
    """``blocks``: (_block, _words array<int>); a block without sites has no row."""

    blocks: DataFrame
    n_blocks: int
    keys: tuple[str, ...]


def _place(keys: Sequence[str], n_blocks: int) -> tuple[Column, Column]:
    """(block, the bits that tell the places in it) of a row."""
    return F.pmod(F.xxhash64(*keys), F.lit(n_blocks)), F.xxhash64(F.lit("place"), *keys)


def _probe(places: str, i: int) -> str:
    return f"(shiftrightunsigned({places}, {15 * i}) & {BLOCK_BITS - 1})"


def build(sites: DataFrame, keys: Sequence[str], max_bytes: int, bits_per_site: int = BITS_PER_SITE) -> SiteFilter | None:
    """The filter of ``sites``: ``bits_per_site`` bits each, or as many as ``max_bytes``
    allows; None where that is less than ``LEAST_BITS_PER_SITE``. Counts the sites, so
    pass stored or cheap ones. Sites with a null key, which match nothing, are left out."""
    named = sites.select(*keys).dropna()
    n = named.count()
    bits = min(bits_per_site, max_bytes * BLOCK_BITS // _BLOCK_BYTES // max(n, 1))
    if bits < LEAST_BITS_PER_SITE:
        return None
    n_blocks = max(1, -(-n * bits // BLOCK_BITS))
    block, places = _place(keys, n_blocks)
    dealt = named.select(block.alias("_block"), places.alias("_places")).repartition("_block")
    probes = F.array(*[F.expr(_probe("_places", i)) for i in range(PROBES)])
    bitmap = (dealt.select("_block", F.explode(probes).alias("_at")).groupBy("_block")
              .agg(F.bitmap_construct_agg("_at").alias("_map")))
    # as integers, since a word of an array is found in constant time
    words = F.expr(f"transform(sequence(0, {_WORDS - 1}), i -> "
                   "cast(shiftright(shiftleft(cast(conv(hex(substring(_map, i * 4 + 1, 4)), 16, 10) AS bigint), 32), 32) AS int))")
    return SiteFilter(bitmap.select("_block", words.alias("_words")), n_blocks, tuple(keys))


def reduce_by(rows: DataFrame, sites: SiteFilter) -> DataFrame:
    """The rows whose keys may be among the sites (all that are, and about one in a
    hundred of the others), as a broadcast semi-join on the block."""
    block, places = _place(sites.keys, sites.n_blocks)
    # byte 4 w + b of the map is byte 3 - b of word w
    tests = [f"getbit(cast(get(_words, cast({at} div 32 AS int)) AS bigint), cast((3 - ({at} div 8) % 4) * 8 + {at} % 8 AS int)) = 1"
             for at in (_probe("_places", i) for i in range(PROBES))]
    marked = rows.select("*", block.alias("_own_block"), places.alias("_places"))
    found = marked.join(F.broadcast(sites.blocks), F.expr(" AND ".join(["_own_block = _block", *tests])), "left_semi")
    return found.drop("_own_block", "_places")
