"""CSQ payload -> one row per (variant, transcript), and the base table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vartab.functions import field, int_field, nullif_empty, small_variant_type
from vartab.operators.joins import BROADCAST_MAX_BYTES, broadcast_if_small

# 1-based positions of the CSQ fields that are kept.
CSQ_FIELDS = {
    "consequence": 2, "impact": 3, "gene": 5, "transcript": 7, "exon": 9, "intron": 10,
    "hgvsc": 11, "hgvsp": 12, "cdna_position": 13, "cds_position": 14,
    "protein_position": 15, "amino_acids": 16, "codons": 17, "distance": 21, "strand": 22,
    "ensp": 33,
}
_TEXT_AS_IS = ("gene", "transcript", "consequence", "impact")
_INT = ("distance", "strand")
_ANN_ORDER = ["variant_id", "chrom", "start", "ref", "alt", "variant_type", "gene", "transcript",
              "consequence", "impact", "distance", "exon", "intron", "hgvsc", "hgvsp",
              "cdna_position", "cds_position", "protein_position", "amino_acids", "codons",
              "strand", "ensp"]

# Columns of the base table, in output order.
BASE_COLUMNS = ["variant_id", "chrom", "start", "ref", "alt", "variant_type", "gene", "symbol",
                "transcript", "gene_type", "biotype", "canonical", "tsl", "consequence",
                "impact", "distance", "exon", "intron", "hgvsc", "hgvsp", "ensp",
                "cdna_position", "cds_position", "protein_position", "amino_acids", "codons",
                "strand"]


# Fixed value: an entry that names a gene, so has that field and not ``-`` in it.
_NAMES_GENE = rf"^(?:[^|]*\|){{{CSQ_FIELDS['gene'] - 1}}}(?!-(?:\||\z))"


def _payload(info: str) -> Column:
    return F.split(F.regexp_extract(F.col(info), r"CSQ=([^;]*)", 1), ",", -1)


def gene_entries(info: str) -> Column:
    """The ``CSQ=`` entries of INFO that name a gene, each as its split fields."""
    gene = CSQ_FIELDS["gene"] - 1
    entries = F.transform(_payload(info), lambda e: F.split(e, r"\|", -1))
    return F.filter(entries, lambda p: F.get(p, F.lit(gene)) != "-")


_KEYS = ["variant_id", "chrom", "start", "ref", "alt"]


def _named_entries(vcf: DataFrame) -> DataFrame:
    entries = vcf.select(*_KEYS, F.explode(_payload("info")).alias("entry"))
    return entries.filter(F.col("entry").rlike(_NAMES_GENE))


def csq_entries(vcf: DataFrame) -> DataFrame:
    """Explode ``CSQ=`` entries of INFO to rows with the split field array
    ``p``; variants without a CSQ payload and intergenic entries (Gene
    ``-`` or missing) are dropped. Entries are exploded as text and split once each, in
    compiled code (functions of array elements are interpreted)."""
    return _named_entries(vcf).select(*_KEYS, F.split("entry", r"\|", -1).alias("p"))


def _typed(name: str, raw: Column) -> Column:
    """A field's text as the column it is kept as."""
    if name in _TEXT_AS_IS:
        return raw
    return int_field(raw, "int") if name in _INT else nullif_empty(raw)


def explode_csq(vcf: DataFrame, track: str = "small") -> DataFrame:
    """(variant_id, chrom, start, ref, alt, info) -> variant x transcript rows
    with typed CSQ fields. ``track='sv'`` labels every row ``SV``."""
    if track not in ("small", "sv"):
        raise ValueError(f"track must be 'small' or 'sv', got {track!r}")
    vtype = F.lit("SV") if track == "sv" else small_variant_type("ref", "alt")
    cols = {k: F.col(k) for k in ("variant_id", "chrom", "start", "ref", "alt")}
    cols["variant_type"] = vtype
    for name, pos in CSQ_FIELDS.items():
        cols[name] = _typed(name, field("p", pos))
    return csq_entries(vcf).select(*[cols[n].alias(n) for n in _ANN_ORDER])


def union_tracks(small: DataFrame, sv: DataFrame | None = None) -> DataFrame:
    """Exploded small track, plus the SV track when given."""
    ann = explode_csq(small, "small")
    if sv is not None:
        ann = ann.unionByName(explode_csq(sv, "sv"))
    return ann


# The place of the last kept field.
_LAST = max(CSQ_FIELDS.values())


def _packed_entries(vcf: DataFrame, track: str) -> DataFrame:
    """The entries of ``csq_entries`` as they are shuffled: the keys in one text and the entry,
    up to its last kept field, in another, which takes two thirds of the bytes of a column
    for each. Keys that are missing or hold the text's separator travel as they are."""
    entries = _named_entries(vcf)
    transcript = field(F.split("entry", r"\|", -1), CSQ_FIELDS["transcript"])
    texts = [F.col(k).cast("string") for k in _KEYS]
    odd = reduce(lambda a, b: a | b, [t.isNull() | t.contains("\t") for t in texts])
    vtype = F.lit("SV") if track == "sv" else small_variant_type("ref", "alt")
    return entries.select(F.when(odd, F.struct(*_KEYS)).alias("_odd"), F.when(~odd, F.concat_ws("\t", *texts)).alias("_keys"),
                          vtype.alias("variant_type"), transcript.alias("transcript"),
                          F.substring_index("entry", "|", _LAST).alias("_packed"))


def _unpacked(rows: DataFrame) -> dict[str, Column]:
    """The columns of ``explode_csq`` from those of ``_packed_entries``."""
    text, entry = F.split("_keys", "\t", -1), F.split("_packed", r"\|", -1)
    types = {f.name: f.dataType for f in rows.schema["_odd"].dataType.fields}
    found = {k: F.when(F.col("_odd").isNull(), F.get(text, i).cast(types[k])).otherwise(F.col(f"_odd.{k}")) for i, k in enumerate(_KEYS)}
    return found | {n: _typed(n, field(entry, k)) for n, k in CSQ_FIELDS.items() if n != "transcript"}


def base_table(small: DataFrame, sv: DataFrame | None, metadata: DataFrame,
               broadcast_bytes: int | None = BROADCAST_MAX_BYTES) -> DataFrame:
    """The base table: exploded CSQ rows of both tracks, left-joined to
    transcript metadata on the transcript id (27 columns). Metadata past the broadcast
    bound are shuffled and hashed, a partition at a time, so that the exploded rows
    are shuffled, their fields packed, but never sorted and spilled."""
    meta = metadata.select(F.col("transcript_id").alias("transcript"), "symbol", "gene_type",
                           "biotype", "canonical", "tsl")
    side = broadcast_if_small(meta, broadcast_bytes)
    if side is not meta:
        return union_tracks(small, sv).join(side, "transcript", "left").select(*BASE_COLUMNS)
    ann = _packed_entries(small, "small")
    if sv is not None:
        ann = ann.unionByName(_packed_entries(sv, "sv"))
    rows, found = ann.join(side.hint("shuffle_hash"), "transcript", "left"), _unpacked(ann)
    return rows.select(*[found[c].alias(c) if c in found else F.col(c) for c in BASE_COLUMNS])
