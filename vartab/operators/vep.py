"""VEP tab rows -> the tidy VEP part (variant x transcript)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vartab.functions import key_parts, onehot_columns, paren_score, row_max, small_variant_type

# Optional VEP columns, kept when present, in output order.
VEP_TEXT_COLUMNS = ["Gene", "Feature", "BIOTYPE", "CANONICAL", "IMPACT", "SYMBOL", "Consequence"]
VEP_PAREN_SCORES = [("SIFT", "sift_score"), ("PolyPhen", "polyphen_score")]
VEP_NUMERIC = [("CADD_RAW", "CADD_raw"), ("CADD_PHRED", "CADD_PHRED"),
               ("PrimateAI", "PrimateAI_score"), ("am_pathogenicity", "alphamissense"),
               ("Condel", "Condel"), ("gnomADg_AF", "gnomADg_AF"), ("gnomADe_AF", "gnomADe_AF")]
SPLICEAI_PACKED = "SpliceAI_pred"
SPLICEAI_SEPARATE = ["SpliceAI_pred_DS_AG", "SpliceAI_pred_DS_AL",
                     "SpliceAI_pred_DS_DG", "SpliceAI_pred_DS_DL"]
LOFTEE_COLUMNS = ["LoF", "LoF_filter", "LoF_flags"]


def spliceai_delta(have: set[str]):
    """Max SpliceAI delta score: packed ``SYMBOL|AG|AL|DG|DL|...`` (fields
    1-4) or the separate DS columns that exist; None when neither does."""
    if SPLICEAI_PACKED in have:
        parts = F.split(F.col(SPLICEAI_PACKED), r"\|", -1)
        return row_max([F.get(parts, i).try_cast("double") for i in (1, 2, 3, 4)])
    present = [c for c in SPLICEAI_SEPARATE if c in have]
    if present:
        return row_max([F.col(c).try_cast("double") for c in present])
    return None


def tidy_vep(vep: DataFrame) -> DataFrame:
    """Keep-if-present projection of a VEP tab table (first column is the
    ``chrom_start_ref_alt`` key), numeric scores parsed leniently, SpliceAI
    collapsed to one delta, consequence terms one-hot (tinyint, NULL kept)."""
    first = vep.columns[0]
    if first != "Uploaded_variation":
        vep = vep.withColumnRenamed(first, "Uploaded_variation")
    have = set(vep.columns)
    key = key_parts(F.col("Uploaded_variation"))
    cols = [F.col("Uploaded_variation").alias("variant_id")]
    cols += [key[k].alias(k) for k in ("chrom", "start", "ref", "alt")]
    cols += [F.col(c) for c in VEP_TEXT_COLUMNS if c in have]
    cols += [paren_score(src).alias(dst) for src, dst in VEP_PAREN_SCORES if src in have]
    cols += [F.col(src).try_cast("double").alias(dst) for src, dst in VEP_NUMERIC if src in have]
    delta = spliceai_delta(have)
    if delta is not None:
        cols.append(delta.alias("SpliceAI_delta_score"))
    cols += [F.col(c) for c in LOFTEE_COLUMNS if c in have]
    out = vep.select(*cols).withColumn("variant_type", small_variant_type("ref", "alt"))
    if "Consequence" in have:
        out = out.select("*", *onehot_columns("Consequence", null_as_zero=False))
    return out
