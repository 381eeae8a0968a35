"""Consequence-term one-hot columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The consequence terms that get a one-hot column, in the
# order the output columns appear. They must equal the reference's list.
CONSEQUENCE_TERMS = [
    "splice_acceptor_variant", "splice_donor_variant", "splice_region_variant",
    "stop_gained", "stop_lost", "start_lost", "frameshift_variant",
    "inframe_insertion", "inframe_deletion", "missense_variant",
    "protein_altering_variant", "synonymous_variant",
    "5_prime_UTR_variant", "3_prime_UTR_variant",
    "upstream_gene_variant", "downstream_gene_variant", "intron_variant",
]


def onehot_columns(consequence: str | Column, null_as_zero: bool) -> list[Column]:
    """One column ``Consequence_<term>`` per term, literal substring match.

    ``null_as_zero=True`` gives int 0/1 with NULL -> 0 (the combined table);
    ``False`` gives tinyint with NULL kept (the VEP part).
    """
    c = F.col(consequence) if isinstance(consequence, str) else consequence
    out = []
    for term in CONSEQUENCE_TERMS:
        hit = c.contains(term)
        if null_as_zero:
            col = F.when(hit, F.lit(1)).otherwise(F.lit(0))
        else:
            col = hit.cast("tinyint")
        out.append(col.alias(f"Consequence_{term}"))
    return out
