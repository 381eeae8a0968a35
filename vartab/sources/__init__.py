"""Readers: text (VCF, GTF, VEP tab), CSV and Parquet scans."""

from vartab.sources.blocks import read_blocks, write_blocks  # noqa: F401
from vartab.sources.bucketed import BucketedScores, is_bucketed, read_bucketed  # noqa: F401
from vartab.sources.tables import (  # noqa: F401
    read_annotations, read_csv_tables, read_nmd_csv, read_parquet, read_parts,
    read_score_files,
)
from vartab.sources.text import read_gtf, read_vcf, read_vcf_header, read_vep_tab  # noqa: F401
