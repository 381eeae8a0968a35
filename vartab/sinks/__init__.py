"""Writers. These are the only functions in the package that run jobs."""

from vartab.sinks import metrics  # noqa: F401
from vartab.sinks.bucketed import write_bucketed_scores  # noqa: F401
from vartab.sinks.metrics import merged_metrics, sketches, store_metrics  # noqa: F401
from vartab.sinks.writers import (  # noqa: F401
    compact_scores, distinct_counts, number_rows, run_metrics, sort_by_position, vcf_lines, write_annotations, write_chunks,
    write_ids, write_parquet, write_text, write_vcf, write_vcf_chunks, sort_annotation,
)
