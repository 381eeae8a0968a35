"""DataFrame -> DataFrame operators. None of them runs a job, except the
size check behind ``broadcast_if_small``, ``local_partitions`` and the nested bins."""

from vartab.operators import heavy  # noqa: F401
from vartab.operators.combine import COPARTITION_CONF, combine, copartition_session, repeated_keys  # noqa: F401
from vartab.operators.consequence import (  # noqa: F401
    BASE_COLUMNS, base_table, csq_entries, explode_csq, union_tracks,
)
from vartab.operators.enhancers import (  # noqa: F401
    collapse_pairs, enhancer_hits, enhancer_links, local_partitions, pair_intervals, variant_gene_links,
)
from vartab.operators.funnel import (  # noqa: F401
    analysis_set, analysis_variants, chromosome_subset, filter_lines, filter_variants, toggle_filter,
)
from vartab.operators.genes import gene_ids, gene_version_map, map_gene_versions  # noqa: F401
from vartab.operators.heavy import frequent_ids, heavy_ids, stored_frequent_ids  # noqa: F401
from vartab.operators.interval import NESTED_BINS, interval_bins, interval_join, nested_bins  # noqa: F401
from vartab.operators.joins import broadcast_if_small, measured_bytes  # noqa: F401
from vartab.operators.metadata import (  # noqa: F401
    canonical_picks, exons_from_gtf, gtf_attributes, transcript_metadata, transcripts_from_gtf,
)
from vartab.operators.near_gene import near_gene  # noqa: F401
from vartab.operators.nmd import exon_offsets, nmd_rules, tidy_nmd  # noqa: F401
from vartab.operators.scores import lookup_scores, splice_lookup  # noqa: F401
from vartab.operators.vep import tidy_vep  # noqa: F401
