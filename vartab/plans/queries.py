"""Registered queries: one per operator of the inventory, each a callable
``(spark, sf_dir) -> DataFrame`` over the fixtures derived from the
tables in ``sf_dir``. The matching DuckDB oracle text lives in
``vartab.plans.oracles`` under the same key.

Queries named ``scan_*``, ``read_*``, ``filtered_vcf``, ``chunk_export``,
``sorted_gtf``, ``concat_chunks`` and ``overwrite_drops_stale`` write their
input to a fresh folder under the shared checkpoint directory first and
return what the reader gives back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vartab import operators as ops
from vartab import sinks, sources
from vartab.functions import key_parts, paren_score, small_variant_type, variant_key
from vartab.functions.consequences import onehot_columns
from vartab.operators.vep import spliceai_delta
from vartab.plans import inputs as I
from vartab.plans.fixtures import Fixtures
from vartab.plans.annotation import AnnotationConfig, E2GConfig, Inputs, annotate, annotation_passes, annotation_table
from vartab.session import listing_session, work_dir

# Parameters of the registered queries (chosen so every filter removes rows).
ANALYSIS_WINDOW = 500
NEAR_GENE_DISTANCE = 1000
CHUNK_ROWS = 5000
COLLAPSE_CELL_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
E2G_CLASSES = ["genic", "intergenic"]
TSS_CAP = 2000
CHROMOSOMES = ["chr1", "chr3"]
NMD_LONG_EXON_NT = 400
NMD_START_NT = 150
BUCKETS = 16
SALT_ROWS = 4
SPLIT_BYTES = 128 << 10

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def _fx(spark, sf_dir) -> Fixtures:
    return Fixtures.shared(spark, sf_dir)


def _metadata(fx: Fixtures) -> DataFrame:
    return ops.transcript_metadata(I.gtf_transcript_rows(fx))


def _base(fx: Fixtures) -> DataFrame:
    return ops.base_table(I.vcf_rows(fx, "small"), I.vcf_rows(fx, "sv"), _metadata(fx))


def _config(**kw) -> AnnotationConfig:
    kw.setdefault("distance", ANALYSIS_WINDOW)
    return AnnotationConfig(**kw)


def _inputs(fx: Fixtures, tools=("vep", "nmd", "e2g", "absplice")) -> Inputs:
    return Inputs(
        small=I.vcf_rows(fx, "small"), sv=I.vcf_rows(fx, "sv"),
        gtf_transcripts=I.gtf_transcript_rows(fx), gtf_genes=I.gtf_gene_rows(fx),
        vep=I.vep_rows(fx) if "vep" in tools else None,
        nmd=fx.fx_nmd if "nmd" in tools else None,
        predictions=fx.fx_prediction if "e2g" in tools else None,
        enhancers=fx.fx_enhancer if "e2g" in tools else None,
        splice_scores=fx.fx_splice if "absplice" in tools else None,
    )


def _filtered(fx: Fixtures) -> DataFrame:
    """The funnel's variants with their site columns (from the base table)."""
    return ops.analysis_variants(_base(fx), ANALYSIS_WINDOW)


def _stored_sites(fx: Fixtures) -> DataFrame:
    """The same, stored: a lookup measures, filters by and joins them, and each would
    run the parse of all payloads again."""
    path = work_dir(fx.spark, "sites")
    sinks.write_parquet(_filtered(fx), path, compression="zstd")
    return fx.spark.read.parquet(path)


def _e2g(fx: Fixtures, variants: DataFrame, **kw) -> DataFrame:
    gmap = ops.gene_version_map(I.gtf_gene_rows(fx))
    kw.setdefault("classes", E2G_CLASSES)
    kw.setdefault("stored", variants is fx.fx_variant)
    return ops.enhancer_links(variants, fx.fx_prediction, fx.fx_enhancer, gmap, **kw)


# --- sources -----------------------------------------------------------------

@query
def q_scan_vcf(spark, sf_dir):
    """SRC-1: VCF text (gz, header lines) -> parsed rows."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "vcf")
    sinks.write_vcf(I.vcf_rows(fx), I.VCF_HEADER, path)
    return sources.read_vcf(spark, path)


@query
def q_scan_vcf_blocks(spark, sf_dir):
    """SRC-1: block-gzip VCF, each file read in byte ranges by several tasks."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "bvcf")
    sinks.write_vcf(I.vcf_rows(fx), I.VCF_HEADER, path, compression="blocks", sort=False)
    return sources.read_vcf(spark, path, split_bytes=SPLIT_BYTES)


def _write_gtf(spark, fx) -> str:
    path = work_dir(spark, "gtf")
    gtf = I.gtf_gene_rows(fx).unionByName(I.gtf_transcript_rows(fx))
    sinks.write_text(I.gtf_lines(gtf), I.GTF_HEADER, path)
    return path


_GTF_OUT = ["seqname", "feature", "start", "end", "strand", "attributes"]


@query
def q_scan_gtf_transcripts(spark, sf_dir):
    """SRC-2: GTF text -> transcript rows."""
    path = _write_gtf(spark, _fx(spark, sf_dir))
    return sources.read_gtf(spark, path, "transcript").select(*_GTF_OUT)


@query
def q_scan_gtf_genes(spark, sf_dir):
    """SRC-2: GTF text -> gene rows."""
    path = _write_gtf(spark, _fx(spark, sf_dir))
    return sources.read_gtf(spark, path, "gene").select(*_GTF_OUT)


@query
def q_scan_vep_tab(spark, sf_dir):
    """SRC-3, PRJ-9, PRJ-15: VEP tab text ('##' block, '#Uploaded_variation'
    header, '-' for missing) -> string columns with NULLs."""
    header, lines = I.vep_tab_lines(_fx(spark, sf_dir))
    path = work_dir(spark, "vep")
    sinks.write_text(lines, header, path)
    return sources.read_vep_tab(spark, path)


@query
def q_scan_predictions(spark, sf_dir):
    """SRC-5: a folder of per-chromosome Parquet files read as one table."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "pred")
    known = ["1", "2"]
    for c in known:
        fx.fx_prediction.filter(F.col("chromosome") == c).write.parquet(f"{path}/chr{c}.parquet")
    rest = ~F.coalesce(F.col("chromosome").isin(known), F.lit(False))
    fx.fx_prediction.filter(rest).write.parquet(f"{path}/others.parquet")
    return sources.read_parquet(spark, f"{path}/*.parquet")


@query
def q_scan_score_files(spark, sf_dir):
    """SRC-6, T-17: nested score files whose key columns were written with
    different types (start as bigint in one group, as text in the other)."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "scores")
    s = fx.fx_splice
    s.filter(F.col("chrom") != "chr2").write.parquet(f"{path}/a/genes.parquet")
    (s.filter(F.col("chrom") == "chr2").withColumn("start", F.col("start").cast("string"))
     .write.parquet(f"{path}/b/nested/genes.parquet"))
    return sources.read_score_files(spark, path)


@query
def q_scan_nmd_csv(spark, sf_dir):
    """SRC-8, PRJ-4, PRJ-14, T-22: NMD CSV chunks with differing column sets
    -> (variant_id, transcript, booleans)."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "nmd")
    t = fx.fx_nmd
    (t.filter(F.col("chromosome") != "chr2")
     .write.option("header", "true").csv(f"{path}/chunk_00000.nmd.csv"))
    (t.filter(F.col("chromosome") == "chr2").drop("nmd_last_exon_rule")
     .write.option("header", "true").csv(f"{path}/chunk_00001.nmd.csv"))
    csv = sources.read_nmd_csv(spark, [f"{path}/chunk_00000.nmd.csv",
                                       f"{path}/chunk_00001.nmd.csv"])
    return ops.tidy_nmd(csv)


@query
def q_concat_chunks(spark, sf_dir):
    """SRC-9, SET-2: per-chunk tidy VEP tables (one lacking LoF) as one."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "chunks")
    vep = ops.tidy_vep(I.vep_rows(fx))
    vep.filter(F.col("chrom") != "chr3").write.parquet(f"{path}/chunk_0.parquet")
    vep.filter(F.col("chrom") == "chr3").drop("LoF").write.parquet(f"{path}/chunk_1.parquet")
    out = sources.read_parts(spark, [f"{path}/chunk_0.parquet", f"{path}/chunk_1.parquet"])
    return out.select("variant_id", "Feature", "CADD_PHRED", "SpliceAI_delta_score", "LoF")


# --- projections and the base table ------------------------------------------

@query
def q_csq_explode(spark, sf_dir):
    """GEN-1, FLT-1, FLT-2: one row per CSQ entry with a gene."""
    fx = _fx(spark, sf_dir)
    return ops.explode_csq(I.vcf_rows(fx)).select("variant_id", "gene", "transcript",
                                                  "consequence", "impact")


@query
def q_csq_fields(spark, sf_dir):
    """PRJ-1, PRJ-5, PRJ-15: every kept CSQ field, typed."""
    return ops.explode_csq(I.vcf_rows(_fx(spark, sf_dir)))


@query
def q_variant_type(spark, sf_dir):
    """PRJ-2: SNV / indel by allele length, SV by track."""
    fx = _fx(spark, sf_dir)
    small = I.vcf_rows(fx).select("variant_id", small_variant_type("ref", "alt")
                                  .alias("variant_type"))
    sv = I.vcf_rows(fx, "sv").select("variant_id", F.lit("SV").alias("variant_type"))
    return small.unionByName(sv)


@query
def q_union_tracks(spark, sf_dir):
    """SET-1: small and SV tracks as one exploded table."""
    fx = _fx(spark, sf_dir)
    return ops.union_tracks(I.vcf_rows(fx), I.vcf_rows(fx, "sv")).select(
        "variant_id", "variant_type", "transcript", "consequence")


@query
def q_gtf_attributes(spark, sf_dir):
    """PRJ-6: GTF attribute extraction."""
    return ops.gtf_attributes(I.gtf_transcript_rows(_fx(spark, sf_dir)))


@query
def q_canonical_pick(spark, sf_dir):
    """AGG-3, JN-2, PRJ-16, ORD-1: transcript metadata with canonical flag."""
    return _metadata(_fx(spark, sf_dir))


@query
def q_base_table(spark, sf_dir):
    """JN-1, SET-1: the 27-column base table."""
    return _base(_fx(spark, sf_dir))


@query
def q_base_table_shuffled(spark, sf_dir):
    """JN-1 with the transcript metadata shuffled instead of broadcast."""
    fx = _fx(spark, sf_dir)
    return ops.base_table(I.vcf_rows(fx, "small"), I.vcf_rows(fx, "sv"), _metadata(fx), broadcast_bytes=None)


@query
def q_filter_toggles(spark, sf_dir):
    """FLT-6, FLT-7: protein_coding_only and canonical_only."""
    base = ops.toggle_filter(_base(_fx(spark, sf_dir)), True, True)
    return base.select("variant_id", "transcript", "gene_type", "canonical", "variant_type")


@query
def q_key_split(spark, sf_dir):
    """PRJ-3: chrom_start_ref_alt -> parts."""
    vid = _fx(spark, sf_dir).fx_vep.select(F.col("Uploaded_variation").alias("variant_id")).distinct()
    k = key_parts("variant_id")
    return vid.select("variant_id", *[k[c].alias(c) for c in ("chrom", "start", "ref", "alt")])


@query
def q_key_build(spark, sf_dir):
    """PRJ-4: parts -> chrom_start_ref_alt (NULL if a part is NULL)."""
    t = _fx(spark, sf_dir).fx_nmd
    vid = variant_key("chromosome", F.col("start_variant").try_cast("bigint"), "ref", "alt")
    return t.select(vid.alias("variant_id"), F.col("transcript_id").alias("transcript"))


@query
def q_onehot_vep(spark, sf_dir):
    """PRJ-10: tinyint one-hot, NULL consequence stays NULL."""
    v = I.vep_rows(_fx(spark, sf_dir))
    return v.select(F.col("Uploaded_variation").alias("variant_id"), "Feature",
                    *onehot_columns("Consequence", null_as_zero=False))


@query
def q_onehot_base(spark, sf_dir):
    """PRJ-11: int one-hot on the base consequence, NULL -> 0."""
    b = ops.explode_csq(I.vcf_rows(_fx(spark, sf_dir)))
    return b.select("variant_id", "transcript", *onehot_columns("consequence", null_as_zero=True))


@query
def q_spliceai_delta(spark, sf_dir):
    """PRJ-12: max of the packed SpliceAI delta scores."""
    v = I.vep_rows(_fx(spark, sf_dir))
    return v.select(F.col("Uploaded_variation").alias("variant_id"), "Feature",
                    spliceai_delta(set(v.columns)).alias("SpliceAI_delta_score"))


@query
def q_paren_score(spark, sf_dir):
    """PRJ-13: score inside parentheses."""
    v = I.vep_rows(_fx(spark, sf_dir))
    return v.select(F.col("Uploaded_variation").alias("variant_id"), "Feature",
                    paren_score("SIFT").alias("sift_score"))


@query
def q_vep_tidy(spark, sf_dir):
    """PRJ-3/7/9/10/12/13: the tidy VEP part."""
    return ops.tidy_vep(I.vep_rows(_fx(spark, sf_dir)))


# --- funnel ------------------------------------------------------------------

@query
def q_analysis_set_ids(spark, sf_dir):
    """FLT-4, FLT-5, AGG-4: ids of small variants within the window."""
    return ops.analysis_set(_base(_fx(spark, sf_dir)), ANALYSIS_WINDOW)


@query
def q_filtered_vcf(spark, sf_dir):
    """JN-12, SNK-4, SNK-5: id list written as text, input VCF semi-joined
    with it, exported as gz VCF and read back."""
    fx = _fx(spark, sf_dir)
    ids_path, vcf_path = work_dir(spark, "ids"), work_dir(spark, "fvcf")
    sinks.write_ids(ops.analysis_set(_base(fx), ANALYSIS_WINDOW), ids_path)
    ids = spark.read.text(ids_path).withColumnRenamed("value", "variant_id")
    sinks.write_vcf(ops.filter_variants(I.vcf_rows(fx), ids), I.VCF_HEADER, vcf_path, staged=True)
    return sources.read_vcf(spark, vcf_path)


def _filtered_lines(spark, sf_dir, **toggles):
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "lvcf")
    kept = ops.filter_lines(I.vcf_rows(fx), _metadata(fx), ANALYSIS_WINDOW, **toggles)
    sinks.write_vcf(kept, I.VCF_HEADER, path, sort=False)
    return sources.read_vcf(spark, path)


@query
def q_filtered_vcf_lines(spark, sf_dir):
    """JN-12, SNK-5 with each input line judged by its own payload: none is shuffled."""
    return _filtered_lines(spark, sf_dir)


@query
def q_filtered_vcf_toggles(spark, sf_dir):
    """JN-12, FLT-6, FLT-7: the same with both toggles on."""
    return _filtered_lines(spark, sf_dir, protein_coding_only=True, canonical_only=True)


@query
def q_chrom_subset(spark, sf_dir):
    """FLT-12: chromosome list applied before chunking."""
    return ops.chromosome_subset(_filtered(_fx(spark, sf_dir)), CHROMOSOMES).select(
        "variant_id", "chrom", "start")


@query
def q_chunk_export(spark, sf_dir):
    """SNK-6: standalone VCF chunks (header in each, at most CHUNK_ROWS rows)."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "chunk")
    vcf = ops.filter_variants(I.vcf_rows(fx), ops.analysis_set(_base(fx), ANALYSIS_WINDOW))
    sinks.write_vcf_chunks(vcf, I.VCF_HEADER, path, CHUNK_ROWS, compression="gzip")
    return sources.read_vcf(listing_session(spark), path).select("variant_id", "chrom", "start", "ref", "alt")


@query
def q_chunk_export_exact(spark, sf_dir):
    """SNK-6: chunks of exactly CHUNK_ROWS lines in the order of the (sorted) input."""
    path = work_dir(spark, "chunk")
    lines = sinks.sort_by_position(_filtered(_fx(spark, sf_dir)).withColumn("info", F.lit(".")))
    sinks.write_vcf_chunks(lines, I.VCF_HEADER, path, CHUNK_ROWS)
    chunk = F.regexp_extract(F.col("_metadata.file_path"), r"chunk=(\d+)", 1).cast("long")
    text = listing_session(spark).read.option("recursiveFileLookup", "true").text(path).select("value", chunk.alias("chunk"))
    part = F.split("value", "\t")
    place = F.struct(F.get(part, 0).alias("chrom"), (F.get(part, 1).cast("long") - 1).alias("start"))
    lines = text.filter(~F.col("value").startswith("#")).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min(place).alias("first"), F.max(place).alias("last"))
    return lines.select("chunk", "n_lines", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("first", "last") for c in ("chrom", "start")])


# --- interval join and enhancer links ------------------------------------------

@query
def q_interval_bins(spark, sf_dir):
    """GEN-2: enhancer intervals exploded over 10 kb bins."""
    return ops.interval_bins(_fx(spark, sf_dir).fx_enhancer).select("id", "bin")


@query
def q_interval_overlap(spark, sf_dir):
    """JN-4, FLT-13, PRJ-17: variants inside enhancers (binned join)."""
    fx = _fx(spark, sf_dir)
    v = fx.fx_variant.select("variant_id", F.replace("chrom", F.lit("chr"), F.lit(""))
                             .alias("chrom"), F.col("start").alias("pos"))
    e = fx.fx_enhancer.select(F.col("id").alias("enhancer_id"),
                              F.col("chromosome").alias("chrom"), "start", "end")
    return ops.interval_join(v, e, point_pos="pos").select("variant_id", "enhancer_id")


@query
def q_interval_overlap_nested(spark, sf_dir):
    """JN-4, GEN-2 with intervals from some hundred bases to a whole chromosome."""
    fx = _fx(spark, sf_dir)
    v = fx.fx_variant.select("variant_id", F.replace("chrom", F.lit("chr"), F.lit("")).alias("chrom"), F.col("start").alias("pos"))
    long = F.when(F.col("id") % 40 == 0, F.pow(F.lit(10), F.col("id") / 40 % 9).cast("bigint")).otherwise(0)
    e = fx.fx_enhancer.select(F.col("id").alias("enhancer_id"), F.col("chromosome").alias("chrom"), "start", (F.col("end") + long).alias("end"))
    pairs = ops.interval_join(v, e, point_pos="pos", bin_size=ops.NESTED_BINS)
    return pairs.groupBy("enhancer_id").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"))


@query
def q_collapse_pairs(spark, sf_dir):
    """AGG-1, FLT-8, FLT-10: cell types collapsed per (enhancer, gene)."""
    return ops.collapse_pairs(_fx(spark, sf_dir).fx_prediction, "ENCODE-rE2G", 0.5,
                              COLLAPSE_CELL_TYPES)


@query
def q_pair_intervals(spark, sf_dir):
    """JN-3, FLT-9: pairs joined to their enhancer interval and class."""
    fx = _fx(spark, sf_dir)
    return ops.pair_intervals(ops.collapse_pairs(fx.fx_prediction), fx.fx_enhancer, E2G_CLASSES)


@query
def q_variant_gene_agg(spark, sf_dir):
    """AGG-2: hits collapsed to (variant, gene, name)."""
    fx = _fx(spark, sf_dir)
    pairs = ops.pair_intervals(ops.collapse_pairs(fx.fx_prediction), fx.fx_enhancer, E2G_CLASSES)
    return ops.variant_gene_links(ops.enhancer_hits(fx.fx_variant, pairs, partitions=ops.local_partitions(fx.fx_variant)))


@query
def q_gene_version_map(spark, sf_dir):
    """AGG-6, PRJ-18: one versioned id per unversioned id."""
    return ops.gene_version_map(I.gtf_gene_rows(_fx(spark, sf_dir)))


@query
def q_gene_version_pairs(spark, sf_dir):
    """AGG-5: every distinct (versioned, unversioned) pair."""
    return ops.gene_version_map(I.gtf_gene_rows(_fx(spark, sf_dir)), fan_out=True)


@query
def q_e2g(spark, sf_dir):
    """JN-5, FLT-9, PRJ-19: the E2G part for every variant."""
    fx = _fx(spark, sf_dir)
    return _e2g(fx, fx.fx_variant)


@query
def q_e2g_tss_cap(spark, sf_dir):
    """FLT-11 (+FLT-8): TSS cap and a cell-type list."""
    fx = _fx(spark, sf_dir)
    return _e2g(fx, fx.fx_variant, cell_types=COLLAPSE_CELL_TYPES, distance_to_tss=TSS_CAP)


# --- score lookups -----------------------------------------------------------

@query
def q_splice_lookup(spark, sf_dir):
    """JN-6, JN-7: splice scores for the funnel's variants, gene ids
    versioned with fan-out."""
    fx = _fx(spark, sf_dir)
    pairs = ops.gene_version_map(I.gtf_gene_rows(fx), fan_out=True)
    return ops.splice_lookup(_stored_sites(fx), fx.fx_splice, pairs)


@query
def q_splice_lookup_shuffled(spark, sf_dir):
    """JN-6, JN-7 with every side shuffled (the plan beyond the broadcast bound)."""
    fx = _fx(spark, sf_dir)
    pairs = ops.gene_version_map(I.gtf_gene_rows(fx), fan_out=True)
    return ops.splice_lookup(_stored_sites(fx), fx.fx_splice, pairs, broadcast_bytes=None)


@query
def q_splice_lookup_bucketed(spark, sf_dir):
    """JN-6, JN-7 on a score table bucketed by site: nothing of it is shuffled, at
    any number of sites."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "bucketed")
    sinks.write_bucketed_scores(fx.fx_splice, path, buckets=BUCKETS)
    pairs = ops.gene_version_map(I.gtf_gene_rows(fx), fan_out=True)
    return ops.splice_lookup(_stored_sites(fx), sources.read_bucketed(spark, path), pairs, broadcast_bytes=None)


@query
def q_splice_lookup_filtered(spark, sf_dir):
    """JN-6, JN-7 past the broadcast bound: a Bloom filter of the sites thins out the
    score rows before they are shuffled."""
    fx = _fx(spark, sf_dir)
    pairs = ops.gene_version_map(I.gtf_gene_rows(fx), fan_out=True)
    return ops.splice_lookup(_stored_sites(fx), fx.fx_splice, pairs, broadcast_bytes=0)


def _score_sources(fx, with_cadd=True):
    return {
        "absplice": (fx.fx_splice, ["AbSplice_DNA_max", "AbSplice2_max"]),
        "cadd": (fx.fx_cadd, ["CADD_PHRED", "CADD_raw"]) if with_cadd else None,
    }


@query
def q_score_lookup(spark, sf_dir):
    """RE-2: every configured site-score table left-joined."""
    fx = _fx(spark, sf_dir)
    return ops.lookup_scores(fx.fx_variant, _score_sources(fx))


@query
def q_score_lookup_shuffled(spark, sf_dir):
    """RE-2 with the sites shuffled instead of broadcast."""
    fx = _fx(spark, sf_dir)
    return ops.lookup_scores(fx.fx_variant, _score_sources(fx), broadcast_bytes=None)


@query
def q_score_lookup_bucketed(spark, sf_dir):
    """RE-2 on bucketed score tables: the variants are dealt once for all of them."""
    fx = _fx(spark, sf_dir)
    found = {}
    for name, (scores, columns) in _score_sources(fx).items():
        path = work_dir(spark, f"bucketed-{name}")
        sinks.write_bucketed_scores(scores, path, buckets=BUCKETS)
        found[name] = (sources.read_bucketed(spark, path), columns)
    return ops.lookup_scores(fx.fx_variant, found, broadcast_bytes=None)


@query
def q_score_lookup_filtered(spark, sf_dir):
    """RE-2 past the broadcast bound: one Bloom filter of the sites for all sources."""
    fx = _fx(spark, sf_dir)
    return ops.lookup_scores(fx.fx_variant, _score_sources(fx), broadcast_bytes=0)


@query
def q_compacted_scores_lookup(spark, sf_dir):
    """SRC-6, RE-2: score files compacted by chromosome, read back and looked up
    with their chromosomes pruned."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "compact")
    sinks.compact_scores(fx.fx_splice, path)
    scores = sources.read_score_files(spark, path)
    return ops.lookup_scores(fx.fx_variant, {
        "absplice": (scores, ["AbSplice_DNA_max", "AbSplice2_max"]),
        "cadd": (fx.fx_cadd, ["CADD_PHRED", "CADD_raw"])}, prune=True)


@query
def q_score_lookup_missing(spark, sf_dir):
    """RE-2: an unconfigured source is skipped."""
    fx = _fx(spark, sf_dir)
    return ops.lookup_scores(fx.fx_variant, _score_sources(fx, with_cadd=False))


# --- combine and the annotation table ----------------------------------------

def _combine(spark, sf_dir, tools, make=annotation_table, **toggles):
    fx = _fx(spark, sf_dir)
    e2g = E2GConfig(classes=E2G_CLASSES) if "e2g" in tools else None
    return make(_inputs(fx, tools), _config(e2g=e2g, **toggles))


def _write_combined(spark, sf_dir, tools, path, **toggles):
    with _combine(spark, sf_dir, tools, annotation_passes, **toggles) as frames:
        sinks.write_annotations(frames, path)


@query
def q_combine_none(spark, sf_dir):
    """JN-13 with no tool: the base with one-hots."""
    return _combine(spark, sf_dir, ())


@query
def q_combine_vep(spark, sf_dir):
    """JN-8, PRJ-8."""
    return _combine(spark, sf_dir, ("vep",))


@query
def q_combine_nmd(spark, sf_dir):
    """JN-9."""
    return _combine(spark, sf_dir, ("nmd",))


@query
def q_combine_e2g(spark, sf_dir):
    """JN-10, PRJ-8 (e2g_ prefix)."""
    return _combine(spark, sf_dir, ("e2g",))


@query
def q_combine_splice(spark, sf_dir):
    """JN-11."""
    return _combine(spark, sf_dir, ("absplice",))


@query
def q_combine_all(spark, sf_dir):
    """JN-13: every tool, both toggles on (the template configuration)."""
    return _combine(spark, sf_dir, ("vep", "nmd", "e2g", "absplice"),
                    protein_coding_only=True, canonical_only=True)


@query
def q_combine_all_salted(spark, sf_dir):
    """JN-13 with the variants of more than SALT_ROWS rows salted."""
    return _combine(spark, sf_dir, ("vep", "nmd", "e2g", "absplice"), protein_coding_only=True, canonical_only=True,
                    rows_per_salt=SALT_ROWS)


_ANN_KEYS = ["variant_id", "transcript", "variant_type", "gene_type", "canonical"]


@query
def q_read_annotations(spark, sf_dir):
    """SNK-2, SRC-7, T-9: hive-partitioned write, typed read-back."""
    path = work_dir(spark, "ann")
    _write_combined(spark, sf_dir, ("vep", "e2g"), path)
    return sources.read_annotations(spark, path)


@query
def q_overwrite_drops_stale(spark, sf_dir):
    """SNK-3: a rebuild with canonical_only leaves no canonical=false files."""
    path = work_dir(spark, "ann")
    _write_combined(spark, sf_dir, (), path)
    _write_combined(spark, sf_dir, (), path, canonical_only=True)
    return sources.read_annotations(spark, path).select(*_ANN_KEYS)


@query
def q_sorted_gtf(spark, sf_dir):
    """SNK-7, ORD-2: GTF sorted by (chrom, start), comments first."""
    fx = _fx(spark, sf_dir)
    path = work_dir(spark, "sgtf")
    gtf = I.gtf_gene_rows(fx).unionByName(I.gtf_transcript_rows(fx))
    sinks.sort_annotation(gtf, I.GTF_HEADER, path)
    return sources.read_gtf(spark, path).select(*_GTF_OUT)


@query
def q_run_metrics(spark, sf_dir):
    """SNK-8, AGG-7: counts, distinct counts and flag counts."""
    base = _base(_fx(spark, sf_dir))
    return sinks.run_metrics(base, distinct=["variant_id", "transcript", "gene"],
                             flags=["canonical"])


@query
def q_merged_metrics(spark, sf_dir):
    """SNK-8, AGG-7: distinct counts of a table written in two parts, from the sketches
    stored beside them; the exact counts for comparison, and whether each estimate is
    within three standard errors."""
    base, columns = _base(_fx(spark, sf_dir)), ["variant_id", "transcript", "gene"]
    paths = []
    for k, rows in enumerate((base.filter("start % 3 > 0"), base.filter("start % 3 = 0"))):
        paths.append(work_dir(spark, f"part{k}"))
        found = sinks.write_parquet(rows, paths[-1], metrics=sinks.sketches(columns), compression="zstd")
        sinks.store_metrics(spark, paths[-1], found, columns)
    merged = sinks.merged_metrics(spark, paths)
    exact = sinks.distinct_counts(spark.read.parquet(*paths), columns)
    known = spark.createDataFrame(list(exact.items()), "column string, n_distinct long")
    off = F.abs(F.col("distinct_estimate") - F.col("n_distinct")) / F.col("n_distinct")
    return (merged.join(F.broadcast(known), "column")
            .select("column", "rows", "n_distinct", (off <= 3 * 1.04 / 2 ** (sinks.metrics.LOG_SIZE / 2)).alias("within_error")))


# --- re-aimed external annotators --------------------------------------------

@query
def q_near_gene(spark, sf_dir):
    """RE-1: (variant, transcript) pairs within NEAR_GENE_DISTANCE."""
    fx = _fx(spark, sf_dir)
    return ops.near_gene(fx.fx_variant, I.transcripts(fx), I.exons(fx), NEAR_GENE_DISTANCE)


@query
def q_near_gene_shuffled(spark, sf_dir):
    """RE-1 with the binned transcripts shuffled instead of broadcast."""
    fx = _fx(spark, sf_dir)
    return ops.near_gene(fx.fx_variant, I.transcripts(fx), I.exons(fx), NEAR_GENE_DISTANCE, broadcast_bytes=None)


@query
def q_nmd_rules(spark, sf_dir):
    """RE-3: escape rules for stop_gained positions inside exons."""
    fx = _fx(spark, sf_dir)
    stops = (ops.explode_csq(I.vcf_rows(fx))
             .filter(F.col("consequence") == "stop_gained")
             .select("variant_id", F.col("transcript").alias("transcript_id"), "chrom",
                     F.col("start").alias("pos")))
    strands = fx.fx_transcript.select("transcript_id", "strand")
    return ops.nmd_rules(stops, I.exons(fx), strands, long_exon_nt=NMD_LONG_EXON_NT,
                         start_nt=NMD_START_NT)


def _gene_model(spark, fx) -> DataFrame:
    """Transcripts and exons as GTF text, read back."""
    path = work_dir(spark, "gtf")
    sinks.write_text(I.gtf_lines(I.gtf_transcript_rows(fx).unionByName(I.gtf_exon_rows(fx))), I.GTF_HEADER, path)
    return sources.read_gtf(spark, path)


@query
def q_gtf_near_gene(spark, sf_dir):
    """RE-1 with transcripts and exons derived from GTF text."""
    fx = _fx(spark, sf_dir)
    gtf = _gene_model(spark, fx)
    return ops.near_gene(fx.fx_variant, ops.transcripts_from_gtf(gtf), ops.exons_from_gtf(gtf), NEAR_GENE_DISTANCE)


@query
def q_gtf_nmd_rules(spark, sf_dir):
    """RE-3 with exons and strands derived from GTF text."""
    fx = _fx(spark, sf_dir)
    gtf = _gene_model(spark, fx)
    stops = (ops.explode_csq(I.vcf_rows(fx)).filter(F.col("consequence") == "stop_gained")
             .select("variant_id", F.col("transcript").alias("transcript_id"), "chrom", F.col("start").alias("pos")))
    return ops.nmd_rules(stops, ops.exons_from_gtf(gtf), ops.transcripts_from_gtf(gtf).select("transcript_id", "strand"),
                         long_exon_nt=NMD_LONG_EXON_NT, start_nt=NMD_START_NT)


# --- the whole run from files ------------------------------------------------

@query
def q_annotate(spark, sf_dir):
    """The full file-to-file run: every input written as the tools deliver
    it (gz VCF/GTF text, chunked VEP tab and NMD CSV, prediction folder,
    nested score files), ``annotate`` (base persisted once, funnel, all
    parts, combine with both toggles, hive write), then the typed read-back."""
    cfg = I.write_input_files(_fx(spark, sf_dir), work_dir(spark, "run"),
                              distance=ANALYSIS_WINDOW, protein_coding_only=True,
                              canonical_only=True, e2g=E2GConfig(classes=E2G_CLASSES))
    annotate(spark, cfg)
    return sources.read_annotations(spark, f"{cfg.output_dir}/annotations.parquet")


@query
def q_annotate_metrics(spark, sf_dir):
    """SNK-1, SNK-8: the counts of the same run, which are of its stored tables."""
    cfg = I.write_input_files(_fx(spark, sf_dir), work_dir(spark, "run"),
                              distance=ANALYSIS_WINDOW, protein_coding_only=True,
                              canonical_only=True, e2g=E2GConfig(classes=E2G_CLASSES))
    found = annotate(spark, cfg)
    names = ["transcript_rows", "transcript_canonical", "transcript_mane", "transcript_symbol", "gene_rows", "base_rows",
             "base_canonical_rows", "filtered_rows", "vep_rows", "vep_variants", "nmd_rows", "nmd_variants", "e2g_rows",
             "e2g_variants", "e2g_genes", "absplice_rows", "absplice_variants", "rows"]
    for n in ("base", "filtered", "vep", "nmd", "e2g", "absplice"):
        found[f"stored_{n}"] = spark.read.parquet(f"{cfg.output_dir}/parts/{n}.parquet").count()
        names.append(f"stored_{n}")
    return spark.createDataFrame([[found[n] for n in names]], ", ".join(f"{n} long" for n in names))


@query
def q_annotate_scores(spark, sf_dir):
    """RE-2 in the annotation table: site scores of the funnel's variants."""
    fx = _fx(spark, sf_dir)
    inp = _inputs(fx, ())
    inp.scores = {"cadd": (fx.fx_cadd, ["CADD_PHRED", "CADD_raw"])}
    return annotation_table(inp, _config())
