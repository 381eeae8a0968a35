"""End-to-end assembly: config -> base table -> funnel -> tool parts ->
combined, hive-partitioned annotation table.

``annotation_table`` is pure DataFrame composition (used by the registered
queries on fixtures); ``annotate`` adds the file I/O of a real run: text
inputs in, the base table persisted once (it feeds both the funnel and the
combine, so the CSQ explode runs once), annotations out.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vartab import operators as ops
from vartab import sinks, sources
from vartab.session import drop_path, grow_partitions, measured_session, planned_bytes, shuffles_dropped, work_dir

SITE_TYPES = {"chrom": "string", "start": "bigint", "ref": "string", "alt": "string"}

TOOLS = ("vep", "nmd", "e2g", "absplice")


@dataclass
class E2GConfig:
    predictions: str | None = None
    enhancers: str | None = None
    model: str = "ENCODE-rE2G"
    score_threshold: float = 0.5
    classes: list[str] | None = field(default_factory=lambda: ["genic", "intergenic"])
    cell_types: list[str] | None = None
    distance_to_tss: int | None = None
    bin_size: int = 10_000


@dataclass
class ScoreTable:
    """A site-score table (chrom, start, ref, alt and score columns)."""
    path: str
    columns: list[str]


@dataclass
class AnnotationConfig:
    input_vcf: str | None = None
    gtf: str | None = None
    output_dir: str | None = None
    sv_vcf: str | None = None
    distance: int = 5000
    protein_coding_only: bool = False
    canonical_only: bool = False
    include_sv: bool = True
    chromosomes: list[str] | None = None
    variants_per_chunk: int = 500_000
    vep_tab: str | list[str] | None = None
    nmd_csv: str | list[str] | None = None
    e2g: E2GConfig | None = None
    absplice_result: str | None = None
    score_tables: dict[str, ScoreTable] | None = None
    input_partitions: int | None = None
    export_funnel: bool = False
    strip_chr: bool = False
    rows_per_salt: int = ops.heavy.ROWS_PER_SALT

    def validate(self, files: bool = False) -> None:
        """``files``: also what a run from files needs."""
        if files:
            missing = [n for n in ("input_vcf", "gtf", "output_dir") if not getattr(self, n)]
            if self.e2g is not None:
                missing += [f"e2g.{n}" for n in ("predictions", "enhancers") if not getattr(self.e2g, n)]
            if missing:
                raise ValueError(f"missing configuration: {', '.join(missing)}")
        if self.distance < 0:
            raise ValueError("distance must be >= 0")
        if self.variants_per_chunk <= 0:
            raise ValueError("variants_per_chunk must be > 0")


@dataclass
class Inputs:
    """DataFrame inputs of one run; None = source not configured."""
    small: DataFrame
    gtf_transcripts: DataFrame
    gtf_genes: DataFrame
    sv: DataFrame | None = None
    vep: DataFrame | None = None          # parsed VEP tab rows
    nmd: DataFrame | None = None          # NMD CSV rows (text)
    predictions: DataFrame | None = None
    enhancers: DataFrame | None = None
    splice_scores: DataFrame | sources.BucketedScores | None = None
    scores: dict[str, tuple[DataFrame | sources.BucketedScores, list[str]]] | None = None


def funnel(base: DataFrame, cfg: AnnotationConfig) -> DataFrame:
    """Small variants that the annotators should see: the analysis set with
    its site columns. (The chromosome subset only restricts the chunks
    exported for external tools, see ``export_funnel``.)"""
    return ops.analysis_variants(base, cfg.distance, cfg.protein_coding_only,
                                 cfg.canonical_only)


def export_funnel(spark: SparkSession, small: DataFrame, base: DataFrame, meta: DataFrame,
                  cfg: AnnotationConfig, header: list[str]) -> dict:
    """The funnel's file outputs for external annotators: the id list, the
    filtered input VCF (the input lines of the analysis set, verbatim, each told by
    its own payload and so never shuffled before the sort, under the input's own
    header), and that VCF restricted to ``chromosomes`` as standalone VCF chunks
    (header in each) of ``variants_per_chunk`` rows."""
    out = cfg.output_dir.rstrip("/")
    paths = {"ids": f"{out}/funnel/small.ids", "vcf": f"{out}/funnel/small.vcf",
             "chunks": f"{out}/funnel/chunks"}
    ids = ops.analysis_set(base, cfg.distance, cfg.protein_coding_only, cfg.canonical_only)
    counts = {"ids": sinks.write_ids(ids, paths["ids"])["rows"]}
    filtered = ops.filter_lines(small, meta, cfg.distance, cfg.protein_coding_only, cfg.canonical_only)
    counts["vcf"] = sinks.write_vcf(filtered, header, paths["vcf"])["rows"]
    chunked = ops.chromosome_subset(sources.read_vcf(spark, paths["vcf"], keep_line=True),
                                    cfg.chromosomes)
    counts["chunks"] = sinks.write_vcf_chunks(chunked, header, paths["chunks"],
                                              cfg.variants_per_chunk)["rows"]
    return {"paths": paths, "rows": counts}


def tool_parts(inp: Inputs, filtered: DataFrame, cfg: AnnotationConfig, prune: bool = False,
               by_variant: bool = False, stored: bool = False) -> dict[str, DataFrame]:
    """``prune``: ``filtered`` is stored, so the score tables' chromosomes may be
    taken from it, and the links be grouped where they are made (``stored``: only the latter).
    ``by_variant``: the links are dealt as ``combine`` joins them."""
    parts: dict[str, DataFrame] = {}
    if inp.vep is not None:
        parts["vep"] = ops.tidy_vep(inp.vep)
    if inp.nmd is not None:
        parts["nmd"] = ops.tidy_nmd(inp.nmd)
    if cfg.e2g is not None and inp.predictions is not None and inp.enhancers is not None:
        e = cfg.e2g
        gmap = ops.gene_version_map(inp.gtf_genes, fan_out=False)
        parts["e2g"] = ops.enhancer_links(
            filtered, inp.predictions, inp.enhancers, gmap, model=e.model,
            score_threshold=e.score_threshold, classes=e.classes, cell_types=e.cell_types,
            distance_to_tss=e.distance_to_tss, bin_size=e.bin_size, by_variant=by_variant, stored=prune or stored)
    if inp.splice_scores is not None:
        pairs = ops.gene_version_map(inp.gtf_genes, fan_out=True)
        parts["absplice"] = ops.splice_lookup(filtered, inp.splice_scores, pairs, cfg.strip_chr, prune=prune)
    if inp.scores:
        parts["scores"] = ops.lookup_scores(filtered, inp.scores, cfg.strip_chr, prune=prune)
    return parts


def base_counts() -> dict:
    """What is observed of the base table while it is written: single numbers, as each
    task sends its own to the driver (of a sketch, some 250 kB)."""
    return {"canonical_rows": F.count_if("canonical"),
            "unnamed_rows": F.count_if(F.col("variant_id").isNull() | (F.col("variant_id") == "."))}


# Packed bytes of the stored base that are joined in one pass, and the most passes (each
# scans the base once more). The shuffle of a row takes some seven times its packed bytes,
# so that of all rows at once would be the most that a run has on disk.
PASS_BYTES, MOST_PASSES = 32 << 20, 4


def _passes(base: DataFrame, cfg: AnnotationConfig) -> int:
    """As many as the rows that pass the toggles need (counted: a scan of two columns)."""
    size = planned_bytes(base)
    if size > PASS_BYTES and (cfg.protein_coding_only or cfg.canonical_only):
        with shuffles_dropped(base.sparkSession):
            kept = ops.toggle_filter(base, cfg.protein_coding_only, cfg.canonical_only).count()
            size = size * kept // max(1, base.count())
    return max(1, min(MOST_PASSES, -(-size // PASS_BYTES)))


def _share(df: DataFrame, k: int, n: int) -> DataFrame:
    """The rows of the k-th of n passes: an id has all its rows in one of them."""
    return df if n == 1 else df.filter(F.pmod(F.xxhash64("variant_id"), F.lit(n)) == k)


def _combined(base: DataFrame, parts: dict[str, DataFrame], cfg: AnnotationConfig, n: int, copartition: bool,
              heavy: DataFrame | None, dealt=()) -> list[DataFrame]:
    def one(k: int) -> DataFrame:
        vep, nmd, e2g, splice, scores = (_share(parts[p], k, n) if p in parts else None for p in (*TOOLS, "scores"))
        return ops.combine(_share(base, k, n), vep, nmd, e2g, splice, scores, protein_coding_only=cfg.protein_coding_only,
                           canonical_only=cfg.canonical_only, copartition=copartition, heavy=heavy, dealt=dealt)
    return [one(k) for k in range(n)]


def _frames(inp: Inputs, cfg: AnnotationConfig, base: DataFrame | None = None, parts: dict[str, DataFrame] | None = None,
            copartition: bool = False, heavy: DataFrame | None = None, joined: bool = False) -> tuple[list[DataFrame], list[str]]:
    """The combined table as the frames of its passes, and the work folders they read.
    ``joined``: no passes without a part to join, as nothing is shuffled then."""
    cfg.validate()
    made: list[str] = []

    def stored(df: DataFrame, label: str, spark: SparkSession | None = None) -> DataFrame:
        made.append(work_dir(df.sparkSession, label))
        sinks.write_parquet(df, made[-1], compression="zstd")
        return (spark or df.sparkSession).read.parquet(made[-1])

    if base is None:
        meta = ops.transcript_metadata(inp.gtf_transcripts)
        base = ops.base_table(inp.small, inp.sv if cfg.include_sv else None, meta)
        spark = ops.copartition_session(base.sparkSession)
        base = stored(base, "base", spark)
        copartition, heavy = True, ops.heavy_ids(spark, ops.stored_frequent_ids(base), cfg.rows_per_salt)
    n, dealt = (_passes(base, cfg) if copartition else 1), ()
    if parts is None:
        filtered, linked = funnel(base, cfg), cfg.e2g is not None and inp.predictions is not None and inp.enhancers is not None
        if inp.splice_scores is not None or inp.scores or (linked and n > 1):
            # measured, filtered by and joined: stored, so that the base is read once for it
            filtered = stored(filtered, "sites")
        # heavy ids are salted after the links are made, so these are spread by gene too
        dealt = ("e2g",) if copartition is True and heavy is None and n == 1 else ()
        parts = tool_parts(inp, filtered, cfg, by_variant=bool(dealt), stored=linked and n > 1)
        if n > 1:  # what each pass would join anew, and its shuffles
            parts |= {p: stored(parts[p], p) for p in ("e2g", "absplice", "scores") if p in parts}
    return _combined(base, parts, cfg, n if parts or not joined else 1, copartition, heavy, dealt), made


@contextmanager
def annotation_passes(inp: Inputs, cfg: AnnotationConfig) -> Iterator[list[DataFrame]]:
    """The combined table as frames to be written one after another
    (``sinks.write_annotations``): each holds all rows of its share of the variant ids. What
    they read is deleted in the end."""
    frames, made = _frames(inp, cfg)
    yield frames
    for path in made:
        drop_path(frames[0].sparkSession, path)


def annotation_table(inp: Inputs, cfg: AnnotationConfig, base: DataFrame | None = None,
                     parts: dict[str, DataFrame] | None = None, copartition: bool = False,
                     heavy: DataFrame | None = None) -> DataFrame:
    """The combined table.

    The base table feeds both the funnel and the combine. When it is not
    given (already stored), it is built and written once as Parquet under
    the shared checkpoint directory, so the CSQ parse and explode run once,
    and what reads it scans only the columns and rows it needs. It is read in a
    session beside the caller's, whose joins may deal it by variant id alone
    (``copartition_session``); ids with very many rows, found in it once it is
    written, are salted. A base of more than ``PASS_BYTES`` is joined in passes, each over
    a share of the variant ids, and the combined rows are stored: the shuffle of a pass is
    gone before the next, and the base is deleted once it is joined.
    """
    frames, made = _frames(inp, cfg, base, parts, copartition, heavy, joined=True)
    if len(frames) == 1:
        return frames[0]
    spark, path = frames[0].sparkSession, work_dir(frames[0].sparkSession, "combined")
    for frame in frames:
        sinks.write_parquet(frame, path, mode="append", compression="zstd")
    for part in made:
        drop_path(spark, part)
    return spark.read.schema(frames[0].schema).parquet(path)


def _score_table(spark: SparkSession, path: str, types: dict[str, str] | None = None):
    """A bucketed table as such, anything else as a folder of score files."""
    if sources.is_bucketed(spark, path):
        return sources.read_bucketed(spark, path)
    return sources.read_score_files(spark, path, types)


def read_inputs(spark: SparkSession, cfg: AnnotationConfig) -> Inputs:
    n = cfg.input_partitions
    e2g = cfg.e2g
    return Inputs(
        small=sources.read_vcf(spark, cfg.input_vcf, n, keep_line=cfg.export_funnel),
        sv=sources.read_vcf(spark, cfg.sv_vcf, n) if cfg.sv_vcf and cfg.include_sv else None,
        gtf_transcripts=sources.read_gtf(spark, cfg.gtf, "transcript"),
        gtf_genes=sources.read_gtf(spark, cfg.gtf, "gene"),
        vep=sources.read_vep_tab(spark, cfg.vep_tab, n) if cfg.vep_tab else None,
        nmd=sources.read_nmd_csv(spark, cfg.nmd_csv) if cfg.nmd_csv else None,
        predictions=sources.read_parquet(spark, e2g.predictions) if e2g else None,
        enhancers=sources.read_parquet(spark, e2g.enhancers) if e2g else None,
        splice_scores=_score_table(spark, cfg.absplice_result) if cfg.absplice_result else None,
        scores={n: (_score_table(spark, t.path, SITE_TYPES), t.columns)
                for n, t in (cfg.score_tables or {}).items()} or None,
    )


# What is counted of each stored part: distinct values of these columns.
PART_COUNTS = {"vep": ["variant_id"], "nmd": ["variant_id"], "e2g": ["variant_id", "target_gene_id"],
               "absplice": ["variant_id"], "scores": []}


def annotate(spark: SparkSession, cfg: AnnotationConfig) -> dict:
    """A full run. Writes, under ``output_dir``, every table that more than
    one step reads or that a rerun could start from: the transcript and gene
    tables, ``parts/base``, ``parts/filtered`` (the funnel's sites), one part
    per tool, and the hive-partitioned ``annotations`` (plus the funnel
    exports when ``export_funnel``). Returns run metrics: counts observed
    during each write and, of the stored tables, distinct variants and genes (a scan of
    one column each; ``base_variants`` approximately, by HyperLogLog)."""
    cfg.validate(files=True)
    spark = measured_session(spark)
    out = cfg.output_dir.rstrip("/")
    texts = [spark.read.text(p) for p in (cfg.input_vcf, cfg.vep_tab, cfg.nmd_csv) if p]
    grow_partitions(spark, planned_bytes(*texts))
    inp = read_inputs(spark, cfg)
    metrics: dict = {}

    def keep(df: DataFrame, name: str, label: str, more=None) -> DataFrame:
        found = sinks.write_parquet(df, f"{out}/{name}.parquet", metrics=more, compression="zstd")
        metrics.update({f"{label}_{k}": v for k, v in found.items()})
        return spark.read.schema(df.schema).parquet(f"{out}/{name}.parquet")

    meta = keep(ops.transcript_metadata(inp.gtf_transcripts), "transcript_metadata", "transcript", {
        "canonical": F.count_if("canonical"), "mane": F.count_if("mane_select"), "symbol": F.count("symbol")})
    inp.gtf_genes = keep(inp.gtf_genes.select("attributes"), "genes", "gene")
    base = keep(ops.base_table(inp.small, inp.sv, meta), "parts/base", "base", base_counts())
    with shuffles_dropped(spark):
        metrics["base_variants"] = base.agg(F.approx_count_distinct("variant_id", 0.01)).first()[0]
    beside = ops.copartition_session(spark)
    heavy = ops.heavy_ids(beside, ops.stored_frequent_ids(base), cfg.rows_per_salt)
    if cfg.export_funnel:
        header = sources.read_vcf_header(spark, cfg.input_vcf) or VCF_HEADER
        metrics["funnel"] = export_funnel(spark, inp.small, base, meta, cfg, header)
    filtered = keep(funnel(base, cfg), "parts/filtered", "filtered")
    parts = {}
    for name, part in tool_parts(inp, filtered, cfg, prune=True).items():
        parts[name] = keep(part, f"parts/{name}", name)
        counts = sinks.distinct_counts(parts[name], PART_COUNTS[name])
        metrics.update({f"{name}_{'genes' if 'gene' in c else 'variants'}": n for c, n in counts.items()})
    frames, _ = _frames(inp, cfg, beside.read.schema(base.schema).parquet(f"{out}/parts/base.parquet"), parts, True, heavy)
    metrics["rows"] = sinks.write_annotations(frames, f"{out}/annotations.parquet")["rows"]
    return metrics


VCF_HEADER = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
