"""DuckDB oracle SQL for every registered query.

Each oracle is an independent SQL formulation of the operator's definition
(plain range joins instead of binning, window ``row_number`` instead of a
grouped min, ...), run on the same fixtures. ``build`` puts the fixture
views and the stage CTEs (prefix ``st_``) the query needs in front of the
final SELECT, in dependency order, so each oracle is one statement over
the driver's pre-registered tables.
"""

from __future__ import annotations

import re

from vartab.functions.consequences import CONSEQUENCE_TERMS
from vartab.plans import queries as Q
from vartab.plans.fixtures import FIXTURE_SQL, duckdb_cte

_REF = re.compile(r"\b(fx_\w+|st_\w+)\b")
STAGES: dict[str, str] = {}


def build(final: str, extra: dict[str, str] | None = None) -> str:
    ctes = {**STAGES, **(extra or {})}
    order: list[str] = []

    def body(name):
        return ctes[name] if name in ctes else duckdb_cte(name)

    def visit(name):
        if name in order:
            return
        if name not in ctes and name not in FIXTURE_SQL:
            raise KeyError(f"unknown CTE {name}")
        for dep in _REF.findall(body(name)):
            if dep != name:
                visit(dep)
        order.append(name)

    for n in _REF.findall(final):
        visit(n)
    if not order:
        return final.strip()
    return "with " + ",\n".join(f"{n} as (\n{body(n).strip()}\n)" for n in order) + "\n" + final.strip()


def _in(vals):
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in vals) + ")"


def _nullish(c):
    return f"case when {c} in ('-', '') then null else {c} end as {c}"


ONEHOT_INT = ", ".join(f"case when contains(b.consequence, '{t}') then 1 else 0 end "
                       f'as "Consequence_{t}"' for t in CONSEQUENCE_TERMS)


def _onehot_tiny(col):
    return ", ".join(f'cast(contains({col}, \'{t}\') as tinyint) as "Consequence_{t}"'
                     for t in CONSEQUENCE_TERMS)


# --- base table ----------------------------------------------------------------
STAGES["st_vcf"] = "select variant_id, chrom, pos - 1 as start, ref, alt, info from fx_csq"
STAGES["st_sv_vcf"] = "select variant_id, chrom, pos - 1 as start, ref, alt, info from fx_sv_csq"
STAGES["st_entries"] = r"""
select v.variant_id, v.chrom, v.start, v.ref, v.alt, v.track, e.entry
from (select *, 'small' as track from st_vcf union all select *, 'sv' as track from st_sv_vcf) v,
     unnest(string_split(regexp_extract(v.info, 'CSQ=([^;]*)', 1), ',')) as e(entry)
where regexp_extract(v.info, 'CSQ=([^;]*)', 1) <> ''
"""
# Fixture entries always carry all 33 fields (FIXTURES.md), so split_part,
# which gives '' for a missing field, reads them the same as list indexing.
_PART = "split_part(entry, '|', {})"
_TEXT = {"exon": 9, "intron": 10, "hgvsc": 11, "hgvsp": 12, "cdna_position": 13,
         "cds_position": 14, "protein_position": 15, "amino_acids": 16, "codons": 17,
         "ensp": 33}
STAGES["st_ann"] = (
    "select variant_id, chrom, start, ref, alt, "
    "if(track = 'sv', 'SV', if(length(ref) = 1 and length(alt) = 1, 'SNV', 'indel')) as variant_type, "
    + ", ".join(f"{_PART.format(i)} as {n}" for n, i in
                [("gene", 5), ("transcript", 7), ("consequence", 2), ("impact", 3)])
    + ", try_cast(nullif(" + _PART.format(21) + ", '') as integer) as distance, "
    + ", ".join(f"nullif({_PART.format(i)}, '') as {n}" for n, i in _TEXT.items())
    + ", try_cast(nullif(" + _PART.format(22) + ", '') as integer) as strand, track "
    "from st_entries where " + _PART.format(5) + " <> '-'"
)
ANN_COLS = ("variant_id, chrom, start, ref, alt, variant_type, gene, transcript, consequence, impact, "
            "distance, exon, intron, hgvsc, hgvsp, cdna_position, cds_position, protein_position, "
            "amino_acids, codons, strand, ensp")
STAGES["st_gtf_tx"] = """
select chrom as seqname, 'transcript' as feature, tx_start + 1 as start, tx_end as "end",
       case when strand = 1 then '+' else '-' end as strand, attr as attributes
from fx_transcript
"""
STAGES["st_gtf_gene"] = """
select l.chrom as seqname, 'gene' as feature, g.gene_start + 1 as start, g.gene_end as "end",
       case when g.strand = 1 then '+' else '-' end as strand,
       'gene_id "' || l.gene_id || '";' as attributes
from fx_gene_line l join fx_gene g on l.gene_unversioned = g.gene_unversioned
"""
STAGES["st_attrs"] = """
select nullif(regexp_extract(attributes, 'transcript_id "([^"]+)"', 1), '') as transcript_id,
       nullif(regexp_extract(attributes, 'gene_id "([^"]+)"', 1), '') as gene_id,
       nullif(regexp_extract(attributes, 'gene_name "([^"]+)"', 1), '') as symbol,
       nullif(regexp_extract(attributes, 'gene_type "([^"]+)"', 1), '') as gene_type,
       nullif(regexp_extract(attributes, 'transcript_type "([^"]+)"', 1), '') as biotype,
       nullif(regexp_extract(attributes, 'transcript_support_level "([^"]+)"', 1), '') as tsl,
       nullif(regexp_extract(attributes, 'tag "(appris_[a-z0-9_]+)"', 1), '') as appris,
       contains(attributes, 'tag "MANE_Select"') as mane_select,
       contains(attributes, 'tag "basic"') as basic,
       contains(attributes, 'tag "CCDS"') as ccds
from st_gtf_tx
"""
STAGES["st_attrs2"] = """
select *, cast(nullif(regexp_extract(appris, 'appris_principal_([0-9])', 1), '') as tinyint) as principal
from st_attrs
"""
STAGES["st_canon"] = """
select gene_id, transcript_id as canonical_tx from (
  select gene_id, transcript_id,
         row_number() over (partition by gene_id
                            order by case when mane_select then 0 else principal end, transcript_id) as rn
  from st_attrs2 where mane_select or principal is not null) r
where rn = 1
"""
STAGES["st_meta"] = """
select a.transcript_id, a.gene_id, a.symbol, a.gene_type, a.biotype,
       try_cast(case when a.tsl = 'NA' then null else a.tsl end as tinyint) as tsl,
       a.appris, a.mane_select, a.basic, a.ccds, a.principal,
       coalesce(a.transcript_id = c.canonical_tx, false) as canonical
from st_attrs2 a left join st_canon c on a.gene_id = c.gene_id
"""
STAGES["st_base"] = """
select a.variant_id, a.chrom, a.start, a.ref, a.alt, a.variant_type, a.gene, m.symbol, a.transcript,
       m.gene_type, m.biotype, m.canonical, m.tsl, a.consequence, a.impact, a.distance, a.exon, a.intron,
       a.hgvsc, a.hgvsp, a.ensp, a.cdna_position, a.cds_position, a.protein_position, a.amino_acids,
       a.codons, a.strand
from st_ann a left join st_meta m on a.transcript = m.transcript_id
"""


def _ids(name, pc=False, canon=False):
    cond = [f"(distance is null or distance <= {Q.ANALYSIS_WINDOW})", "variant_type in ('SNV', 'indel')"]
    if pc:
        cond.append("gene_type = 'protein_coding'")
    if canon:
        cond.append("canonical")
    STAGES[f"st_ids{name}"] = "select distinct variant_id from st_base where " + " and ".join(cond)
    STAGES[f"st_fvcf{name}"] = (f"select variant_id, chrom, start, ref, alt, info from st_vcf "
                                f"where variant_id in (select variant_id from st_ids{name})")


_ids("")
_ids("_pc_canon", True, True)

# --- VEP, NMD ------------------------------------------------------------------
STAGES["st_vep_rows"] = "select " + ", ".join(
    _nullish(c) for c in ["Uploaded_variation", "Gene", "Feature", "Consequence", "CADD_PHRED",
                          "SpliceAI_pred", "SIFT", "LoF"]) + " from fx_vep"
STAGES["st_vep_keyed"] = """
select *, string_split(Uploaded_variation, '_')[1] as k_chrom,
       try_cast(string_split(Uploaded_variation, '_')[2] as bigint) as k_start,
       string_split(Uploaded_variation, '_')[3] as k_ref,
       array_to_string(string_split(Uploaded_variation, '_')[4:], '_') as k_alt
from st_vep_rows
"""
SPLICE_MAX = ("greatest(" + ", ".join(
    f"try_cast(string_split(SpliceAI_pred, '|')[{i}] as double)" for i in (2, 3, 4, 5)) + ")")
PAREN = r"try_cast(nullif(regexp_extract(SIFT, '\(([0-9.eE+-]+)\)', 1), '') as double)"
STAGES["st_vep"] = f"""
select Uploaded_variation as variant_id, k_chrom as chrom, k_start as start, k_ref as ref, k_alt as alt,
       Gene, Feature, Consequence, {PAREN} as sift_score, try_cast(CADD_PHRED as double) as CADD_PHRED,
       {SPLICE_MAX} as SpliceAI_delta_score, LoF,
       case when length(k_ref) = 1 and length(k_alt) = 1 then 'SNV' else 'indel' end as variant_type,
       {_onehot_tiny('Consequence')}
from st_vep_keyed
"""
NMD_KEY = ("chromosome || '_' || cast(try_cast(start_variant as bigint) as varchar) || '_' || ref "
           "|| '_' || alt")
STAGES["st_nmd"] = f"""
select {NMD_KEY} as variant_id, transcript_id as transcript,
       lower(nmd_escape) = 'true' as nmd_escape, lower(nmd_last_exon_rule) = 'true' as nmd_last_exon_rule
from fx_nmd
"""

# --- E2G -----------------------------------------------------------------------
STAGES["st_gmap"] = r"""
select regexp_replace(gene_id, '\..*$', '') as gu, min(gene_id) as gene_id from fx_gene_line group by 1
"""
STAGES["st_gpairs"] = r"""
select distinct gene_id as gene, regexp_replace(gene_id, '\..*$', '') as gu from fx_gene_line
"""


def _pairs(name, cell_types=None):
    ct = f" and cell_type_id in {_in(cell_types)}" if cell_types else ""
    STAGES[f"st_pairs{name}"] = f"""
select enhancer_id, target_gene_id, min(target_gene_name) as target_gene_name,
       min(target_gene_tss) as target_gene_tss, max(score) as score,
       count(distinct cell_type_id) as n_cell_types
from fx_prediction where model = 'ENCODE-rE2G'{ct}
group by enhancer_id, target_gene_id having max(score) >= 0.5
"""
    STAGES[f"st_pair_iv{name}"] = f"""
select p.enhancer_id, p.target_gene_id, p.target_gene_name, p.target_gene_tss, p.score, p.n_cell_types,
       e.chromosome as chrom, e.start, e."end", e.class
from st_pairs{name} p join fx_enhancer e on p.enhancer_id = e.id
where e.class in {_in(Q.E2G_CLASSES)}
"""


_pairs("")
_pairs("_ct", Q.COLLAPSE_CELL_TYPES)


def _links(name, variants, pairs=""):
    STAGES[f"st_links{name}"] = f"""
select v.variant_id, iv.target_gene_id, iv.target_gene_name, max(iv.score) as e2g_score,
       min(abs(v.start - iv.target_gene_tss)) as distance_to_tss, min(iv.class) as enhancer_class,
       max(iv.n_cell_types) as n_cell_types
from {variants} v join st_pair_iv{pairs} iv
  on replace(v.chrom, 'chr', '') = iv.chrom and v.start >= iv.start and v.start < iv."end"
group by v.variant_id, iv.target_gene_id, iv.target_gene_name
"""
    STAGES[f"st_e2g{name}"] = f"""
select l.variant_id, coalesce(g.gene_id, l.target_gene_id) as target_gene_id, l.target_gene_name,
       l.e2g_score, l.enhancer_class, l.distance_to_tss, l.n_cell_types
from st_links{name} l left join st_gmap g on l.target_gene_id = g.gu
"""


_links("_all", "fx_variant")
_links("_all_ct", "fx_variant", "_ct")
_links("_f", "st_fvcf")
_links("_f_pc_canon", "st_fvcf_pc_canon")


def _splice(name, variants):
    STAGES[f"st_splice{name}"] = f"""
select v.variant_id, coalesce(g.gene, a.gene_id) as gene, a.AbSplice_DNA_max, a.AbSplice2_max
from {variants} v join fx_splice a
  on v.chrom = a.chrom and v.start = a.start and v.ref = a.ref and v.alt = a.alt
left join st_gpairs g on a.gene_id = g.gu
"""


_splice("_f", "st_fvcf")
_splice("_f_pc_canon", "st_fvcf_pc_canon")


def combine_sql(tools=(), pc=False, canon=False) -> str:
    suffix = "_f_pc_canon" if (pc and canon) else "_f"
    sel, joins = ["b.*", ONEHOT_INT], []
    if "vep" in tools:
        sel.append("v.sift_score, v.CADD_PHRED, v.SpliceAI_delta_score, v.LoF")
        joins.append("left join st_vep v on b.variant_id = v.variant_id and b.transcript = v.Feature")
    if "nmd" in tools:
        sel.append("n.nmd_escape, n.nmd_last_exon_rule")
        joins.append("left join st_nmd n on b.variant_id = n.variant_id and b.transcript = n.transcript")
    if "e2g" in tools:
        sel.append("e.target_gene_name as e2g_target_gene_name, e.e2g_score as e2g_e2g_score, "
                   "e.enhancer_class as e2g_enhancer_class, e.distance_to_tss as e2g_distance_to_tss, "
                   "e.n_cell_types as e2g_n_cell_types")
        joins.append(f"left join st_e2g{suffix} e on b.variant_id = e.variant_id and b.gene = e.target_gene_id")
    if "absplice" in tools:
        sel.append("s.AbSplice_DNA_max, s.AbSplice2_max")
        joins.append(f"left join st_splice{suffix} s on b.variant_id = s.variant_id and b.gene = s.gene")
    where = ["true"] + (["b.gene_type = 'protein_coding'"] if pc else []) + (["b.canonical"] if canon else [])
    return (f"select {', '.join(sel)} from st_base b {' '.join(joins)} where {' and '.join(where)}")


# --- queries -----------------------------------------------------------------------
GTF_OUT = 'seqname, feature, start, "end", strand, attributes'

ORACLES: dict[str, str] = {
    "scan_vcf": "select * from st_vcf",
    "scan_gtf_transcripts": f"select {GTF_OUT} from st_gtf_tx",
    "scan_gtf_genes": f"select {GTF_OUT} from st_gtf_gene",
    "scan_vep_tab": "select * from st_vep_rows",
    "scan_predictions": "select * from fx_prediction",
    "scan_score_files": "select chrom, start, ref, alt, gene_id, AbSplice_DNA_max, AbSplice2_max from fx_splice",
    "scan_nmd_csv": f"""
select {NMD_KEY} as variant_id, transcript_id as transcript, lower(nmd_escape) = 'true' as nmd_escape,
       case when chromosome = 'chr2' then null else lower(nmd_last_exon_rule) = 'true' end as nmd_last_exon_rule
from fx_nmd""",
    "concat_chunks": """
select variant_id, Feature, CADD_PHRED, SpliceAI_delta_score,
       case when chrom = 'chr3' then null else LoF end as LoF
from st_vep""",
    "csq_explode": "select variant_id, gene, transcript, consequence, impact from st_ann where track = 'small'",
    "csq_fields": f"select {ANN_COLS} from st_ann where track = 'small'",
    "variant_type": """
select variant_id, case when length(ref) = 1 and length(alt) = 1 then 'SNV' else 'indel' end as variant_type
from fx_csq union all select variant_id, 'SV' as variant_type from fx_sv_csq""",
    "union_tracks": "select variant_id, variant_type, transcript, consequence from st_ann",
    "gtf_attributes": "select * from st_attrs",
    "canonical_pick": "select * from st_meta",
    "base_table": "select * from st_base",
    "filter_toggles": """
select variant_id, transcript, gene_type, canonical, variant_type from st_base
where gene_type = 'protein_coding' and canonical""",
    "key_split": """
select variant_id, string_split(variant_id, '_')[1] as chrom,
       try_cast(string_split(variant_id, '_')[2] as bigint) as start,
       string_split(variant_id, '_')[3] as ref,
       array_to_string(string_split(variant_id, '_')[4:], '_') as alt
from (select distinct Uploaded_variation as variant_id from fx_vep) d""",
    "key_build": f"select {NMD_KEY} as variant_id, transcript_id as transcript from fx_nmd",
    "onehot_vep": f"select Uploaded_variation as variant_id, Feature, {_onehot_tiny('Consequence')} from st_vep_rows",
    "onehot_base": f"select b.variant_id, b.transcript, {ONEHOT_INT} from st_ann b where b.track = 'small'",
    "spliceai_delta": f"select Uploaded_variation as variant_id, Feature, {SPLICE_MAX} as SpliceAI_delta_score from st_vep_rows",
    "paren_score": f"select Uploaded_variation as variant_id, Feature, {PAREN} as sift_score from st_vep_rows",
    "vep_tidy": "select * from st_vep",
    "analysis_set_ids": "select variant_id from st_ids",
    "filtered_vcf": "select * from st_fvcf",
    "chrom_subset": f"select variant_id, chrom, start from st_fvcf where chrom in {_in(Q.CHROMOSOMES)}",
    "chunk_export": "select variant_id, chrom, start, ref, alt from st_fvcf",
    "interval_bins": """
select id, unnest(range(start // 10000, (("end" - 1) // 10000) + 1)) as bin
from fx_enhancer where "end" > start""",
    "interval_overlap": """
select v.variant_id, e.id as enhancer_id
from fx_variant v join fx_enhancer e
  on replace(v.chrom, 'chr', '') = e.chromosome and v.start >= e.start and v.start < e."end"
""",
    "collapse_pairs": "select * from st_pairs_ct",
    "pair_intervals": "select * from st_pair_iv",
    "variant_gene_agg": "select * from st_links_all",
    "gene_version_map": "select gene_id, gu as gene_id_unversioned from st_gmap",
    "gene_version_pairs": "select gene as gene_id, gu as gene_id_unversioned from st_gpairs",
    "e2g": "select * from st_e2g_all",
    "e2g_tss_cap": f"select * from st_e2g_all_ct where distance_to_tss <= {Q.TSS_CAP}",
    "splice_lookup": "select * from st_splice_f",
    "score_lookup": """
select v.variant_id, s.AbSplice_DNA_max, s.AbSplice2_max, c.CADD_PHRED, c.CADD_raw
from fx_variant v
left join fx_splice s on v.chrom = s.chrom and v.start = s.start and v.ref = s.ref and v.alt = s.alt
left join fx_cadd c on v.chrom = c.chrom and v.start = c.start and v.ref = c.ref and v.alt = c.alt""",
    "score_lookup_missing": """
select v.variant_id, s.AbSplice_DNA_max, s.AbSplice2_max
from fx_variant v
left join fx_splice s on v.chrom = s.chrom and v.start = s.start and v.ref = s.ref and v.alt = s.alt""",
    "combine_none": combine_sql(),
    "combine_vep": combine_sql(("vep",)),
    "combine_nmd": combine_sql(("nmd",)),
    "combine_e2g": combine_sql(("e2g",)),
    "combine_splice": combine_sql(("absplice",)),
    "combine_all": combine_sql(("vep", "nmd", "e2g", "absplice"), pc=True, canon=True),
    "read_annotations": combine_sql(("vep", "e2g")),
    "annotate": combine_sql(("vep", "nmd", "e2g", "absplice"), pc=True, canon=True),
    "overwrite_drops_stale": """
select variant_id, transcript, variant_type, gene_type, canonical from st_base where canonical""",
    "sorted_gtf": f"select {GTF_OUT} from st_gtf_gene union all select {GTF_OUT} from st_gtf_tx",
    "run_metrics": """
select count(*) as n_rows, count(distinct variant_id) as distinct_variant_id,
       count(distinct transcript) as distinct_transcript, count(distinct gene) as distinct_gene,
       count(*) filter (where canonical) as n_canonical
from st_base""",
    "near_gene": f"""
select p.variant_id, p.transcript_id,
       case when p.pos < p.tx_start then p.tx_start - p.pos when p.pos >= p.tx_end then p.pos - p.tx_end + 1 end as distance,
       case when p.pos < p.tx_start or p.pos >= p.tx_end then
            case when (p.pos < p.tx_start) = (p.strand = 1) then 'upstream' else 'downstream' end end as side,
       case when p.pos >= p.tx_start and p.pos < p.tx_end then
            case when exists (select 1 from fx_exon x where x.transcript_id = p.transcript_id
                              and p.pos >= x.exon_start and p.pos < x.exon_end) then 'exon' else 'intron' end end as overlap
from (select v.variant_id, t.transcript_id, v.start as pos, t.tx_start, t.tx_end, t.strand
      from fx_variant v join fx_transcript t
        on v.chrom = t.chrom and v.start >= t.tx_start - {Q.NEAR_GENE_DISTANCE}
       and v.start < t.tx_end + {Q.NEAR_GENE_DISTANCE}) p""",
    "nmd_rules": f"""
select variant_id, transcript_id, exon_number, n_exons, ptc_offset,
       last_rule as nmd_last_exon_rule, penult_rule as nmd_50nt_penultimate_rule,
       long_rule as nmd_long_exon_rule, ptc_offset < {Q.NMD_START_NT} as nmd_start_proximal_rule,
       n_exons = 1 as nmd_single_exon_rule,
       (last_rule or penult_rule or long_rule or ptc_offset < {Q.NMD_START_NT} or n_exons = 1) as nmd_escape
from (
  select s.variant_id, s.transcript_id, x.exon_number, x.n_exons,
         cast(x.exon_offset + case when t.strand >= 0 then s.pos - x.exon_start
                                   else x.exon_end - 1 - s.pos end as bigint) as ptc_offset,
         x.exon_number = x.n_exons as last_rule,
         (x.exon_number = x.n_exons - 1 and (case when t.strand >= 0 then x.exon_end - s.pos
                                                  else s.pos - x.exon_start + 1 end) <= 50) as penult_rule,
         (x.exon_end - x.exon_start) > {Q.NMD_LONG_EXON_NT} as long_rule
  from (select variant_id, transcript as transcript_id, start as pos from st_ann
        where track = 'small' and consequence = 'stop_gained') s
  join (select *, coalesce(sum(exon_end - exon_start) over (partition by transcript_id order by exon_number
                           rows between unbounded preceding and 1 preceding), 0) as exon_offset
        from fx_exon) x
    on s.transcript_id = x.transcript_id and s.pos >= x.exon_start and s.pos < x.exon_end
  join fx_transcript t on t.transcript_id = s.transcript_id
) r""",
}


_counts = {
    "transcript_rows": "st_meta", "transcript_canonical": "st_meta where canonical", "transcript_mane": "st_meta where mane_select",
    "transcript_symbol": "st_meta where symbol is not null", "gene_rows": "st_gtf_gene", "base_rows": "st_base",
    "base_canonical_rows": "st_base where canonical", "filtered_rows": "st_fvcf_pc_canon", "vep_rows": "st_vep",
    "nmd_rows": "st_nmd", "e2g_rows": "st_e2g_f_pc_canon", "absplice_rows": "st_splice_f_pc_canon",
    "rows": f"({ORACLES['annotate']})", "stored_base": "st_base", "stored_filtered": "st_fvcf_pc_canon", "stored_vep": "st_vep",
    "stored_nmd": "st_nmd", "stored_e2g": "st_e2g_f_pc_canon", "stored_absplice": "st_splice_f_pc_canon"}
_distinct = {"vep_variants": ("variant_id", "st_vep"), "nmd_variants": ("variant_id", "st_nmd"),
             "e2g_variants": ("variant_id", "st_e2g_f_pc_canon"), "e2g_genes": ("target_gene_id", "st_e2g_f_pc_canon"),
             "absplice_variants": ("variant_id", "st_splice_f_pc_canon")}
ORACLES["annotate_metrics"] = "select " + ", ".join(
    [f"(select count(*) from {t}) as {n}" for n, t in _counts.items()]
    + [f"(select count(*) from (select distinct {c} from {t})) as {n}" for n, (c, t) in _distinct.items()])
ORACLES["annotate_scores"] = f"""
select b.*, {ONEHOT_INT}, s.CADD_PHRED, s.CADD_raw
from st_base b left join (
    select v.variant_id, c.CADD_PHRED, c.CADD_raw
    from st_fvcf v left join fx_cadd c
      on v.chrom = c.chrom and v.start = c.start and v.ref = c.ref and v.alt = c.alt) s using (variant_id)"""


ORACLES["filtered_vcf_toggles"] = "select * from st_fvcf_pc_canon"
ORACLES["chunk_export_exact"] = f"""
select (k - 1) // {Q.CHUNK_ROWS} as chunk, count(*) as n_lines, arg_min(chrom, k) as first_chrom, arg_min(start, k) as first_start,
       arg_max(chrom, k) as last_chrom, arg_max(start, k) as last_start
from (select chrom, start, row_number() over (order by chrom, start) as k from st_fvcf) t group by 1"""
ORACLES["interval_overlap_nested"] = """
select e.id as enhancer_id, count(*) as n, min(v.start) as first, max(v.start) as last
from fx_variant v join fx_enhancer e
  on replace(v.chrom, 'chr', '') = e.chromosome and v.start >= e.start
 and v.start < e."end" + case when e.id % 40 = 0 then cast(pow(10, (e.id / 40) % 9) as bigint) else 0 end
group by e.id"""
ORACLES["merged_metrics"] = """
select c as "column", (select count(*) from st_base) as rows, n as n_distinct, true as within_error
from (select 'variant_id' as c, count(distinct variant_id) as n from st_base
      union all select 'transcript', count(distinct transcript) from st_base
      union all select 'gene', count(distinct gene) from st_base) t"""

# The same result by the plan that runs when nothing may be broadcast, and from
# a compacted table.
for _same, _as in (("scan_vcf_blocks", "scan_vcf"), ("filtered_vcf_lines", "filtered_vcf"), ("combine_all_salted", "combine_all"),
                   ("splice_lookup_bucketed", "splice_lookup"), ("splice_lookup_filtered", "splice_lookup"),
                   ("score_lookup_bucketed", "score_lookup"), ("score_lookup_filtered", "score_lookup"),
                   ("splice_lookup_shuffled", "splice_lookup"), ("score_lookup_shuffled", "score_lookup"),
                   ("compacted_scores_lookup", "score_lookup"), ("base_table_shuffled", "base_table"),
                   ("near_gene_shuffled", "near_gene"),
                   ("gtf_near_gene", "near_gene"), ("gtf_nmd_rules", "nmd_rules")):
    ORACLES[_same] = ORACLES[_as]


def oracle_sql() -> dict[str, str]:
    return {k: build(v) for k, v in ORACLES.items()}
