"""Derived test inputs (see FIXTURES.md).

The reference ships no data, so every input shape it reads (variant VCF
with CSQ payload, GTF lines, VEP tab, NMD CSV, E2G star schema, splice
scores) is derived deterministically from the driver's TPC-H-ish tables.

Each view is ONE SQL template. ``{name}`` marks a table reference;
``<...>`` markers stand for the few dialect differences between DuckDB
and Spark. The same template therefore feeds

* Spark: ``spark.sql(template, **dataframes)`` (no global temp views; ``SPARK_SQL``
  has a text with less to shuffle for some), and
* the DuckDB oracle: a ``WITH`` prelude in front of each oracle query.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from vartab.session import grow_partitions, measured_session, planned_bytes, shuffles_dropped, work_dir

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# The two row-multiplying joins with a literal list become generators in
# Spark (same rows, no nested-loop join); DuckDB keeps the literal join.
_DIALECT = {
    "duckdb": {"<END>": '"end"', "<AGG>": "string_agg(", "<AGG_END>": ", ',' order by t.k)",
               "<K3>": "cross join (values (1), (2), (3)) k(k)",
               "<I_UPTO_K>": "join (values (1), (2), (3)) i(i) on i.i <= t.k"},
    "spark": {"<END>": "`end`", "<AGG>": "listagg(", "<AGG_END>": ", ',') within group (order by t.k)",
              "<K3>": "lateral view explode(array(1, 2, 3)) k as k",
              "<I_UPTO_K>": "lateral view explode(sequence(1, t.k)) i as i"},
}

# Templates in dependency order.
FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["fx_gene"] = """
select p_partkey as gene_no, 'chr' || cast(p_partkey % 3 + 1 as string) as chrom,
       cast(floor(p_partkey / 3) as bigint) * 2000 + 1000 as gene_start,
       cast(floor(p_partkey / 3) as bigint) * 2000 + 1500 + p_size * 20 as gene_end,
       'ENSG' || lpad(cast(p_partkey as string), 11, '0') as gene_unversioned,
       'ENSG' || lpad(cast(p_partkey as string), 11, '0') || '.' || cast(p_size % 9 + 1 as string) as gene_id,
       'SYM' || cast(p_partkey as string) as symbol,
       case when p_type in ('ECONOMY', 'STANDARD', 'SMALL') then 'protein_coding' when p_type = 'PROMO' then 'lncRNA' else 'processed_pseudogene' end as gene_type,
       case when p_partkey % 2 = 0 then 1 else -1 end as strand, p_size
from {part}
"""

FIXTURE_SQL["fx_transcript"] = """
select g.gene_no, k.k, g.chrom, g.strand, g.gene_start + 50 * (k.k - 1) as tx_start, g.gene_end as tx_end,
       'ENST' || lpad(cast(g.gene_no * 3 + k.k as string), 11, '0') || '.1' as transcript_id,
       'gene_id "' || g.gene_id || '"; transcript_id "ENST' || lpad(cast(g.gene_no * 3 + k.k as string), 11, '0') || '.1"; gene_type "' || g.gene_type || '"; gene_name "' || g.symbol
       || '"; transcript_type "' || case when k.k = 3 then 'retained_intron' else g.gene_type end || '"; transcript_support_level "' || case k.k when 1 then '1' when 2 then 'NA' else '5' end || '";'
       || case when k.k = 1 then ' tag "basic";' else '' end
       || case when g.p_size % 3 = 0 and k.k < 3 then ' tag "appris_principal_' || cast(g.p_size % 2 + 1 as string) || '";' when g.p_size % 3 = 1 then ' tag "appris_alternative_1";' else '' end
       || case when g.p_size % 4 = 0 and k.k = 2 then ' tag "MANE_Select"; tag "CCDS";' else '' end as attr
from {fx_gene} g <K3>
"""

FIXTURE_SQL["fx_gene_line"] = """
select chrom, gene_id, gene_unversioned from {fx_gene}
union all
select 'chrY' as chrom, gene_id || '_PAR_Y' as gene_id, gene_unversioned from {fx_gene} where gene_no % 50 = 0
"""

FIXTURE_SQL["fx_variant"] = """
select variant_id, chrom, start, ref, alt, min(gene_no) as gene_no, min(ln) as ln
from (select chrom || '_' || cast(start as string) || '_' || ref || '_' || alt as variant_id, a.* from (
  select 'chr' || cast(l_partkey % 3 + 1 as string) as chrom,
         cast(floor(l_partkey / 3) as bigint) * 2000 + 400 + l_orderkey % 2600 as start,
         case l_returnflag when 'A' then 'A' when 'N' then 'C' else 'GT' end as ref,
         case when l_linenumber = 7 then 'TTA' when l_linestatus = 'O' then 'G' else 'T' end as alt,
         l_partkey as gene_no, l_linenumber as ln from {lineitem}) a) b
group by variant_id, chrom, start, ref, alt
"""

FIXTURE_SQL["fx_enhancer"] = """
select c_custkey as id, cast(c_custkey % 3 + 1 as string) as chromosome,
       cast(floor(c_custkey / 3) as bigint) * 2600 + 700 as start,
       cast(floor(c_custkey / 3) as bigint) * 2600 + 1000 + c_nationkey * 1000 as <END>,
       case when c_mktsegment in ('BUILDING', 'AUTOMOBILE') then 'genic' when c_mktsegment = 'MACHINERY' then 'promoter' else 'intergenic' end as class
from {customer}
"""

FIXTURE_SQL["fx_prediction"] = """
select o_custkey as enhancer_id,
       'ENSG' || lpad(cast(o_custkey + o_orderkey % 2 as string), 11, '0') as target_gene_id,
       'SYM' || cast(o_custkey + o_orderkey % 2 as string) as target_gene_name,
       cast(floor((o_custkey + o_orderkey % 2) / 3) as bigint) * 2000 + 1000 as target_gene_tss,
       o_totalprice / 500000 as score,
       case when o_orderstatus = 'P' then 'scE2G' else 'ENCODE-rE2G' end as model,
       o_orderpriority as cell_type_id, cast(o_custkey % 3 + 1 as string) as chromosome
from {orders}
"""

FIXTURE_SQL["fx_splice"] = """
select v.chrom, v.start, v.ref, v.alt, g.gene_unversioned as gene_id, cast(v.start % 100 as double) / 100 as AbSplice_DNA_max, cast(v.start % 64 as double) / 64 as AbSplice2_max
from {fx_variant} v join {fx_gene} g on v.gene_no = g.gene_no
where length(v.ref) = 1 and length(v.alt) = 1 and v.start % 3 = 0
"""

FIXTURE_SQL["fx_csq"] = """
select v.variant_id, v.chrom, v.start + 1 as pos, v.ref, v.alt,
       'AC=1;CSQ=' || <AGG>v.alt || '|' || case when v.start between t.tx_start and t.tx_end - 1 then case v.ln % 4 when 0 then 'missense_variant&splice_region_variant' when 1 then 'stop_gained' when 2 then 'synonymous_variant' else 'intron_variant' end when (v.start < t.tx_start) = (t.strand = 1) then 'upstream_gene_variant' else 'downstream_gene_variant' end
         || '|' || case v.ln % 4 when 1 then 'HIGH' when 0 then 'MODERATE' else 'MODIFIER' end || '|' || g.symbol || '|' || case when v.ln = 5 and t.k = 3 then '-' else g.gene_id end
         || '|Transcript|' || t.transcript_id || '|' || g.gene_type || '|' || cast(t.k as string) || '/3||' || t.transcript_id || ':c.1A>G||||||||||'
         || case when v.start < t.tx_start then cast(t.tx_start - v.start as string) when v.start >= t.tx_end then cast(v.start - t.tx_end + 1 as string) else '' end
         || '|' || cast(t.strand as string) || '|||||||||||' || case when t.k = 1 then 'ENSP1' else '' end<AGG_END> || ';AN=2' as info
from {fx_variant} v join {fx_gene} g on v.gene_no = g.gene_no join {fx_transcript} t on t.gene_no = g.gene_no
group by v.variant_id, v.chrom, v.start, v.ref, v.alt
"""

FIXTURE_SQL["fx_sv_csq"] = """
select 'SV' || cast(s.s_suppkey as string) as variant_id, g.chrom, g.gene_start + 1 as pos, 'N' as ref, '<DEL>' as alt,
       'SVTYPE=DEL;CSQ=deletion|transcript_ablation|HIGH|' || g.symbol || '|' || g.gene_id || '|Transcript|' || t.transcript_id || '|' || g.gene_type || '||||||||||||||' || cast(t.strand as string) || '|||||||||||' as info
from {supplier} s join {fx_gene} g on g.gene_no = s.s_suppkey join {fx_transcript} t on t.gene_no = g.gene_no and t.k = 2
"""

FIXTURE_SQL["fx_vep"] = """
select v.variant_id as Uploaded_variation, g.gene_id as Gene, t.transcript_id as Feature,
       case v.ln % 4 when 0 then 'missense_variant&splice_region_variant' when 1 then 'stop_gained' else 'intron_variant' end as Consequence,
       case when v.start % 2 = 0 then cast(v.start % 40 as string) else '-' end as CADD_PHRED,
       case when v.start % 5 = 0 then g.symbol || '|0.0' || cast(v.start % 10 as string) || '|0.2|0.1|0.' || cast(v.start % 9 as string) || '|1|2|3|4' else '-' end as SpliceAI_pred,
       case when v.ln % 4 = 0 then 'tolerated(0.' || cast(v.start % 10 as string) || ')' else '-' end as SIFT,
       case when v.ln % 4 = 1 then 'HC' else '-' end as LoF
from {fx_variant} v join {fx_gene} g on v.gene_no = g.gene_no join {fx_transcript} t on t.gene_no = g.gene_no and t.k < 3
where v.start % 2 = 0 or v.ln = 1
"""

FIXTURE_SQL["fx_nmd"] = """
select v.chrom as chromosome, cast(v.start as string) as start_variant, v.ref, v.alt, t.transcript_id,
       case when v.start % 3 = 0 then 'True' else 'False' end as nmd_escape,
       case when v.ln = 2 then null when v.start % 2 = 0 then 'True' else 'False' end as nmd_last_exon_rule
from {fx_variant} v join {fx_transcript} t on t.gene_no = v.gene_no where v.ln % 4 = 1 or v.ln = 2
"""

FIXTURE_SQL["fx_exon"] = """
select t.transcript_id, t.chrom, i.i as exon_number, t.k as n_exons,
       t.tx_start + (i.i - 1) * 130 as exon_start, t.tx_start + (i.i - 1) * 130 + 100 as exon_end
from {fx_transcript} t <I_UPTO_K>
"""

# A second site-score source for the generic score lookup (RE-2): a
# CADD-like table on even positions, keyed like every site-score table.
FIXTURE_SQL["fx_cadd"] = """
select chrom, start, ref, alt, cast(start % 40 as double) as CADD_PHRED,
       cast(start % 7 as double) / 8 as CADD_raw
from {fx_variant} where start % 2 = 0
"""

# Where Spark gets the same rows with less to shuffle: a variant's id follows from the
# other keys, and a gene's entries are gathered once, not once for each of its variants
# (of which no two rows have the same keys), with the texts that all of them share.
SPARK_SQL: dict[str, str] = {}

SPARK_SQL["fx_variant"] = """
select chrom || '_' || cast(start as string) || '_' || ref || '_' || alt as variant_id, chrom, start, ref, alt, gene_no, ln
from (select chrom, start, ref, alt, min(gene_no) as gene_no, min(ln) as ln from (
  select 'chr' || cast(l_partkey % 3 + 1 as string) as chrom,
         cast(floor(l_partkey / 3) as bigint) * 2000 + 400 + l_orderkey % 2600 as start,
         case l_returnflag when 'A' then 'A' when 'N' then 'C' else 'GT' end as ref,
         case when l_linenumber = 7 then 'TTA' when l_linestatus = 'O' then 'G' else 'T' end as alt,
         l_partkey as gene_no, l_linenumber as ln from {lineitem}) a
group by start, chrom, ref, alt) b
"""

SPARK_SQL["fx_csq"] = """
select v.variant_id, v.chrom, v.start + 1 as pos, v.ref, v.alt,
       'AC=1;CSQ=' || nullif(array_join(transform(e.entries, t -> v.alt || '|' || case when v.start between t.tx_start and t.tx_end - 1 then case v.ln % 4 when 0 then 'missense_variant&splice_region_variant' when 1 then 'stop_gained' when 2 then 'synonymous_variant' else 'intron_variant' end when (v.start < t.tx_start) = (t.strand = 1) then 'upstream_gene_variant' else 'downstream_gene_variant' end
         || '|' || case v.ln % 4 when 1 then 'HIGH' when 0 then 'MODERATE' else 'MODIFIER' end || t.named || case when v.ln = 5 and t.k = 3 then '-' else t.gene_id end
         || t.told || case when v.start < t.tx_start then cast(t.tx_start - v.start as string) when v.start >= t.tx_end then cast(v.start - t.tx_end + 1 as string) else '' end || t.ended), ','), '') || ';AN=2' as info
from {fx_variant} v join (
  select g.gene_no, array_sort(collect_list(struct(t.k, t.tx_start, t.tx_end, t.strand, t.transcript_id, g.symbol, g.gene_id, g.gene_type, '|' || g.symbol || '|' as named,
         '|Transcript|' || t.transcript_id || '|' || g.gene_type || '|' || cast(t.k as string) || '/3||' || t.transcript_id || ':c.1A>G||||||||||' as told,
         '|' || cast(t.strand as string) || '|||||||||||' || case when t.k = 1 then 'ENSP1' else '' end as ended))) as entries
  from {fx_gene} g join {fx_transcript} t on t.gene_no = g.gene_no group by g.gene_no) e on v.gene_no = e.gene_no
"""

_REF = re.compile(r"\{(\w+)\}")


def _render(template: str, dialect: str) -> str:
    for marker, text in _DIALECT[dialect].items():
        template = template.replace(marker, text)
    return template


def deps(template: str) -> list[str]:
    return list(dict.fromkeys(_REF.findall(template)))


# Fixtures that assemble text payloads (string aggregation over joins) are
# written once per session as Parquet in the shared checkpoint folder and
# read back, like the input files of a real run; the others stay lazy.
MATERIALIZED = ("fx_variant", "fx_csq", "fx_sv_csq", "fx_vep", "fx_nmd")
# Built from another without storing that one: many queries read the payload alone.
PASSING = {"fx_csq": "fx_variant"}
_SHARED: dict[tuple[str, str], "Fixtures"] = {}
_LOCK = threading.RLock()


class Fixtures:
    """Lazily built fixture DataFrames for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False):
        self.spark = measured_session(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize = materialize
        self._cache: dict[str, DataFrame] = {}
        self._folder: str | None = None

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        """One materializing instance per (application, data directory)."""
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        with _LOCK:
            if key not in _SHARED:
                _SHARED[key] = cls(spark, sf_dir, materialize=True)
            return _SHARED[key]

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        if self._folder is None:
            self._folder = work_dir(self.spark, "fixtures")
        path = f"{self._folder}/{name}"
        with shuffles_dropped(df.sparkSession):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def table(self, name: str) -> DataFrame:
        with _LOCK:
            return self._table(name)

    def _rendered(self, name: str) -> DataFrame:
        tmpl = SPARK_SQL.get(name, FIXTURE_SQL[name])
        passing = {d for d in [PASSING.get(name)] if d and d not in self._cache}
        kwargs = {d: self._rendered(d) if d in passing else self.table(d) for d in deps(tmpl)}
        return self.spark.sql(_render(tmpl, "spark"), **kwargs)

    def _table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in FIXTURE_SQL:
                df = self._rendered(name)
                if self.materialize and name in MATERIALIZED:
                    df = self._store(name, df)
                self._cache[name] = df
            elif name in BASE_TABLES:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
                grow_partitions(self.spark, planned_bytes(*[self._cache[t] for t in BASE_TABLES if t in self._cache]))
            else:
                raise KeyError(name)
        return self._cache[name]

    __getitem__ = table

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_") or name in BASE_TABLES:
            return self.table(name)
        raise AttributeError(name)


def duckdb_cte(name: str) -> str:
    """The DuckDB text of one fixture, table references made plain names."""
    return _REF.sub(lambda m: m.group(1), _render(FIXTURE_SQL[name], "duckdb")).strip()


def fixture_names() -> Iterable[str]:
    return FIXTURE_SQL.keys()
