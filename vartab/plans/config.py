"""Read a run configuration laid out like the source pipeline's YAML
(``fastvep:`` block for the always-on base and funnel, ``additional:``
block with one entry per tool) into an ``AnnotationConfig``.

VEP and NMD are external programs; their outputs are inputs here, given as
``additional.vep.output`` (VEP tab files) and ``additional.nmd.output``
(NMD CSV files). Keys that only steer scheduling or external programs
(scratch, memory limits, threads, plugin paths, fasta/gff3) are accepted
and ignored; any other unknown key is an error, since a misspelt option
would change the result silently. ``additional.scores`` names site-score
tables: ``{name: {path: ..., columns: [...]}}``.
"""

from __future__ import annotations

from collections.abc import Mapping

from vartab.plans.annotation import TOOLS, AnnotationConfig, E2GConfig, ScoreTable


# The keys a configuration may have, by block.
_KEYS = {
    "": {"input_vcf", "sv_vcf", "output_dir", "chromosomes", "fasta", "gtf", "gff3", "assembly", "fastvep",
         "additional", "input_partitions", "export_funnel", "strip_chr"},
    "fastvep": {"distance", "protein_coding_only", "canonical_only", "include_sv", "scratch", "parse_memory_limit",
                "parse_threads"},
    "additional": {"variants_per_chunk", "vep", "nmd", "e2g", "absplice", "scores"},
    "vep": {"enabled", "include_sv", "output", "distance", "plugin_dir", "fork", "plugin_data"},
    "nmd": {"enabled", "include_sv", "output", "reassign_exons"},
    "e2g": {"enabled", "include_sv", "predictions", "enhancers", "model", "score_threshold", "classes", "cell_types",
            "distance_to_tss", "memory_limit", "threads"},
    "absplice": {"enabled", "include_sv", "result"},
    "score table": {"path", "columns"},
}


def _check_keys(block: str, given: Mapping | None) -> None:
    unknown = set(given or {}) - _KEYS[block]
    if unknown:
        raise ValueError(f"unknown configuration keys{f' in {block}' if block else ''}: {sorted(unknown)}")


def _glob_dir(path: str) -> str:
    return path if any(ch in path for ch in "*?[") or path.endswith(".parquet") \
        else path.rstrip("/") + "/*.parquet"


def from_mapping(cfg: Mapping) -> AnnotationConfig:
    fv = cfg.get("fastvep", {}) or {}
    add = cfg.get("additional", {}) or {}
    _check_keys("", cfg)
    _check_keys("fastvep", fv)
    _check_keys("additional", add)
    scores = add.get("scores") or {}
    for table in scores.values():
        _check_keys("score table", table)
    for tool in TOOLS:
        _check_keys(tool, add.get(tool))
        if (add.get(tool) or {}).get("include_sv", False):
            raise ValueError(f"additional.{tool}.include_sv is not supported: "
                             "SV annotation is base-only")

    def enabled(tool):
        return bool((add.get(tool) or {}).get("enabled", False))

    e2g = None
    if enabled("e2g"):
        e = add["e2g"]
        e2g = E2GConfig(predictions=_glob_dir(e["predictions"]), enhancers=e["enhancers"],
                        model=e.get("model", "ENCODE-rE2G"),
                        score_threshold=float(e.get("score_threshold", 0.5)),
                        classes=e.get("classes", ["genic", "intergenic"]),
                        cell_types=e.get("cell_types"),
                        distance_to_tss=e.get("distance_to_tss"))
    out = AnnotationConfig(
        input_vcf=cfg["input_vcf"], gtf=cfg["gtf"], output_dir=cfg["output_dir"],
        sv_vcf=cfg.get("sv_vcf"),
        distance=int(fv.get("distance", 5000)),
        protein_coding_only=bool(fv.get("protein_coding_only", False)),
        canonical_only=bool(fv.get("canonical_only", False)),
        include_sv=bool(fv.get("include_sv", True)),
        chromosomes=cfg.get("chromosomes") or None,
        variants_per_chunk=int(add.get("variants_per_chunk", 500_000)),
        vep_tab=add["vep"]["output"] if enabled("vep") else None,
        nmd_csv=add["nmd"]["output"] if enabled("nmd") else None,
        e2g=e2g,
        absplice_result=add["absplice"]["result"] if enabled("absplice") else None,
        score_tables={n: ScoreTable(t["path"], list(t["columns"])) for n, t in scores.items()} or None,
        strip_chr=bool(cfg.get("strip_chr", False)),
        input_partitions=cfg.get("input_partitions"),
        export_funnel=bool(cfg.get("export_funnel", False)),
    )
    out.validate()
    return out


def load(path: str) -> AnnotationConfig:
    import yaml

    with open(path) as fh:
        return from_mapping(yaml.safe_load(fh))
