"""Config mapping and the file-to-file run."""

import pytest

from conftest import SF_SMALL
from vartab.plans import inputs as I
from vartab.plans.config import from_mapping
from vartab.plans.fixtures import Fixtures
from vartab.plans.annotation import E2GConfig, annotate
from vartab import sources

BASE = {"input_vcf": "in.vcf.gz", "gtf": "g.gtf.gz", "output_dir": "out"}


def test_config_defaults_follow_the_code_not_the_template():
    c = from_mapping({**BASE, "fastvep": {"distance": 5000}})
    assert (c.protein_coding_only, c.canonical_only, c.include_sv) == (False, False, True)
    assert c.vep_tab is None and c.e2g is None and c.absplice_result is None


def test_config_tools_and_guard():
    c = from_mapping({**BASE, "chromosomes": ["chr21"], "additional": {
        "variants_per_chunk": 1000,
        "vep": {"enabled": True, "output": ["v1.tsv.gz"]},
        "e2g": {"enabled": True, "predictions": "/p", "enhancers": "/e.parquet",
                "classes": ["genic"], "distance_to_tss": 1000},
        "absplice": {"enabled": False, "result": "/a"}}})
    assert c.vep_tab == ["v1.tsv.gz"] and c.e2g.predictions == "/p/*.parquet"
    assert c.e2g.distance_to_tss == 1000 and c.absplice_result is None
    assert c.chromosomes == ["chr21"] and c.variants_per_chunk == 1000
    with pytest.raises(ValueError):
        from_mapping({**BASE, "additional": {"e2g": {"include_sv": True}}})


def test_annotate_from_files(spark, tmp_out):
    fx = Fixtures(spark, SF_SMALL)
    cfg = I.write_input_files(fx, tmp_out, distance=500, e2g=E2GConfig(classes=["genic"]),
                              chromosomes=["chr1"], export_funnel=True, variants_per_chunk=300)
    metrics = annotate(spark, cfg)
    chunks = sources.read_vcf(spark, f"{cfg.output_dir}/funnel/chunks")
    assert {r[0] for r in chunks.select("chrom").distinct().collect()} == {"chr1"}
    ids = spark.read.text(f"{cfg.output_dir}/funnel/small.ids")
    assert sources.read_vcf(spark, f"{cfg.output_dir}/funnel/small.vcf").count() == ids.count()
    # the chromosome subset restricts the exported chunks, not the annotators:
    # the table equals the lazy run without any subset
    from vartab.plans.annotation import AnnotationConfig, annotation_table
    from vartab.plans.queries import _inputs
    lazy = annotation_table(_inputs(fx), AnnotationConfig(
        distance=500, e2g=E2GConfig(classes=["genic"])))
    back_all = sources.read_annotations(spark, f"{cfg.output_dir}/annotations.parquet")
    assert back_all.select(*lazy.columns).exceptAll(lazy).count() == 0
    back = sources.read_annotations(spark, f"{cfg.output_dir}/annotations.parquet")
    n = back.count()
    assert metrics["rows"] == n > 0
    assert metrics["base_rows"] >= metrics["base_variants"] > 0
    assert metrics["funnel"]["rows"]["ids"] == metrics["funnel"]["rows"]["vcf"] == ids.count()
    assert 0 < metrics["funnel"]["rows"]["chunks"] < metrics["funnel"]["rows"]["vcf"]
    assert {"e2g_e2g_score", "AbSplice2_max", "nmd_escape", "sift_score"} <= set(back.columns)
    assert back.filter("variant_type = 'SV'").count() > 0


def test_cli_runs_a_yaml_config_in_the_source_layout(spark, tmp_out, capsys):
    import json

    import yaml

    from vartab.__main__ import main

    cfg = I.write_input_files(Fixtures(spark, SF_SMALL), tmp_out, e2g=E2GConfig())
    doc = {
        "input_vcf": cfg.input_vcf, "sv_vcf": cfg.sv_vcf, "gtf": cfg.gtf,
        "output_dir": cfg.output_dir, "fasta": "unused.fa",
        "fastvep": {"distance": 500, "protein_coding_only": True, "canonical_only": True,
                    "include_sv": True, "parse_threads": 6},
        "additional": {
            "variants_per_chunk": 1000,
            "vep": {"enabled": True, "output": cfg.vep_tab, "fork": 8},
            "nmd": {"enabled": True, "output": cfg.nmd_csv},
            "e2g": {"enabled": True, "predictions": cfg.e2g.predictions,
                    "enhancers": cfg.e2g.enhancers, "score_threshold": 0.5},
            "absplice": {"enabled": True, "result": cfg.absplice_result}}}
    path = tmp_out.removeprefix("file:") + "/config.yaml"
    with open(path, "w") as fh:
        yaml.safe_dump(doc, fh)
    assert main(["annotate", path]) == 0
    metrics = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    back = sources.read_annotations(spark, f"{cfg.output_dir}/annotations.parquet")
    assert metrics["rows"] == back.count() > 0
    assert back.filter("gene_type <> 'protein_coding' or not canonical").count() == 0
