"""Public API names and the command line."""

from __future__ import annotations

import json
import os

import formweave
from formweave import cli


def test_public_api_resolves():
    for name in formweave.__all__:
        assert getattr(formweave, name) is not None


def test_cli_graph_and_assets(spark, tmp_dir):
    dd = f"{tmp_dir}/dd.csv"
    with open(dd, "w") as f:
        f.write('"Variable / Field Name","Form Name","Field Type","Branching Logic (Show field only if...)"\n')
        f.write("a,f,radio,\nb,f,text,[a] = '1'\n")
    cli.main(["graph", "--dictionary", dd, "--out", f"{tmp_dir}/g"])
    edges = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/g/edges").collect())
    assert edges == [("a", "b", ""), ("start", "a", "")]

    os.makedirs(f"{tmp_dir}/files")
    with open(f"{tmp_dir}/files/B_1P_x.vcf.gz", "wb") as f:
        f.write(b"abc")
    conf = {"BATCHES": {"REGENERON1": {"ASSAY_TYPE": "WES", "FILE_TYPE": {"VCF": [f"{tmp_dir}/files/*.vcf.gz"]}}}}
    with open(f"{tmp_dir}/conf.json", "w") as f:
        json.dump(conf, f)
    cli.main(["assets", "--config", f"{tmp_dir}/conf.json", "--out", f"{tmp_dir}/a", "--md5"])
    row = spark.read.parquet(f"{tmp_dir}/a/assets").first()
    assert (row.file_name, row.subject_id, row.bytes) == ("B_1P_x.vcf.gz", "1", 3)
    assert spark.read.parquet(f"{tmp_dir}/a/md5").first().md5 == "900150983cd24fb0d6963f7d28e17f72"
