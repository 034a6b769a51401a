"""Validation reports, the branching-logic graph, and asset tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from dictionary_rows import dictionary, row
from formweave.operators import graph
from formweave.operators.assets import asset_table, list_files
from formweave.operators.validate import (ValidationError, check_columns, range_report, recode_report,
                                          required_report, verify_all)
from formweave.plans.compiled import CompiledDictionary

FIX_DD = [  # the fixture dictionary of FIXTURES.md
    row(0, "gender", "radio", "demo", "Basic", choices="0, Female | 1, Male | 2, Other"),
    row(1, "site", "dropdown", "demo", choices="0, North | 1, South"),
    row(2, "race", "checkbox", "demo", choices="1, White | 2, Black, or AA | -1, Unknown", logic="[gender] = '1'"),
    row(3, "ibd", "yesno", "dx", "Dx"),
    row(4, "note", "descriptive", "dx"),
    row(5, "age", "text", "dx", logic="[race(2)] = '1' and ([baseline][ibd] >= 5 or [gender]<>\"\")"),
]


def test_graph_edges(spark):
    dd = dictionary(spark, FIX_DD)
    got = sorted(tuple(r) for r in graph.build_graph(dd).collect())
    assert got == sorted([
        ("start", "gender", ""), ("start", "site", ""), ("start", "ibd", ""),
        ("gender", "race", ""), ("race(2)", "age", ""), ("baseline:ibd", "age", ""), ("gender", "age", ""),
    ])
    vals = sorted((r.field, r.pos, r.value) for r in graph.logic_value_table(dd).collect())
    assert vals == [("age", 0, "1"), ("age", 1, "5"), ("age", 2, ""), ("race", 0, "1")]
    # invariant: every edge target is a dictionary field
    fields = {r.field for r in dd.collect()}
    assert {r.dst for r in graph.build_graph(dd).collect()} <= fields


def validation_setup(spark):
    dd = dictionary(spark, [
        row(0, "id", "text", required="y"),
        row(1, "g", "radio", choices="0, a | 1, b", required="y"),
        row(2, "n", "text", vtype="number_2dp", vmin="0", vmax="10"),
        row(3, "d", "text", vtype="date_ymd"),
    ])
    df = spark.createDataFrame([("1", 0.0, "1.25", "2020-01-01"), (None, 3.0, "11.5", "2020-02-30"),
                                ("3", None, "x", None)], "id string, g double, n string, d string")
    return df, CompiledDictionary.compile(dd, df.columns)


def test_check_columns(spark):
    df, compiled = validation_setup(spark)
    got = {(r.field, r.rule): r.n_bad for r in check_columns(df, compiled).collect()}
    assert got == {("id", "required"): 1, ("g", "choice"): 1, ("g", "required"): 1,
                   ("n", "type"): 1, ("n", "decimals"): 2, ("n", "range"): 1, ("d", "type"): 1}


def test_required_and_recode_reports(spark):
    df, compiled = validation_setup(spark)
    assert {(r.field, r.n_bad) for r in required_report(df, compiled).collect()} == {("id", 1), ("g", 1)}
    got = {(r.field, r.rule, r.n_bad) for r in recode_report(df, compiled).collect()}
    assert got == {("g", "unknown_code", 1), ("d", "bad_date", 1)}


def test_range_report_open_bounds(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,), (-2.0,)], "x double")
    got = [tuple(r) for r in range_report(df, {"x": (0.0, None)}).collect()]
    assert got == [("x", 3, 1)]


def test_verify_all(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    verify_all(df, F.col("x") > 0)
    with pytest.raises(ValidationError):
        verify_all(df, F.col("x") > 1)


def test_asset_table(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/vcf")
    for name in ["B1_123FPM_x.vcf.gz", "B1_77MP_y.vcf.gz"]:
        with open(f"{tmp_dir}/vcf/{name}", "wb") as f:
            f.write(b"x" * 10)
    with open(f"{tmp_dir}/vcf/B1_123FPM_x.vcf.gz.tbi", "wb") as f:
        f.write(b"y" * 3)
    conf = {"BATCHES": {
        "REGENERON1": {"ASSAY_TYPE": "WES", "FILE_TYPE": {"VCF": [f"{tmp_dir}/vcf/*.vcf.gz"],
                                                          "VCF_TBI": [f"{tmp_dir}/vcf/*.vcf.gz.tbi"]}},
        "OTHER": {"ASSAY_TYPE": "WGS", "FILE_TYPE": {"VCF": [f"{tmp_dir}/none/*.vcf.gz"]}},
    }}
    got = sorted((r.file_name, r.batch_code, r.file_type, r.assay_type, r.bytes, r.subject_id)
                 for r in asset_table(spark, conf).collect())
    assert got == [("B1_123FPM_x.vcf.gz", "REGENERON1", "VCF", "WES", 10, "123FP"),
                   ("B1_123FPM_x.vcf.gz.tbi", "REGENERON1", "VCF_TBI", "WES", 3, "123FP"),
                   ("B1_77MP_y.vcf.gz", "REGENERON1", "VCF", "WES", 10, "77")]
    stems = sorted(r.subject_id for r in asset_table(spark, conf, use_batch_parsers=False).collect())
    assert stems == ["B1_123FPM_x.vcf", "B1_123FPM_x.vcf.gz", "B1_77MP_y.vcf"]
    hashes = [r.path_hash for r in asset_table(spark, conf).collect()]
    assert len(set(hashes)) == 3
    assert list_files(spark, f"{tmp_dir}/vcf/*.vcf.gz").schema.names == ["path", "length", "modificationTime"]


def test_registered_checks(spark):
    from formweave.operators.validate import decimals_check
    from formweave.plans.profiles import BIOREPOSITORY_CHECKS
    df, compiled = validation_setup(spark)
    df = df.withColumn("samplenumber", F.lit("12.3456"))
    extra = dict(BIOREPOSITORY_CHECKS)
    extra["n"] = {"two_dp": decimals_check(2)}
    got = {(r.field, r.rule): r.n_bad for r in check_columns(df, compiled, extra_checks=extra).collect()}
    assert got[("samplenumber", "decimals")] == 0
    assert got[("n", "two_dp")] == 2


def test_field_subset(spark):
    from formweave.operators.metadata import field_subset
    dd = dictionary(spark, [row(i, f"f{i}", "checkbox" if i % 2 else "text") for i in range(6)])
    b = field_subset(dd, names=["f1___1", "f2", "f3___2"])
    assert sorted(r.field for r in b["checkboxes"].collect()) == ["f1", "f3"]
    assert sorted(r.field for r in b["not_checkboxes"].collect()) == ["f2"]
    assert {(r.ftype, r.n_fields) for r in b["type_counts"].collect()} == {("checkbox", 2), ("text", 1)}
    assert field_subset(dd, start=1, end=3)["fields"].count() == 2


def test_offending_values_add_up_to_the_report(spark):
    from formweave.operators.validate import check_columns, offending_values, top_offenders
    dd = dictionary(spark, [row(0, "id", "text", required="y"), row(1, "sex", "radio", choices="0, No | x, bad | 1, Yes | x, bad"),
                            row(2, "n", "text", vtype="integer", vmin="0", vmax="9"), row(3, "d", "text", vtype="date_mdy")])
    rows = ([("a", 9.0, "x", "never")] * 40 + [("b", 1.5, str(i), "2001-01-01") for i in range(5, 60)]
            + [(None, None, None, None)] * 3 + [("c", 1.0, "7", "31/31/2001")])
    df = spark.createDataFrame(rows, "id string, sex double, n string, d string").repartition(5)
    compiled = CompiledDictionary.compile(dd, df.columns)
    values = offending_values(df, compiled, dd)
    got = {(r.field, r.rule, r.value): r.n for r in values.collect()}
    assert got["sex", "choice", "9"] == 40 and got["n", "type", "x"] == 40 and got["d", "type", "31/31/2001"] == 1
    assert ("sex", "choice", "1.5") not in got          # 1.5 counts as code 1, as in recoding
    assert got["id", "required", None] == 3 and got["sex", "malformed_choice", " x, bad "] + got["sex", "malformed_choice", " x, bad"] == 2
    sums: dict = {}
    for (field, rule, _), n in got.items():
        sums[field, rule] = sums.get((field, rule), 0) + n
    for r in check_columns(df, compiled).collect():
        assert sums.get((r.field, r.rule), 0) == r.n_bad
    top = [(r.place, r.value, r.n) for r in top_offenders(values, 4, salts=3).where("field = 'n' and rule = 'range'").orderBy("place").collect()]
    assert top == [(1, "10", 1), (2, "11", 1), (3, "12", 1), (4, "13", 1)]


def test_few_and_many_cells_give_one_report(spark, monkeypatch):
    from formweave.operators import validate
    dd = dictionary(spark, [row(i, f"c{i}", "text", vtype="integer", vmin="2", required="y") for i in range(6)])
    df = spark.createDataFrame([tuple(str((i * j) % 5) if (i + j) % 3 else None for j in range(6)) for i in range(40)],
                               ", ".join(f"c{i} string" for i in range(6)))
    compiled = CompiledDictionary.compile(dd, df.columns)
    few = sorted(map(tuple, validate.check_columns(df, compiled).collect()))
    monkeypatch.setattr(validate, "SUMMED_CELLS", 0)
    assert sorted(map(tuple, validate.check_columns(df, compiled).collect())) == few and len(few) == 18


def test_globs_are_one_listing(spark, tmp_dir):
    import os
    from formweave.operators.assets import configured_files, glob_regex, split_glob, topmost
    assert split_glob("/a/b/c*.x") == ("/a/b", "c*.x") and split_glob("/a/*/c.x") == ("/a", "*/c.x")
    assert split_glob("/a/b/c.x") == ("/a/b", "c.x") and split_glob("/*.x") == ("/", "*.x")
    assert glob_regex("a.b{x,y}[!c-d]?*") == r"^a\.b(?:x|y)[^c-d][^/][^/]*$"
    assert sorted(topmost(["/a/b", "/a", "/ab", "/a/b/c", "/ab/x"])) == ["/a", "/ab"] and topmost(["/", "/a"]) == ["/"]
    names = ["x/one.vcf", "x/two.vcf", "x/deep/three.vcf", "y/we ird+(1)#%.vcf", "y/_hidden.vcf", "y/four.bam"]
    for n in names:
        os.makedirs(os.path.dirname(f"{tmp_dir}/{n}"), exist_ok=True)
        with open(f"{tmp_dir}/{n}", "w") as f:
            f.write(n)
    entries = [("A", "VCF", "W", f"{tmp_dir}/x/*.vcf"), ("A", "VCF", "W", f"{tmp_dir}/x/one.vcf"), ("A", "ANY", "W", f"{tmp_dir}/*/*"),
               ("B", "VCF", "G", f"{tmp_dir}/y/*+(1)#%.vcf"), ("B", "NONE", "G", f"{tmp_dir}/z/*.vcf"),
               ("B", "DEEP", "G", f"{tmp_dir}/x/*/t{{hree,wo}}.vcf"), ("B", "VCF", "G", f"{tmp_dir}/y/[a-f]*.bam")]

    def got(**options):
        return sorted((r.batch_code, r.file_type, r.path.split(tmp_dir + "/")[1], r.length)
                      for r in configured_files(spark, entries, **options).collect())
    want = sorted([("A", "VCF", n, len(n)) for n in ("x/one.vcf", "x/one.vcf", "x/two.vcf")]
                  + [("A", "ANY", n, len(n)) for n in ("x/one.vcf", "x/two.vcf", names[3], "y/four.bam")]
                  + [("B", "VCF", names[3], len(names[3])), ("B", "DEEP", names[2], len(names[2])), ("B", "VCF", "y/four.bam", 10)])
    assert got() == want
    assert got(repeats=False) == sorted(set(want))
    many = configured_files(spark, [("A", str(i), "W", f"{tmp_dir}/x/*{i}*.vcf") for i in range(1000)])
    assert many._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 1
    assert many._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert configured_files(spark, []).count() == 0 and configured_files(spark, [entries[4]]).count() == 0
