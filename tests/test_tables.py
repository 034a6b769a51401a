"""Recoding, checkbox unfolding, table builds, typing, and a file round trip."""

from __future__ import annotations

import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dictionary_rows import dictionary, row
from formweave.operators.checkbox import checkbox_table, unpivot_checkbox
from formweave.operators.recode import recode_columns
from formweave.operators.typing import UnknownColumnError, cast_by_validation_type, dump_schema
from formweave.plans.compiled import CompiledDictionary
from formweave.plans.tables import TableSpec, build_table, schema_table
from formweave.sources.dump import drop_all_null, normalize_nulls

DD_ROWS = [
    row(0, "subid", "text", "demo", required="y"),
    row(1, "gender", "radio", "demo", choices="0, Female | 1, Male"),
    row(2, "site", "dropdown", "demo", choices="0, North | 1, South"),
    row(3, "race", "checkbox", "demo", choices="1, White | 2, Black, or AA | -1, Unknown"),
    row(4, "race_oth", "text", "demo"),
    row(5, "age", "text", "demo", vtype="integer"),
]
DUMP_SCHEMA = ("subid string, ev string, gender double, site double, race___1 double, race___2 double, "
               "race____1 double, race_oth string, age string")
DUMP_ROWS = [
    ("s1", "e1", 0.0, 0.0, 1.0, 0.0, 0.0, None, "7"),
    ("s1", "e2", 1.0, 5.0, 0.0, 1.0, 1.0, "FOO", "8"),      # site code 5 is unknown
    ("s2", "e1", None, None, 0.0, 0.0, 0.0, None, None),     # all non-key parent cols null
    ("s3", "e1", float("nan"), 1.0, None, 1.0, 0.0, "Foo", "9"),
    ("s3", "e1", float("nan"), 1.0, None, 1.0, 0.0, "Foo", "9"),  # duplicate row
]
KEYS = ["subid", "ev"]


@pytest.fixture()
def setup(spark):
    dd = dictionary(spark, DD_ROWS)
    dump = normalize_nulls(spark.createDataFrame(DUMP_ROWS, DUMP_SCHEMA))
    return dump, CompiledDictionary.compile(dd, dump.columns)


def test_recode_guard_whole_column(setup):
    dump, compiled = setup
    got = {(r.subid, r.ev): (r.gender, r.site)
           for r in recode_columns(dump, ["gender", "site"], compiled).collect()}
    assert got[("s1", "e1")] == ("Female", "0")      # site guarded: one unknown code in the column
    assert got[("s1", "e2")] == ("Male", "5")
    assert got[("s3", "e1")] == (None, "1")           # NaN treated as null


def test_recode_guard_uses_source(setup):
    dump, compiled = setup
    sub = dump.filter(F.col("site") != 5)
    got = {r.site for r in recode_columns(sub, ["site"], compiled, guard_source=dump).collect()}
    assert got == {"0", "1"}                          # guard evaluated on the whole export
    got = {r.site for r in recode_columns(sub, ["site"], compiled).collect()}
    assert got == {"North", "South"}


def test_recode_without_guard(setup):
    dump, compiled = setup
    got = {r.site for r in recode_columns(dump, ["site"], compiled, guard=False).collect()}
    assert got == {"North", "South", None}


def test_checkbox_table(setup):
    dump, compiled = setup
    t = checkbox_table(dump, KEYS, "race", compiled.choices["race"], other_col="race_oth")
    got = sorted((r.subid, r.ev, r.race) for r in t.collect())
    assert got == [("s1", "e1", "White"), ("s1", "e2", "Black, or AA"), ("s1", "e2", "Unknown"),
                   ("s1", "e2", "foo"), ("s3", "e1", "Black, or AA"), ("s3", "e1", "foo")]


def test_unpivot_rows_equal_columns(setup):
    dump, _ = setup
    u = unpivot_checkbox(dump, KEYS, "race")
    assert u.count() == dump.count() * 3
    assert u.filter("checked = 1").count() == 5  # 1 + 2 + 0 + 2 ticked cells


def test_checkbox_unknown_fail(spark, setup):
    dump, compiled = setup
    t = checkbox_table(dump, KEYS, "race", {"1": "White"}, unknown="fail")
    with pytest.raises(Exception):
        t.collect()


def test_build_table(setup):
    dump, compiled = setup
    spec = TableSpec("demo", ("gender", "site", "age"), {"race": "race_oth"})
    tables = build_table(dump, spec, KEYS, compiled)
    assert set(tables) == {"demo", "demo_race"}
    parent = sorted(tuple(r) for r in tables["demo"].collect())
    # s2 dropped (all null), duplicate s3 collapsed, age cast to double
    assert parent == [("s1", "e1", "Female", "0", 7.0), ("s1", "e2", "Male", "5", 8.0),
                      ("s3", "e1", None, "1", 9.0)]
    assert dict(tables["demo"].dtypes)["age"] == "double"


def test_subject_drop_after_keeps_event_duplicates(spark, setup):
    _, compiled = setup
    dump = spark.createDataFrame([("s1", "e1", 0.0), ("s1", "e2", 0.0), ("s2", "e1", None)],
                                 "subid string, ev string, gender double")
    spec = TableSpec("subject", ("gender",), drop_after=("ev",))
    got = sorted(tuple(r) for r in build_table(dump, spec, KEYS, compiled)["subject"].collect())
    assert got == [("s1", "Female"), ("s1", "Female")]   # one row per event survives
    spec = TableSpec("subject", ("gender",), drop_after=("ev",), dedupe_after_drop=True)
    assert build_table(dump, spec, KEYS, compiled)["subject"].count() == 1


def test_strict_cast_raises(spark, setup):
    _, compiled = setup
    bad = spark.createDataFrame([("s", "x1")], "subid string, age string")
    with pytest.raises(PySparkException):
        cast_by_validation_type(bad, compiled).collect()
    lenient = cast_by_validation_type(bad, compiled, strict=False).first()
    assert lenient.age is None


def test_drop_all_null_counts_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (2, 1.0, None)], "k int, a double, b string")
    assert [r.k for r in drop_all_null(df, ["a", "b"]).collect()] == [2]


def test_dump_schema_unknown_column(setup):
    _, compiled = setup
    schema, rtypes = dump_schema(["subid", "ev", "race___1"], compiled, allowed_extra=["ev"])
    assert [f.dataType.simpleString() for f in schema.fields] == ["string", "string", "double"]
    assert rtypes["ev"] == "category"
    with pytest.raises(UnknownColumnError):
        dump_schema(["subid", "nope"], compiled)


def test_schema_table(setup):
    dump, compiled = setup
    spec = TableSpec("demo", ("gender", "age"), {"race": "race_oth"})
    tables = build_table(dump, spec, KEYS, compiled)
    st = schema_table(tables, compiled, {"demo_race": {"race"}})
    cats = sorted(r.category for r in st.filter("table_name = 'demo_race'").collect() if r.category)
    assert cats == ["Black, or AA", "Unknown", "White", "foo"]
    ages = st.filter("column_name = 'age'").collect()
    assert [(r.dtype, r.category) for r in ages] == [("double", None)]


def test_profile_round_trip(spark, tmp_dir):
    from formweave.plans.profiles import LoadProfile, run_profile
    dict_path, dump_path = f"{tmp_dir}/dd.csv", f"{tmp_dir}/export.csv.gz"
    with open(dict_path, "w") as f:
        f.write('"Variable / Field Name","Form Name","Section Header","Field Type","Field Label",'
                '"Choices, Calculations, OR Slider Labels","Text Validation Type OR Show Slider Number",'
                '"Text Validation Min","Text Validation Max","Branching Logic (Show field only if...)",'
                '"Required Field?"\n')
        f.write('biorepidnumber,s,,text,Id,,,,,,y\n')
        f.write('gender,s,,radio,Sex,"0, F | 1, M",,,,,\n')
        f.write('dt,s,,text,Date,,date_mdy,,,,\n')
        f.write('race,s,,checkbox,Race,"1, A | 2, B",,,,,\n')
    with gzip.open(dump_path, "wt") as f:
        f.write("biorepidnumber,gender,dt,race___1,race___2,done_complete\n")
        f.write("10.2,1,2016-02-30,1,1,2\n")
        f.write(",0,2016-01-02,1,0,2\n")
        f.write("11,0,2016-01-02,0,1,2\n")
    profile = LoadProfile("t", keys=("biorepidnumber",), allowed_extra=("done_complete",), drop_null_keys=True,
                          specs=(TableSpec("subject", ("gender", "dt"), {"race": None}),))
    res = run_profile(spark, profile, dump_path, dict_path, out_dir=f"{tmp_dir}/out")
    subj = sorted(tuple(r) for r in spark.table(res.views["subject"]).collect())
    assert [(a, b) for a, b, _ in subj] == [("10.2", "M"), ("11", "F")]
    assert subj[0][2] is None and subj[1][2].isoformat() == "2016-01-02T00:00:00"
    races = sorted(tuple(r) for r in spark.table(res.views["subject_race"]).collect())
    assert races == [("10.2", "A"), ("10.2", "B"), ("11", "B")]
    assert "_schema" in res.paths


def test_save_as_tables(spark, setup):
    from formweave.sources.sinks import save_as_tables
    dump, compiled = setup
    tables = build_table(dump, TableSpec("demo", ("gender",)), KEYS, compiled)
    names = save_as_tables(tables, prefix="fw_test_", mode="overwrite", sort_keys=KEYS)
    assert spark.table(names["demo"]).count() == tables["demo"].count()


def test_recode_join_path_matches_inline(spark, setup, monkeypatch):
    from formweave.operators import metadata, recode
    dump, compiled = setup
    dd = dictionary(spark, DD_ROWS)
    inline = sorted(tuple(r) for r in recode_columns(dump, ["gender", "site"], compiled).collect())
    monkeypatch.setattr(recode, "INLINE_MAP_LIMIT", 1)   # every field now looked up by a join
    for choices in (None, metadata.choice_table(dd)):
        joined = recode_columns(dump, ["gender", "site"], compiled, choice_df=choices)
        assert sorted(tuple(r) for r in joined.collect()) == inline


@pytest.mark.parametrize("n", [3_000, 20_000])
def test_long_option_lists_recode_and_report_alike(spark, n):
    from formweave.operators.recode import guard_values
    from formweave.operators.validate import check_columns
    dd = dictionary(spark, [row(0, "code", "dropdown", choices=" | ".join(f"{i}, Label {i}" for i in range(n))),
                            row(1, "other", "dropdown", choices=" | ".join(f"{i}, Label {i}" for i in range(n)))])
    compiled = CompiledDictionary.compile(dd)
    df = spark.range(200).selectExpr("id", f"cast(id * {n // 200} as double) as code",
                                     f"cast(id + {n} - 100 as double) as other")
    assert guard_values(df, ["code", "other"], compiled) == {"code": True, "other": False}
    got = {r.id: r for r in recode_columns(df, ["code", "other"], compiled).collect()}
    assert all(got[i].code == f"Label {i * (n // 200)}" and got[i].other == str(i + n - 100) for i in range(200))
    bad = {(r.field, r.rule): r.n_bad for r in check_columns(df, compiled, extra_checks={}).collect()}
    assert bad == {("code", "choice"): 0, ("other", "choice"): 100}


def test_a_cancelled_column_keeps_its_values(spark):
    dd = dictionary(spark, [row(0, "c", "radio", choices="1, One | 2, Two")])
    df = spark.createDataFrame([(1.0,), (1.5,), (2.0,), (9e30,), (None,)], "c double")
    got = [r.c for r in recode_columns(df, ["c"], CompiledDictionary.compile(dd)).collect()]
    assert got == ["1", "1.5", "2", "9.0E30", None]


def test_checkbox_plan_and_choice_parse_are_linear(spark):
    import time

    from formweave.operators import metadata
    dd = dictionary(spark, [row(0, "box", "checkbox", choices=" | ".join(f"{i}, L{i}" for i in range(500))),
                            row(1, "long", "radio", choices=" | ".join(f"{i % 9000}, L{i}" for i in range(10_000)))])
    compiled = CompiledDictionary.compile(dd, ["box"])
    df = spark.range(10).select("id", *[(F.col("id") == i % 10).cast("double").alias(f"box___{i}") for i in range(500)])
    start = time.perf_counter()
    out = checkbox_table(df, ["id"], "box", compiled.choices["box"])
    assert time.perf_counter() - start < 8
    assert out.count() == 500
    start = time.perf_counter()
    labels = {r.code: r.label for r in metadata.choice_table(dd).where("field = 'long'").collect()}
    assert len(labels) == 9000 and labels["5"] == "L9005" and labels["8999"] == "L8999"
    assert time.perf_counter() - start < 20
    with pytest.raises(Exception, match="unknown choice code: [1-9]"):
        checkbox_table(df, ["id"], "box", {"0": "a"}, unknown="fail").collect()
    with pytest.raises(ValueError):
        checkbox_table(df, ["id"], "box", {}, rows_unique=True, foreign_key_cols=["id"])


def test_compile_takes_the_columns_fields(spark):
    dd = dictionary(spark, [row(i, f"f{i}", "radio", choices="0, a | 1, b") for i in range(5)])
    assert len(CompiledDictionary.compile(dd, ["f1", "f2___x"]).fields) == 2


def test_build_tables_big_fields_by_join(spark, setup, monkeypatch):
    from formweave.operators import metadata, recode
    from formweave.plans.tables import build_tables
    dump, compiled = setup
    spec = TableSpec("demo", ("gender", "site", "age"), {"race": "race_oth"})
    want = {k: sorted(map(tuple, v.collect())) for k, v in build_tables(dump, [spec], KEYS, compiled).items()}
    monkeypatch.setattr(recode, "INLINE_MAP_LIMIT", 1)
    got = build_tables(dump, [spec], KEYS, compiled, choice_df=metadata.choice_table(dictionary(spark, DD_ROWS)))
    assert {k: sorted(map(tuple, v.collect())) for k, v in got.items()} == want
    lazy = build_tables(dump, [spec], KEYS, compiled, eager_guards=False,
                        choice_df=metadata.choice_table(dictionary(spark, DD_ROWS)))
    assert {k: sorted(map(tuple, v.collect())) for k, v in lazy.items()} == want


def test_select_by_base(spark):
    from formweave.operators.checkbox import select_by_base
    df = spark.createDataFrame([(1, 1.0, 0.0, 2.0, "x")], "k int, race double, race___1 double, racex double, o string")
    assert select_by_base(df, "race", ["k"]).columns == ["k", "race", "race___1"]


def test_unique_keys_skip_dedupe_same_result(spark, setup):
    from formweave.plans.tables import build_tables, keys_unique
    dump, compiled = setup
    spec = TableSpec("demo", ("gender", "site", "age"), {"race": "race_oth"}, drop_after=("ev",))
    assert not keys_unique(dump, KEYS)                     # s3/e1 appears twice
    uniq = dump.dropDuplicates(KEYS)
    assert keys_unique(uniq, KEYS)
    plain = build_tables(uniq, [spec], KEYS, compiled)
    fast = build_tables(uniq, [spec], KEYS, compiled, check_unique_keys=True)
    for name in plain:
        assert sorted(map(tuple, fast[name].collect())) == sorted(map(tuple, plain[name].collect()))
    def n_aggregates(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")
    assert n_aggregates(fast["demo"]) == n_aggregates(uniq)      # no de-duplication added
    # with repeated keys the check keeps the de-duplication
    dup = build_tables(dump, [spec], KEYS, compiled, check_unique_keys=True)
    assert sorted(map(tuple, dup["demo"].collect())) == sorted(map(tuple, build_tables(dump, [spec], KEYS, compiled)["demo"].collect()))


def test_checkbox_rows_unique_matches_distinct(spark, setup):
    dump, compiled = setup
    uniq = dump.dropDuplicates(KEYS).withColumn("race_oth", F.when(F.col("subid") == "s1", "WHITE")
                                                .otherwise(F.col("race_oth")))
    labels = dict(compiled.choices["race"])
    labels["2"] = "White"                       # two options with one label: an in-row duplicate
    for other in ("race_oth", None):
        a = checkbox_table(uniq, KEYS, "race", labels, other_col=other)
        b = checkbox_table(uniq, KEYS, "race", labels, other_col=other, rows_unique=True)
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
        def n_aggregates(df):
            return df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")
        assert n_aggregates(b) == n_aggregates(uniq)         # no de-duplication (shuffle) added
    unknown = checkbox_table(uniq, KEYS, "race", {"1": "White"}, rows_unique=True)
    assert sorted(map(tuple, unknown.collect()), key=str) == sorted(
        map(tuple, checkbox_table(uniq, KEYS, "race", {"1": "White"}).collect()), key=str)


def test_observed_guards_equal_computed(spark, setup, tmp_dir):
    from formweave.operators.recode import guard_values, observe_guards, observed_guards
    dump, compiled = setup
    observed, obs, cols = observe_guards(dump, ["gender", "site", "age"], compiled)
    observed.write.parquet(f"{tmp_dir}/staged")
    got = observed_guards(obs, cols)
    assert got == guard_values(dump, ["gender", "site", "age"], compiled) == {"gender": True, "site": False}


def test_read_dump_multiline_notes(spark, tmp_dir):
    from formweave.sources.dump import read_dump
    dd = dictionary(spark, [row(0, "id", "text"), row(1, "note", "text"), row(2, "g", "radio", choices="0, a")])
    compiled = CompiledDictionary.compile(dd, ["id", "note", "g"])
    with open(f"{tmp_dir}/e.csv", "w") as f:
        f.write('id,note,g\n1,"two\nlines",0\n2,plain,\n')
    df, _ = read_dump(spark, f"{tmp_dir}/e.csv", compiled, multi_line=True)
    assert sorted(tuple(r) for r in df.collect()) == [("1", "two\nlines", 0.0), ("2", "plain", None)]


def test_guards_wide_export(spark, tmp_dir):
    """More coded columns than one mask holds: lazy, eager and observed flags agree."""
    from formweave.operators.recode import guard_values, observe_guards, observed_guards
    n = 140
    dd = dictionary(spark, [row(i, f"c{i}", "radio", choices="0, a | 1, b") for i in range(n)])
    vals = [tuple(float(2 if (i % 9 == 0 and r == 1) else r % 2) for i in range(n)) for r in range(3)]
    df = spark.createDataFrame(vals, ", ".join(f"c{i} double" for i in range(n)))
    compiled = CompiledDictionary.compile(dd, df.columns)
    want = {f"c{i}": i % 9 != 0 for i in range(n)}
    assert guard_values(df, df.columns, compiled) == want
    obs_df, obs, cols = observe_guards(df, df.columns, compiled)
    obs_df.write.parquet(f"{tmp_dir}/w")
    assert observed_guards(obs, cols) == want
    lazy = recode_columns(df, df.columns, compiled).first()
    assert [lazy[f"c{i}"] for i in (0, 1, 9, 139)] == ["0", "a", "0", "a"]   # row 0: codes 0


def test_files_with_swapped_columns_fail_instead_of_being_mixed(spark, tmp_dir):
    from formweave.sources.dump import read_dump
    dd = dictionary(spark, [row(0, "subid", "text"), row(1, "note", "text")])
    compiled = CompiledDictionary.compile(dd)
    for name, text in (("a", "subid,note\ns1,n1\n"), ("b", "note,subid\nn2,s2\n")):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(text)
    same, _ = read_dump(spark, f"{tmp_dir}/a.csv", compiled)
    assert [tuple(r) for r in same.collect()] == [("s1", "n1")]
    with pytest.raises(Exception, match="(?i)header"):
        read_dump(spark, tmp_dir, compiled)[0].collect()


def test_report_counts_bad_dates_date_bounds_and_forced_types(spark):
    from formweave.operators.validate import check_columns
    dd = dictionary(spark, [row(0, "vd", "text", vtype="date_mdy", vmin="2000-01-01", vmax="bad"),
                            row(1, "alb", "text", vmin="3", vmax="5"), row(2, "w", "text", vtype="number_2dp", vmax="2")])
    compiled = CompiledDictionary.compile(dd).with_types({"number": ["alb"]})
    df = spark.createDataFrame([("not a date", "9", "1.25"), ("1990-05-05", "abc", "3.50"), ("3/4/2000 10:11:12", "4", None),
                                (None, None, "x")], "vd string, alb string, w string")
    got = {(r.field, r.rule): r.n_bad for r in check_columns(df, compiled, extra_checks={}).collect()}
    assert got == {("vd", "type"): 1, ("vd", "range"): 1, ("alb", "type"): 1, ("alb", "range"): 1,
                   ("w", "type"): 1, ("w", "decimals"): 1, ("w", "range"): 1}


def test_wide_reports_have_one_grouped_aggregate(spark):
    from formweave.operators.validate import check_columns
    n = 300
    dd = dictionary(spark, [row(i, f"c{i}", "text", vtype="number_1dp", vmin="1", vmax="9", required="y") for i in range(n)])
    df = spark.range(500).select(*[F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") % (i + 2)).cast("string")).alias(f"c{i}")
                                   for i in range(n)])
    got = check_columns(df, CompiledDictionary.compile(dd), extra_checks={}).collect()
    assert len(got) == 4 * n
    assert {r.n_bad for r in got if r.rule == "required"} == {50} and {r.n_bad for r in got if r.rule == "type"} == {0}


def test_fill_and_positions_read_their_input_once(spark, tmp_dir):
    from formweave.plans.ordering import forward_fill, global_position
    spark.range(1000).selectExpr("id as ord", "id % 3 as g", "case when id % 7 = 0 then id end as v", "'x' as other") \
        .write.parquet(f"{tmp_dir}/t")
    t = spark.read.parquet(f"{tmp_dir}/t")
    for df in (forward_fill(t, "v", ["g"], "ord", bits=5), global_position(t, "ord", bits=5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Scan parquet") <= 1 or "ReusedExchange" in plan
