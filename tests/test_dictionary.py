"""Dictionary reading and metadata operators (T1, P1, E1, E2, U4, AG1, N6, N7)."""

from __future__ import annotations

import random

import pandas as pd
import pytest

from dictionary_rows import dictionary, row
from formweave.operators import metadata as md
from formweave.plans.ordering import forward_fill, global_position
from formweave.sources.dictionary import EmptyInputError, read_dictionary

HEADER = ('"Variable / Field Name","Form Name","Section Header","Field Type","Field Label",'
          '"Choices, Calculations, OR Slider Labels","Field Note","Text Validation Type OR Show Slider Number",'
          '"Text Validation Min","Text Validation Max","Identifier?","Branching Logic (Show field only if...)",'
          '"Required Field?"')


def write_dict(path, lines):
    with open(path, "w") as f:
        f.write(HEADER + "\n")
        for line in lines:
            f.write(line + "\n")


def test_read_dictionary_quotes_order_and_fill(spark, tmp_dir):
    path = f"{tmp_dir}/dd.csv"
    write_dict(path, [
        'subid,demo,,text,"Subject, id",,,,,,,,y',
        'gender,demo,"Basic\ninfo",radio,Gender,"0, F | 1, M",,,,,,,y',
        'note,demo,,descriptive,Note,,,,,,,,',
        'race,demo,,checkbox,Race,"1, White | 2, Black, or AA",,,,,,[gender] = \'1\',',
        'odd,demo,,,Odd,,,,,,,,',
        'ibd,dx,,yesno,IBD,,,,,,,,',
        'age,dx,Dx,text,Age,,,integer,0,120,,,',
    ])
    dd = read_dictionary(spark, path).orderBy("ord").collect()
    assert [r.field for r in dd] == ["subid", "gender", "race", "odd", "ibd", "age"]  # P1; null type kept
    hdr = {r.field: r.hdr for r in dd}
    assert hdr["subid"] is None                       # null at the start of a form stays null
    assert hdr["gender"] == "Basic\ninfo" and hdr["race"] == "Basic\ninfo"
    assert hdr["ibd"] is None                         # never filled from another form
    assert hdr["age"] == "Dx"
    assert {r.field: r.label for r in dd}["subid"] == "Subject, id"
    assert {r.field: r.choices for r in dd}["ibd"] == "0, No | 1, Yes"


def test_empty_csv_raises(spark, tmp_dir):
    path = f"{tmp_dir}/empty.csv"
    open(path, "w").close()
    with pytest.raises(EmptyInputError):
        read_dictionary(spark, path)


def brute_ffill(pdf):
    out = {}
    last = {}
    for r in pdf.sort_values("ord").itertuples():
        if r.form is None:
            out[r.ord] = r.hdr
            continue
        if r.hdr is not None:
            last[r.form] = r.hdr
        out[r.ord] = last.get(r.form)
    return out


def test_forward_fill_across_buckets_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        form = rnd.choice(["A", "B", "C", None]) if i % 50 else "A"  # one hot form
        hdr = f"h{i}" if rnd.random() < 0.03 else None
        rows.append((i * 3, form, hdr))
    df = spark.createDataFrame(rows, "ord bigint, form string, hdr string")
    got = {r.ord: r.hdr for r in forward_fill(df, "hdr", ["form"], "ord", bits=5).collect()}
    want = brute_ffill(pd.DataFrame(rows, columns=["ord", "form", "hdr"]).astype(object).where(lambda x: x.notna(), None))
    assert got == want


def test_global_position_matches_brute_force(spark):
    rnd = random.Random(3)
    ords = rnd.sample(range(100000), 2500)
    df = spark.createDataFrame([(o,) for o in ords], "ord bigint")
    got = {r.ord: r.pos for r in global_position(df, "ord", bits=6).collect()}
    assert got == {o: i for i, o in enumerate(sorted(ords))}


def test_field_map_last_wins(spark):
    dd = dictionary(spark, [row(0, "a", "text", "f", label="A"), row(1, "b", "text", "f", label="A"),
                            row(2, "c", "text", "f", label="a"), row(3, "d", "text", "f", label=None)])
    got = {r.key: r.value for r in md.field_map(dd).collect()}
    # name entries first, then label entries: label 'a' overwrites name 'a'
    assert got == {"a": "c", "b": "A", "c": "a", "d": None, "A": "b"}


def test_type_counts_and_flags(spark):
    dd = dictionary(spark, [row(0, "a", "text"), row(1, "b", "radio", choices="0, x"), row(2, "c", "text"),
                            row(3, "d", None), row(4, "e", "descriptive")])
    got = [(r.ftype, r.n_fields) for r in md.type_counts(dd).collect()]
    assert got == [("text", 2), ("radio", 1)]


def test_choice_table_skips_calc_and_missing(spark):
    dd = dictionary(spark, [row(0, "a", "calc", choices="[x] + 1"), row(1, "b", "radio", choices="0, No | 1, Yes"),
                            row(2, "c", "radio"), row(3, "d", None, choices="1, One")])
    got = sorted((r.field, r.code, r.label) for r in md.choice_table(dd).collect())
    assert got == [("b", "0", "No"), ("b", "1", "Yes"), ("d", "1", "One")]


def test_choice_table_strict(spark):
    dd = dictionary(spark, [row(0, "a", "radio", choices="1, A | 2, B, b"), row(1, "b", "radio", choices="1, A | 1, C")])
    got = sorted((r.field, r.code, r.label) for r in md.choice_table_strict(dd).collect())
    assert got == [("b", 1, "C")]


def test_validation_table(spark):
    dd = dictionary(spark, [row(0, "age", "text", vtype="integer", vmin="0", vmax="x"),
                            row(1, "dt", "text", vtype="date_mdy", vmin="2000-01-01"),
                            row(2, "alb", "text"), row(3, "plain", "text")])
    got = {r.field: r for r in md.validation_table(dd, {"number": ["alb"]}).collect()}
    assert set(got) == {"age", "dt", "alb"}
    assert got["age"].min_num == 0.0 and got["age"].max_num is None
    assert got["dt"].min_ts.isoformat() == "2000-01-01T00:00:00"
    assert got["alb"].vtype == "number"


def test_fields_by_names_and_span(spark):
    dd = dictionary(spark, [row(i, f"f{i}", "checkbox" if i == 2 else "text") for i in range(6)])
    got = sorted(r.field for r in md.fields_by_names(dd, ["f2___1", "f2___2", "f4", "zz"]).collect())
    assert got == ["f2", "f4"]
    span = sorted(r.field for r in md.fields_by_span(dd, 1, 3).collect())
    assert span == ["f1", "f2"]
    assert md.fields_by_span(dd, 4).count() == 2
    assert sorted(r.field for r in md.required_fields(dd).collect()) == []
    assert md.date_fields(dd).count() == 0
