"""Key-range files, category codes and publication of table sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from formweave.operators.category import decode, encode, value_dictionary
from formweave.plans.ordering import range_position
from formweave.plans.profiles import run_profile
from formweave.plans.specs import biorepository_profile
from formweave.sources.sinks import (PublishConflictError, publish_tables, published_version, read_published, write_tables)
from test_profiles import make_inputs


def ranges_of(spark, path, keys):
    rows = spark.read.parquet(path).select(F.struct(*keys).alias("k"), F.col("_metadata.file_path").alias("f"),
                                           F.col("_metadata.row_index").alias("i")).orderBy("f", "i").collect()
    files: dict = {}
    for r in rows:
        files.setdefault(r.f, []).append(tuple(r.k))
    return sorted(files.values())


def test_files_follow_each_other_and_hot_keys_are_divided(spark, tmp_dir):
    n = 6000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"),
                               F.create_map(F.lit("a"), F.col("id")).alias("m")).repartition(7)
    path = write_tables({"t": df}, tmp_dir, sort_keys=("k", "absent"), files=10)["t"]
    files = ranges_of(spark, path, ["k", "v"])
    assert sum(map(len, files)) == n and len(files) == 10
    assert all(f == sorted(f) for f in files)
    assert all(a[-1] < b[0] for a, b in zip(files, files[1:]))
    assert max(map(len, files)) <= 2 * n / 10
    assert sum(f[0][0] == 0 for f in files) >= 3        # the hot key spans several files


def test_tables_without_keys_or_rows_are_written(spark, tmp_dir):
    df = spark.range(3).toDF("x")
    paths = write_tables({"a": df, "b": df.limit(0)}, tmp_dir, sort_keys=("k",), files=4)
    assert spark.read.parquet(paths["a"]).count() == 3 and spark.read.parquet(paths["b"]).count() == 0


@pytest.mark.parametrize("range_rows", [7, 1_000_000])
def test_places_by_ranges(spark, range_rows):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 1, 2, 3]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(5)
    got: dict = {}
    for r in range_position(df, ["g"], ["v", "i"], range_rows=range_rows).collect():
        got.setdefault(r.g, []).append((r.pos, r.v, r.i))
    for g, found in got.items():
        want = sorted(((v is not None, v or 0, i) for gg, v, i in rows if gg == g))
        assert [(p, (v is not None, v or 0, i)) for p, v, i in sorted(found)] == list(enumerate(want))


def test_categories_round_trip(spark):
    rows = [(i, v, w) for i, (v, w) in enumerate([("b", "x"), ("a", None), (None, "é"), ("B", "z"), ("", "x"), ("ä", "x")] * 20)]
    df = spark.createDataFrame(rows, "id int, v string, w string")
    dictionary = value_dictionary(df, ["v", "w"], range_rows=2)
    codes = {(r.column_name, r.value): r.code for r in dictionary.collect()}
    for c, values in (("v", {v for _, v, _ in rows}), ("w", {w for _, _, w in rows})):
        assert [codes[c, v] for v in sorted(x for x in values if x is not None)] == list(range(len(values - {None})))
    coded = encode(df, ["v", "w"], dictionary)
    assert {r.v for r in coded.where("id % 6 = 2").collect()} == {-1}
    assert sorted(map(tuple, decode(coded, ["v", "w"], dictionary).collect())) == sorted(rows)
    with pytest.raises(Exception, match="without a code"):
        encode(df.withColumn("v", F.lit("new")), ["v"], dictionary).collect()
    assert encode(df.limit(0), ["v"], value_dictionary(df.limit(0), ["v"])).count() == 0


def test_a_broken_write_publishes_nothing_and_the_rerun_goes_on(spark, tmp_dir):
    good, other = spark.range(5).toDF("x"), spark.range(8).toDF("y")
    broken = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("y"))
    with pytest.raises(FileNotFoundError):
        read_published(spark, tmp_dir)
    assert publish_tables({"a": good.limit(1), "b": other}, tmp_dir, "first") == 1
    with pytest.raises(Exception, match="lost"):
        publish_tables({"a": good, "b": broken}, tmp_dir, "second", parallel=1)
    assert published_version(spark, tmp_dir) == 1
    assert read_published(spark, tmp_dir)["a"].count() == 1             # readers still see the set before
    before = spark.read.parquet(f"{tmp_dir}/second/a").inputFiles()
    assert publish_tables({"a": good, "b": other}, tmp_dir, "second") == 2
    assert spark.read.parquet(f"{tmp_dir}/second/a").inputFiles() == before      # not written again
    assert {n: d.count() for n, d in read_published(spark, tmp_dir).items()} == {"a": 5, "b": 8}
    assert read_published(spark, tmp_dir, 1)["a"].count() == 1
    assert publish_tables({"a": good, "b": other}, tmp_dir, "second") == 2       # the same run again
    assert issubclass(PublishConflictError, RuntimeError)


def test_a_profile_is_published_as_one_set(spark, tmp_dir):
    profile = biorepository_profile()
    dump_path, dict_path = make_inputs(profile, tmp_dir)
    result = run_profile(spark, profile, dump_path, dict_path, out_dir=f"{tmp_dir}/out", publish_run="load1", files=2)
    published = read_published(spark, f"{tmp_dir}/out")
    assert set(published) == set(result.tables) | {"_schema", "_report"}
    assert published["subject"].count() == result.tables["subject"].count() > 0
    assert result.column_report.where("rule = 'null_key'").first()["n_bad"] == 1


def test_sorted_files_are_divided_by_rows(spark, monkeypatch):
    """Few key values must not put the table into as few tasks."""
    from formweave.plans import registry
    from formweave.session import work_dir
    import formweave.sources.sinks as sinks
    folder = work_dir(spark, "orders-in")
    spark.range(1000).selectExpr("id as o_orderkey", "id % 90 as o_custkey", "'O' as o_orderstatus").write.parquet(f"{folder}/orders.parquet")
    monkeypatch.setattr(registry, "FILE_ROWS", 100, raising=False)
    seen, write = [], sinks.write_tables
    monkeypatch.setattr(sinks, "write_tables", lambda tables, *a, **k: seen.append(write(tables, *a, **k)) or seen[-1])
    assert [tuple(r) for r in registry.q_sorted_files(spark, folder).collect()] == [(1000, 0)]
    sizes = [r["count"] for r in spark.read.parquet(seen[0]["orders"]).selectExpr("_metadata.file_path f").groupBy("f").count().collect()]
    assert max(sizes) < 150
