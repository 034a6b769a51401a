"""Checkbox unfolding and recoding on a Structured Streaming source."""

from __future__ import annotations

from dictionary_rows import dictionary, row
from formweave.plans.compiled import CompiledDictionary
from formweave.streaming.unfold import recode_stream, unfold_stream


def test_unfold_stream_matches_batch(spark, tmp_dir):
    rows = [("s1", "2024-01-01 00:00:00", 1.0, 0.0, "X"), ("s2", "2024-01-01 00:00:00", 1.0, 1.0, None),
            ("s1", "2024-01-01 00:00:00", 1.0, 0.0, "x")]
    schema = "subid string, ts string, race___1 double, race___2 double, race_oth string"
    src = spark.createDataFrame(rows, schema).selectExpr("subid", "cast(ts as timestamp) as ts", "race___1",
                                                         "race___2", "race_oth")
    src.write.parquet(f"{tmp_dir}/in")
    dd = dictionary(spark, [row(0, "race", "checkbox", choices="1, White | 2, Black")])
    compiled = CompiledDictionary.compile(dd, ["race___1", "race___2"])
    stream = spark.readStream.schema(src.schema).parquet(f"{tmp_dir}/in")
    out = unfold_stream(stream, ["subid"], "race", compiled.choices["race"], other_col="race_oth",
                        event_time="ts", delay="1 day")
    q = out.writeStream.format("memory").queryName("unfold_out").outputMode("append") \
        .option("checkpointLocation", f"{tmp_dir}/ckpt").start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.subid, r.race) for r in spark.table("unfold_out").collect())
    assert got == [("s1", "White"), ("s1", "x"), ("s2", "Black"), ("s2", "White")]


def test_recode_stream(spark, tmp_dir):
    spark.createDataFrame([(0.0,), (1.0,), (7.0,)], "g double").write.parquet(f"{tmp_dir}/g")
    dd = dictionary(spark, [row(0, "g", "radio", choices="0, No | 1, Yes")])
    compiled = CompiledDictionary.compile(dd, ["g"])
    stream = spark.readStream.schema("g double").parquet(f"{tmp_dir}/g")
    q = recode_stream(stream, ["g"], compiled).writeStream.format("memory").queryName("recode_out") \
        .option("checkpointLocation", f"{tmp_dir}/ckpt2").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.g is None, r.g) for r in spark.table("recode_out").collect()) == \
        [(False, "No"), (False, "Yes"), (True, None)]
