"""A corpus pipeline over ``documents``: toxicity, line dedup, near dedup,
benchmark decontamination, and mixing.

``STAGES`` lists the stages in order.  A stage takes ``(spark, docs,
sf_dir)`` and works on all rows of ``docs``, which has the columns of
``documents``; its result is written as Parquet in the session's shared
folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.llm.decontaminate import remove_contaminated
from formweave.llm.line_dedup import drop_recurring_lines
from formweave.llm.mixing import WORD, mix_sources
from formweave.llm.queries import held_out
from formweave.llm.set_join import near_duplicates
from formweave.llm.toxicity import drop_toxic
from formweave.session import work_dir

#: The classifier and the edit-bounded search have no SQL; the stages are
#: tested against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents predicted to be toxic; learnt outside the fold 1
    of 3 of the labels."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out(3, 1))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without recurring lines; a document whose words were all in recurring
    lines goes, since each of these stays in the first document."""
    out = drop_recurring_lines(docs)
    changed = F.col("dropped_lines") > 0
    return (out.where(~changed | F.col("text").rlike(WORD))
            .withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
            .select(docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): the
    one with the smallest doc_id, one row of it.  Rows without id stay."""
    gone = near_duplicates(docs, k=5, percent=80).where("not kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return named.select(docs.columns).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark passage."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with ``size``, ``target`` (of the source) and
    ``taken`` (words, repeats counted).  Rows that share an id get the words
    taken of all of them; rows without id cannot be addressed and only count
    towards their source."""
    mix = (mix_sources(docs).where("taken > 0 and doc_id is not null").groupBy("doc_id")
           .agg(F.sum("size").alias("size"), F.max("target").alias("target"), F.sum("taken").alias("taken")))
    return docs.drop("size", "target", "taken").join(mix, "doc_id")


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_dir(spark, "corpus")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
