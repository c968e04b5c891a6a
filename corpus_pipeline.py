"""Corpus pipeline: quality rules, quality classifier, near-dedup, source mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of documents.  ``ORACLE_SQL`` is None: SQL can express neither the
learnt classifier nor the merges of the encoder.  The tests hold near-dedup, the counts of the rules, the mixture's targets and the
encoder against brute force, and the classifier by its behaviour on rows held out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import minhash, mixing, quality_gam, quality_rules
from tallyspark.llm.common import written
from tallyspark.llm.queries import round_trip, table

NEAR = 80  # per cent of the union that near copies share; op9 has its own, higher one
_KEY = ["__doc", "__mark", "__check"]


def _marks() -> list[Column]:
    """What a row's decision is joined by: doc_id and two hashes of what the decisions depend on."""
    seen = [F.col("doc_id"), F.col("text"), F.col("lang"), F.col("source")]
    return [F.coalesce(F.col("doc_id"), F.lit(-1)).cast("long").alias("__doc"), F.xxhash64(*seen).alias("__mark"), F.hash(*seen).alias("__check")]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep; equal rows fall or stay together."""
    marked = docs.select("*", *_marks())
    judged = quality_rules.quality_rules(marked, ["lang", "source", *_KEY])
    kept = written(judged.where("kept").select(*_KEY).distinct(), "kept-by-rules")
    return marked.join(kept, _KEY, "left_semi").select(*docs.columns)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality model predicts to be good."""
    return quality_gam.keep_good(docs, quality_gam.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id (null last).  A document is a doc_id with a text:
    texts alone link documents, so a doc_id of several texts keeps each that is nobody's near copy.  Of rows equal in
    doc_id and text one stays, the least by a hash of all its columns.  Documents without words stay.  Near copies share
    NEAR per cent of their five-word shingles; the bands find 99.99% of the pairs on that threshold."""
    kept = minhash.representatives(docs, NEAR).select(minhash.of_row(F.col("doc_id")).alias("__doc"), F.col("mark").alias("__mark"))
    kept = written(kept, "kept-documents")
    # equal rows are folded before the shuffle, and the semi join uses the same shuffle: the texts move once
    whole = F.struct(*docs.columns)
    marked = docs.select(minhash.of_row(F.col("doc_id")).alias("__doc"), F.xxhash64("text").alias("__mark"), whole.alias("__row"), F.xxhash64(whole).alias("__hash"))
    one = marked.groupBy("__doc", "__mark").agg(F.min_by("__row", "__hash").alias("__row"))
    return one.join(kept, ["__doc", "__mark"], "left_semi").select("__row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, up to 3 times or not at all."""
    place = F.struct(F.col("doc_id"), F.col("source"))  # a struct equals another field by field, null like null
    taken = mixing.mix(docs).where("copies > 0").select(F.col("mark").alias("__mark"), place.alias("__at"), "copies")
    taken = written(taken.groupBy("__mark", "__at").agg(F.sum("copies").alias("__copies")), "copies")
    # rows equal in doc_id, text and source stand as one, with the copies of all; they are folded before the shuffle, and
    # the join uses the same shuffle
    marked = docs.withColumn("__own", F.xxhash64("doc_id", "text", "source")).withColumn("__place", place).dropDuplicates(["__own", "__place"])
    joined = marked.join(taken, (F.col("__own") == F.col("__mark")) & (F.col("__place") == F.col("__at")))
    return joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int")))).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of each row and of the bytes that they decode to."""
    return round_trip(docs)


STAGES = [("quality rules", rules), ("quality classifier", classifier), ("MinHash near-dedup", near_dedup), ("mixing sources to target weights", mixture),
          ("byte-level BPE encoding and decoding", token_ids)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents; what one returns is written in the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
