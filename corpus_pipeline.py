"""A corpus pipeline in four stages: language, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and reread as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import jaccard, langid, packing, secret_links
from hirelens.llm.common import store, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the language model rejects: without letters, or far from all languages."""
    training = docs.where(~langid.held_out(F.col("doc_id"))).select(
        "text", "lang", F.xxhash64("doc_id").alias("order"))
    judged = langid.predict(docs.select(*COLUMNS), langid.fit(training))
    return judged.where(~F.col("rejected")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 stays: that with the least (doc_id, text hash).

    A null doc_id comes last. Groups are told apart by their own label, so null and repeated ids keep one document of
    a group, too; repeated rows (equal id and text) are one document. Blank texts are linked with nothing and stay.
    """
    keyed = docs.select(*COLUMNS).withColumn("__text", F.xxhash64("text"))
    groups = jaccard.similar_components(keyed, carry=("__text",), label="__group")
    groups = store(groups.where("n_shingles > 0").groupBy("__group", "doc_id", "__text").count(), "groups")
    first = groups.groupBy("__group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__text")).alias("first"))
    marked = groups.join(first, "__group").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("__text") == F.col("first.__text")))
    named = store(marked.where("not stays or count > 1").select(
        F.col("doc_id").alias("g_id"), F.col("__text").alias("g_text"), "stays"), "named")
    same = F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("__text") == F.col("g_text"))
    keyed = jaccard.may_be(keyed.withColumn("__mark", F.xxhash64("doc_id", "__text")),
                           named.select(F.xxhash64("g_id", "g_text").alias("__mark")))
    kept = keyed.where("__may").join(named.where("not stays"), same, "left_anti")  # only texts that may go are sent
    again = named.where("stays")
    if not again.isEmpty():
        once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "__text"])
        kept = kept.join(again, same, "left_anti").unionByName(once)
    kept = keyed.where("not __may").unionByName(kept)
    return kept.select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets of every text; all documents stay."""
    found = secret_links.secret_spans(docs.select(*COLUMNS))
    hit = F.size("spans") > 0
    text = F.when(hit, secret_links.redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    found = found.withColumn("text", text)
    return found.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(
        *COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", pack)]

#: SQL has no tokenizer, so there is none for the rows of run(); tests/llm/test_pipeline.py holds the stages against
#: plain Python on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
