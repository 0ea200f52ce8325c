"""The queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import (
    forest, jaccard, langid, licences, merkle, negatives, packing, pieces, secret_links, sharding, simhash, surrogates,
    turns,
)
from hirelens.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sixteen shards whose row counts differ by one at most."""
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    out = sharding.shuffle_shards(docs.select("doc_id", "text"), 16, size)
    return out.select(
        "doc_id", size.cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents")))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return jaccard.similar_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    training = docs.where(~langid.held_out(F.col("doc_id"))).select(
        "text", "lang", F.xxhash64("doc_id").alias("order"))
    out = langid.predict(docs.select("doc_id", "text"), langid.fit(training))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op5_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    return forest.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with their likeness."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = merkle.with_next(docs.withColumn("print", merkle.fingerprint(F.col("text"))))
    text = merkle.edited(F.col("text"), F.col("next_text"))
    rows = rows.select("doc_id", "text", "print", "next_print", text.alias("edited"))
    rows = rows.withColumn("edited_print", merkle.fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.col("print").alias("fingerprint"), F.col("edited_print").alias("edited_fingerprint"),
        merkle.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        merkle.likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: base spans and linked parts of credentials."""
    rows = secret_links.secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_links.told(F.col("base")), 256).alias("base_sha256"),
        secret_links.told(F.col("spans")).alias("spans"),
    )


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digest of all documents with the licence of the whole text and the notices among its lines."""
    rows = licences.find_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "digest", "licence", F.array_join("notices", ",").alias("notices"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents with keyed surrogates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = surrogates.replace_personal_data(docs, key="corpus-2026")
    told = F.transform("changes", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"], x["with"]))
    return rows.select(
        "doc_id", F.size("changes").cast("long").alias("n_changes"), F.array_join(told, ",").alias("changes"),
        F.sha2(F.coalesce("new_text", F.lit("")), 256).alias("new_sha256"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of all documents as count and checksum, and whether they decode to the text."""
    rows = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"),
        F.crc32(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_crc32"),
        (pieces.decoded(F.col("ids")) == text).alias("round_trip"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired turns of all conversations, damaged beforehand."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turns.with_all(conversations, turns.report(turns.edited(turns.damaged(conversations))))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the vectors whose id is divisible by 100, with every seventh label moved on by one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = (F.col("label").cast("bigint") + 1) % 10
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label")))
    return negatives.hard_negatives(vectors, lambda vec_id: vec_id % 100 == 0)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their components at two differing bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {fn.__name__: fn for fn in (
    op1_sharding, op2_secrets, op3_pieces, op4_surrogates, op5_forest, op6_licences, op7_langid, op8_packing,
    op9_merkle, op10_jaccard, op11_repair, op12_negatives, op13_simhash,
)}
ORACLES: dict[str, str] = {"op6_licences": licences.oracle(), "op12_negatives": negatives.brute_force_sql()}
