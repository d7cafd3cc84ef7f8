"""One query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.llm import bpe, extract, fingerprints, lexical, minhash, mixing, phrases, pii, sharding, tokenfile, toxicity, vectors, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a record per page, read the archives back and list the records."""
    folder = warc.write(_table(spark, sf_dir, "pages"))
    return warc.catalogue(warc.read(spark, folder)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write token ids to record files, read them back and check-sum each document."""
    records = tokenfile.read(spark, tokenfile.write(_table(spark, sf_dir, "documents")))
    return records.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of pages."""
    return extract.extract(_table(spark, sf_dir, "pages"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode texts, decode the ids and digest both."""
    made = bpe.encode(_table(spark, sf_dir, "documents"), decoded=True)
    return made.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    return mixing.plan(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of vectors."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    return pii.pseudonymise(_table(spark, sf_dir, "documents")).select("doc_id", "n_entities", "text")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of texts and of their edits."""
    return fingerprints.compare_edits(_table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, its place there, and its shard with one more of them."""
    return sharding.plan(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_minhash, op3_tokenfile, op4_extract, op5_bpe, op6_mixing, op7_vectors, op8_toxicity, op9_pii, op10_fingerprints, op11_phrases, op12_lexical, op13_sharding)}
ORACLES = {"op1_warc": warc.ORACLE_SQL, "op6_mixing": mixing.ORACLE_SQL, "op11_phrases": phrases.ORACLE_SQL, "op12_lexical": lexical.ORACLE_SQL, "op13_sharding": sharding.ORACLE_SQL}
