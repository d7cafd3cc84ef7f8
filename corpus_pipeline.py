"""A corpus pipeline: drop toxic documents, keep one of near-copies, hide personal data, mix sources, tokenise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.llm import bpe, minhash, mixing, ordering, pii, scratch, toxicity


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; labels that are not held out teach the model.

    Null and empty texts are scored as texts without words; every row, repeated or not, is judged by its own text.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies, that of the smallest id; documents without words stay, each for itself.

    Where ids repeat or are null, every row is a document of its own, numbered by id (null last) and text, so of
    repeated rows one stays, and a text goes only if it has a near-copy itself.
    """
    if docs.where("doc_id is null").isEmpty() and docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        copies = minhash.near_duplicates(docs).where("not kept").select("doc_id")
        return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    rows = docs.select(F.struct("*").alias("own"), F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), "text")
    rows = scratch.write(ordering.ranked(rows, F.col("last"), F.col("id"), F.col("text"), name="key"), "rows")
    copies = minhash.near_duplicates(rows, "key").where("not kept").select(F.col("doc_id").alias("key"))
    return rows.join(copies, "key", "left_anti").select("own.*")


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced; null texts stay null, repeated rows are replaced alike."""
    return pii.pseudonymise(docs).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the target weights ask, none if their source has no words; a null source is one as well."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, one row per copy; null texts have no ids."""
    made = bpe.encode(docs, decoded=True)
    return made.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("pii", surrogates),
    ("mixing", source_mix),
    ("bpe", tokens),
]

#: Learned scores, surrogates and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
