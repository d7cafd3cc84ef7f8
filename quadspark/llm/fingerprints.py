"""Exact fingerprints of canonical texts, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadspark.llm import scratch
from quadspark.llm.ordering import partitions

#: Chained seeds of the four 64-bit hashes that make a wide hash.
_LANES = 4


def canonical(text: Column) -> Column:
    """Compatibility-normalised and case-folded text with white space trimmed and folded to one space.

    Null counts as empty. ICU in the JVM composes (NFKC) and folds cases; texts of ASCII only are just lower-cased.
    """
    text = F.coalesce(text, F.lit(""))
    compose = lambda t: F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), t, F.lit(True))
    fold = lambda t: F.java_method(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), t, F.lit(True))
    full = F.when(F.rlike(text, F.lit(r"[^\x00-\x7F]")), compose(fold(compose(text)))).otherwise(F.lower(text))
    return F.trim(F.regexp_replace(full, r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+", " "))


def wide_hash(text: Column) -> Column:
    """256 bits of xxhash as lower-case hex: four lanes, each seeded with another constant."""
    lanes = [F.xxhash64(F.lit(k), text) for k in range(1, _LANES + 1)]
    return F.concat(*[F.lpad(F.lower(F.hex(lane)), 16, "0") for lane in lanes])


def colliding(hashed: DataFrame, docs: DataFrame) -> DataFrame:
    """Hashes of ``hashed`` (doc_id, hash) that stand for more than one canonical text; none, as good as always.

    Only documents in buckets of two and more are compared, byte by byte: the smallest and the largest canonical
    text of a bucket, combined before the shuffle, so a large group of copies is never gathered.
    """
    many = hashed.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    wanted = hashed.join(many, "hash", "left_semi").select("doc_id").distinct()
    texts = docs.join(wanted, "doc_id", "left_semi").select(canonical(F.col("text")).alias("canon")).select("canon", wide_hash(F.col("canon")).alias("hash"))
    return texts.groupBy("hash").agg(F.min("canon").alias("low"), F.max("canon").alias("high")).where("low != high").select("hash")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row: equal canonical texts have equal fingerprints, others don't.

    Null texts count as empty, rows that repeat an id are each fingerprinted, other columns don't matter and an
    empty table gives no rows. A hash that stands for several texts gets their SHA-256 added.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hashed = own.select("doc_id", canonical(F.col("text")).alias("canon")).select("doc_id", wide_hash(F.col("canon")).alias("hash"), F.sha2("canon", 256).alias("sha"))
    hashed = scratch.write(hashed, "hashes")
    odd = colliding(hashed, own).withColumn("odd", F.lit(True))
    named = F.when(F.col("odd"), F.concat("hash", F.lit("-"), "sha")).otherwise(F.col("hash"))
    return hashed.join(odd, "hash", "left").select("doc_id", named.alias("fingerprint"))


def _with_edit(rows: DataFrame) -> DataFrame:
    """Add what depends on the edited text: half of ``text``, then as much of ``after.text``."""
    half = F.floor(F.length("text") / 2).cast("int")
    text = F.concat(F.col("text").substr(F.lit(1), F.length("text") - half), F.col("after.text").substr(F.lit(1), half))
    rows = rows.withColumn("edit", text).withColumn("edit_canon", F.when(F.col("edit").isNotNull(), canonical(F.col("edit"))))
    made = {"edited_sha256": F.sha2("edit", 256), "edited_sha": F.sha2("edit_canon", 256), "edited_hash": F.when(F.col("edit_canon").isNotNull(), wide_hash(F.col("edit_canon")))}
    return rows.withColumns(made).drop("edit", "edit_canon")


def _ranges(own: DataFrame) -> tuple[Column, int]:
    """Number of the range that holds a row of (doc_id, text), and how many ranges there are.

    Ranges follow the order by id, null last, then hash of the text, so that rows without an id and rows that share
    one are dealt like others; only equal texts of one id stay together. One bound per range comes to the driver, and
    a row finds its range by bisection.
    """
    key = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("mark"))
    keys = own.select(key.alias("key")).repartitionByRange(partitions(own), "key")
    tops = sorted(tuple(r.top) for r in keys.groupBy(F.spark_partition_id().alias("p")).agg(F.max("key").alias("top")).collect())[:-1]
    if not tops:
        return F.lit(0), 1
    cuts = F.array(*[F.struct(F.lit(last).alias("last"), F.lit(i).cast("long").alias("id"), F.lit(mark).cast("long").alias("mark")) for last, i, mark in tops])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(tops).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) < key, at + step).otherwise(at)), len(tops) + 1


def _same(hash_a: str, sha_a: str, hash_b: str, sha_b: str) -> Column:
    return ((F.col(hash_a) == F.col(hash_b)) & (F.col(sha_a) == F.col(sha_b))).cast("double")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, and tell how alike the fingerprints are: 1.0 or 0.0.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many, or all, of the next
    document; documents are in ascending id order, equal ids by a hash of the text and by text, null ids last, and the
    first follows the last.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Texts are shuffled once, to the range that holds their place in that order; the last document of a range meets
    the first of the next one in a table of one row per range.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    part, n = _ranges(own)
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").isNull(), "doc_id", "mark", "text")
    rows = own.withColumns({"part": part, "mark": F.xxhash64("text"), "canon": canonical(F.col("text"))})
    rows = rows.withColumns({"hash": wide_hash(F.col("canon")), "sha": F.sha2("canon", 256)}).drop("canon")
    rows = rows.withColumns({"after": F.lead(F.struct("text", "hash", "sha")).over(inside), "place": F.row_number().over(inside)})
    rows = _with_edit(rows).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumns({"next_hash": F.col("after.hash"), "next_sha": F.col("after.sha"), "kept": F.when(F.col("after").isNull() | (F.col("place") == 1), F.col("text"))})
    rows = scratch.write(rows.drop("text", "after", "mark"), "edits")

    heads = rows.where("place = 1").select(((F.col("part") + n - 1) % n).alias("part"), F.struct(F.col("kept").alias("text"), "hash", "sha").alias("after"))
    last = rows.where("next_hash is null").drop("edited_sha256", "edited_sha", "edited_hash").withColumnRenamed("kept", "text").join(heads, "part")
    last = _with_edit(last).withColumns({"next_hash": F.col("after.hash"), "next_sha": F.col("after.sha")}).drop("text", "after")
    rows = rows.where("next_hash is not null").drop("kept").unionByName(last)

    odd = scratch.write(colliding(rows.select("doc_id", "hash"), own), "collisions")
    rows = rows.withColumns({"fingerprint": F.col("hash"), "edited_fingerprint": F.col("edited_hash")})
    if not odd.isEmpty():
        for hashed, sha, made in (("hash", "sha", "fingerprint"), ("edited_hash", "edited_sha", "edited_fingerprint")):
            rows = rows.join(odd.select(F.col("hash").alias(hashed), F.lit(True).alias("odd")), hashed, "left")
            rows = rows.withColumn(made, F.when(F.col("odd"), F.concat(hashed, F.lit("-"), sha)).otherwise(F.col(hashed))).drop("odd")
    near_edited, near_next = _same("hash", "sha", "edited_hash", "edited_sha"), _same("hash", "sha", "next_hash", "next_sha")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near_edited.alias("near_edited"), near_next.alias("near_next"))
