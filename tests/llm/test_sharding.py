import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quadspark.llm import sharding


def jumped(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * sharding.MULTIPLIER + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jumps_equal_the_plain_loop(spark):
    keys = [*range(300), *(2**k - 1 for k in range(8, 64)), *(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) for i in range(500))]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 24, 25, 200, 5000):
        got = {r.k: r.s for r in rows.select("k", sharding.jump(F.col("k"), shards).alias("s")).collect()}
        assert got == {k: jumped(k, shards) for k in keys}, shards
    with pytest.raises(ValueError):
        sharding.jump(F.col("k"), 0)


def test_a_walk_longer_than_the_first_steps_goes_on(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_FEW", 2)
    rows = spark.range(200).select(F.col("id").alias("k"))
    assert all(r.s == jumped(r.k, 40) for r in rows.select("k", sharding.jump(F.col("k"), 40).alias("s")).collect())


DOCS = "doc_id long, text string, shard string, slot int, _shard int, size int"


def test_plan_of_odd_rows(spark):
    texts = [None, "", "a", "é" * 50_000, "\u0000x", "same", "same", "same"]
    rows = [(i, texts[i % len(texts)], "x", 1, 2, 3) for i in range(400)] + [(None, t, None, None, None, None) for t in texts * 5] + [(7, "same", None, None, None, None)] * 30
    got = sharding.plan(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in got) == want
    by = {}
    for r in got:
        key = int(hashlib.sha256(b"null" if r.doc_id is None else str(r.doc_id).encode()).hexdigest()[:15], 16)
        assert (r.shard, r.grown_shard, r.law) == (jumped(key, 24), jumped(key, 25), "key") and r.grown_shard in (r.shard, 24)
        by.setdefault(r.shard, []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(len(rows)))
        order = [(r.doc_id is None, r.doc_id or 0, r.text_crc32, r.size) for r in rows]
        assert order == sorted(order)
    assert sharding.plan(spark.createDataFrame([], DOCS)).count() == 0


def test_files_by_shard_hold_all_rows_and_columns(spark, tmp_path):
    docs = spark.createDataFrame([(i % 90 if i % 9 else None, f"text {i % 7}", f"s{i}", i, i, i) for i in range(300)], DOCS)
    sharding.write(docs, f"file://{tmp_path}/out", 5)
    back = sharding.read(spark, f"file://{tmp_path}/out")
    assert sorted(map(str, back.select("row.*").collect())) == sorted(map(str, docs.collect()))
    plan = sorted((r.doc_id or -1, r.text_crc32, r.shard, r.slot) for r in sharding.plan(docs, 5).collect())
    assert sorted((r.i or -1, r.c, r.shard, r.slot) for r in back.select(F.col("row.doc_id").alias("i"), F.crc32(F.col("row.text").cast("binary")).alias("c"), "shard", "slot").collect()) == plan
    assert sharding.read(spark, f"file://{tmp_path}/out", 3).count() == sum(p[2] == 3 for p in plan)


def test_only_the_necessary_fraction_moves(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"))
    for before, after in ((24, 25), (24, 32), (100, 110)):
        moved = sharding.moves(docs, before, after).collect()
        share = (after - before) / after
        assert all(r._to >= before for r in moved) and abs(len(moved) - 20_000 * share) < 5 * (20_000 * share) ** 0.5
    sizes = [r["count"] for r in docs.groupBy(sharding.jump(sharding.key_of(F.col("doc_id")), 24)).count().collect()]
    assert len(sizes) == 24 and max(sizes) < 1.2 * 20_000 / 24
