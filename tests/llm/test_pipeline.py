import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from quadspark.llm import bpe, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def words(text):
    """Words as the contract has them: runs of what is no ASCII white space, A-Z lower-cased."""
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        small = small.replace(c, " ")
    return [w for w in small.split(" ") if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def groups(texts):
    """Smallest member of the group of near-copies of each text, by all pairs of word tuples."""
    sets, top = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            top[b] = a
    return [find(i) for i in range(len(texts))]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def test_near_duplicates_keep_one_of_each_group(spark):
    rng, rows = random.Random(1), []
    for g in range(10):
        base = [f"w{rng.randrange(300)}" for _ in range(60)]
        rows += [(1000 - g * 7 - k, " ".join(w if rng.random() > 0.02 else "other" for w in base), "s") for k in range(5)]
    rows += [(1, None, "s"), (2, "", "s"), (3, None, "s")]
    rows.sort()
    got = corpus_pipeline.near_duplicates(spark, frame(spark, rows), "")
    want = [rows[i] for i, g in enumerate(groups([t for _, t, _ in rows])) if g == i]
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted((i, t) for i, t, _ in want)


def test_near_duplicates_of_rows_that_share_ids(spark):
    w, u = " ".join(f"w{i}" for i in range(50)), " ".join(f"u{i}" for i in range(50))
    rows = [(1, w, "s"), (5, w, "s"), (5, u, "s"), (5, u, "s"), (None, w, "s"), (None, u + " more", "s"), (None, "alone", "s"), (7, None, "s"), (7, None, "s")]
    got = sorted((str(r.doc_id), str(r.text)) for r in corpus_pipeline.near_duplicates(spark, frame(spark, rows), "").collect())
    assert got == sorted([("1", w), ("5", u), ("None", "alone"), ("7", "None"), ("7", "None")])


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with toxic ones, near-copies, personal data and sources of different sizes."""
    rng, rows, labels = random.Random(2), [], []
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    for i in range(1200):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 60))]
        if i % 6 == 0:
            text[3:6] = [rng.choice(["zorkel", "zorkun", "idiot"]), "zorkat", "vrimpa"]
        if i % 10 == 1:
            text[5] = f"mail ann{i}@corp.org or Mr Smith"
        rows.append((i, " ".join(text), f"s{i % 5}" if i % 3 else "hot"))
        labels.append((i, int(i % 6 == 0)))
    rows += [(2000 + k, rows[k * 6 + 1][1] + " end", "s1") for k in range(60)] + [(3000, None, None), (3001, "", "s2")]
    folder = tmp_path_factory.mktemp("sf")
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 0.5, t) for i, t in labels], "doc_id long, quality double, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows


def test_run_against_its_stages_by_brute_force(spark, tables):
    folder, rows = tables
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, folder)
        assert docs.columns == before.columns, name
        docs = spark.createDataFrame(docs.collect(), DOCS)
        kept.append(sorted(docs.collect(), key=lambda r: r.doc_id))
    clean, single, hidden, mixed = kept
    known = {i: t for i, t, _ in rows}
    ids = {r.doc_id for r in clean}
    learned = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((i in ids) == bool(i % 6) for i in learned) / len(learned) > 0.97
    named = groups([r.text for r in clean])
    assert [r.doc_id for r in single] == [r.doc_id for i, r in enumerate(clean) if named[i] == i]
    assert [r.doc_id for r in hidden] == [r.doc_id for r in single]
    for r in hidden:
        old = known[r.doc_id]
        assert (r.text == old) == ("@" not in (old or "")) and "Smith" not in (r.text or "") and "corp.org" not in (r.text or "")
        assert r.n_chars == len(r.text or "") or r.text == old
    size = {r.doc_id: len(words(r.text)) for r in hidden}
    for source in {r.source for r in hidden}:
        own = [r.doc_id for r in hidden if r.source == source]
        whole, taken = sum(map(size.get, own)), sum(size[r.doc_id] for r in mixed if r.source == source)
        assert taken <= mixing.MOST_REPEATS * whole + 1e-9 and (taken or not whole)
    out = corpus_pipeline.run(spark, folder).collect()
    want = []
    for r in mixed:
        ids = bpe.encode_texts([r.text or ""])[0]
        want.append((r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out)) == sorted(want) and np.mean([r.n_tokens for r in out]) > 10
