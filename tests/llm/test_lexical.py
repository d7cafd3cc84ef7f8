import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from quadspark.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k):
    bags = [(i, Counter(cut(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            n, score = sum(b.values()), 0
            for t in set(cut(text)) & set(b):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * (50 + 50 * n * n_docs // length)))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_terms_of_any_text():
    text = "Tom's Élève_7 A-z\u0000\u007f{x}    ￿ "
    for window in (1, 3, 1 << 20):
        assert [t.decode() for some in lexical.terms(text.encode(), window) for t in some] == cut(text)
    assert list(lexical.terms(None)) == list(lexical.terms(b"")) == []


DOCS = "doc_id long, text string, item_id int, score string, norm int"


def test_search_equals_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=rng.choice((1, 3, 20, 300)))) for _ in range(300)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (None, "w1 w2"), (7, texts[9]), (900, None), (901, ""), (902, "?!")]
    docs += [(1000 + i, texts[5]) for i in range(120)] + [(2000, "w1 " * 30_000 + "W3")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice((1, 4, 40))))) for i in range(25)] + [(3, texts[0].upper()), (None, texts[1]), (50, None), (51, ""), (52, "nowhere")]
    own = spark.createDataFrame([(*d, 1, "s", 2) for d in docs], DOCS)
    asked = spark.createDataFrame([(*i, 0, "x") for i in items], "item_id long, text string, doc_id int, number string")
    want = sorted(ranked(docs, items, 50), key=key)
    assert sorted(map(tuple, lexical.search(own, asked).collect()), key=key) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 60)
    assert sorted(map(tuple, lexical.search(own, asked, k=4, bucket=16).collect()), key=key) == sorted(ranked(docs, items, 4), key=key)
    none = own.limit(0)
    assert lexical.search(none, asked).count() == lexical.search(own, asked.limit(0)).count() == 0


def test_buckets_are_pruned_by_norm_and_bounds():
    rng = np.random.default_rng(1)
    corpus = lexical.Corpus(1000, 100_000, np.array([5000, 3000, 1000, 200, 10]))
    codes = [sorted(rng.choice(5, size=rng.integers(1, 6), replace=False).tolist()) for _ in range(500)]
    times = [rng.integers(1, 9, size=len(c)).tolist() for c in codes]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array(rng.integers(5, 200, 500), pa.int64()), pa.array(codes, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))], names=["doc_id", "n", "codes", "times"])
    norms = np.sqrt(lexical._vectors(batch, corpus)[3])
    batch = batch.take(pa.array(np.argsort(-norms)))
    q = lexical._query(1, [0, 1, 2, 3, 4], corpus)
    whole, first = {1: lexical.Best(10, 0)}, {1: lexical.Best(10, 0)}
    assert lexical._search_bucket(batch, corpus, [q], whole) == [q]
    cut = list(lexical._cut(batch, 50))
    left = [q]
    for bucket in cut:
        if left:
            left = lexical._search_bucket(bucket, corpus, left, first)
    assert whole[1].scores.tolist() == first[1].scores.tolist() and whole[1].ids.tolist() == first[1].ids.tolist()
    assert lexical._search_bucket(cut[-1], corpus, [q], {1: lexical.Best(10, int(q.norm * norms.max() * 2))}) == []
