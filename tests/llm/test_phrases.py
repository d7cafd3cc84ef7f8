import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quadspark.llm import phrases


def pieces(text):
    small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", small)]


def mined(docs, most=4, least=30, share=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for words in pieces(text):
            n[lang or "und"] += len(words)
            for k in range(1, most + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        candidates, found = [p for p, a in own.items() if len(p) > 1 and a >= least], []
        for p in candidates:
            a = own[p]
            inside = [q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * own[q] >= share * a for q in inside):
                continue
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


DOCS = "doc_id long, text string, lang string, n int, phrase string"


def table(spark, docs):
    return spark.createDataFrame([(i, t, lang, 0, "x") for i, (lang, t) in enumerate(docs)], DOCS)


def corpus(seed, size):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "é", "Ä b", "x\u0085", "a'b", "\u0000", "w" * 40] + [f"v{i}" for i in range(30)]
    line = " ".join(rng.choices(words, k=12))
    docs = []
    for _ in range(size):
        text = "".join(rng.choice(words[: rng.choice((6, 40))]) + rng.choice((" ", " ", " ", "\t", "  ", ", ", ".", "\n", "; ")) for _ in range(rng.choice((0, 3, 60, 400))))
        docs.append((rng.choice(("en", "en", "en", "de", None, "und")), rng.choice((text, line + text, line))))
    return [*docs, ("en", None), ("fr", None), (None, ""), ("de", "..,"), ("en", "the of " * 3000), ("de", "New York " * 50)]


@pytest.mark.parametrize("window", [50, phrases.WINDOW])
def test_collocations_equal_brute_force(spark, window):
    docs = corpus(3, 200)
    got = phrases.collocations(table(spark, docs), window=window).collect()
    assert sorted(map(tuple, got)) == mined(docs)
    assert {r.lang for r in got} >= {"en", "de", "und"}


def test_other_lengths_and_limits(spark):
    docs = corpus(4, 80)
    for most, least, share, top in ((2, 10, 80, 7), (5, 20, 50, 2000), (3, 30, 101, 100)):
        got = phrases.collocations(table(spark, docs), most_words=most, least=least, share=share, top=top).collect()
        assert sorted(map(tuple, got)) == mined(docs, most, least, share, top), most
    with pytest.raises(ValueError):
        phrases.collocations(table(spark, docs), most_words=1)
    assert phrases.collocations(table(spark, docs).limit(0)).count() == 0


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    docs = corpus(5, 60)
    want = mined(docs)
    monkeypatch.setattr(phrases, "_bitmap", lambda *_: b"\xff" * (1 << (phrases.BITS - 3)))
    assert sorted(map(tuple, phrases.collocations(table(spark, docs)).collect())) == want


def test_repeated_texts_share_their_chunks_and_words_are_owned_once(spark):
    rng = random.Random(6)
    passage = " ".join(f"w{rng.randrange(500)}" for _ in range(2000))
    docs = [("en", passage)] * 20 + [("en", f"before {passage} after")] * 20
    chunks = phrases.dictionary(table(spark, docs)).cache()
    n, times, owned = chunks.agg(F.count("*"), F.max("times"), F.sum(F.col("owned") * F.col("times"))).first()
    alone = phrases.dictionary(table(spark, docs[:1])).count()
    assert owned == 40 * 2000 + 40 and times >= 40 and n <= alone + 6
    assert alone > 2000 / phrases.EVERY / 2
