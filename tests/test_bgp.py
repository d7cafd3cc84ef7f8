import random
from itertools import product

import pytest

from quadspark.functions.terms import Term, literal, node
from quadspark.operators import bgp as patterns
from quadspark.operators.bgp import Var, bgp
from quadspark.sources.snapshot import Store
from tests.test_quads import logged, make
from tests.test_store import spoil


def answers(quads, asked):
    """Bindings by trying every quad for every pattern."""
    found = [{}]
    for pattern in asked:
        more = []
        for known, quad in product(found, quads):
            now = dict(known)
            for slot, term in zip(pattern, quad, strict=True):
                if isinstance(slot, Var):
                    if now.setdefault(slot.name, term) != term:
                        break
                elif slot is not None and slot != term:
                    break
            else:
                more.append(now)
        found = more
    return sorted(tuple(t.value for t in f.values()) for f in found)


@pytest.mark.parametrize("most", [1000, 3])
def test_stars_and_chains_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(patterns, "MOST_IN_A_STAR", most)
    rng = random.Random(8)
    objects = [Term("a"), Term("b"), Term("c"), literal("a"), literal("x"), literal("x", "en"), literal("1", datatype="d")]
    rows = {(rng.choice("abc"), rng.choice("pqr"), rng.choice(objects), rng.choice("gh")) for _ in range(40)}
    q = make(spark, *rows)
    plain = [(Term(s), Term(p), o, Term(g)) for s, p, o, g in rows]
    s, o, t, g = Var("s"), Var("o"), Var("t"), Var("g")
    p, q_, r = node("p"), node("q"), node("r")
    for asked in (
        [(s, p, o, None), (s, q_, t, None)],
        [(s, p, o, None), (s, q_, o, None), (s, r, None, None)],
        [(s, p, o, g), (s, q_, t, g), (o, r, t, None)],
        [(s, p, literal("x"), None), (s, Var("any"), t, None)],
        [(s, p, s, None), (s, q_, o, None)],
        [(s, p, o, None), (o, q_, t, None), (s, r, t, None)],
    ):
        got = bgp(q, asked)
        order = list(dict.fromkeys(slot.name for pattern in asked for slot in pattern if isinstance(slot, Var)))
        assert got.columns == order and sorted(tuple(x) for x in got.collect()) == answers(plain, asked)
    with pytest.raises(ValueError):
        bgp(q, [(s, p, None, None), (t, q_, None, None)])


def test_five_patterns_on_one_subject_are_one_scan(spark, tmp_path):
    rows = [(f"s{i}", f"p{k}", literal(f"v{i}{k}")) for i in range(20) for k in range(6)]
    make(spark, *rows).write.parquet(f"{tmp_path}/q")
    s = Var("s")
    got = bgp(spark.read.parquet(f"{tmp_path}/q"), [(s, node(f"p{k}"), Var(f"o{k}"), None) for k in range(5)])
    assert spoil(tmp_path / "q") > 0  # nothing reads the quads a second time
    assert sorted(tuple(r) for r in got.collect()) == sorted((f"s{i}", *(f"v{i}{k}" for k in range(5))) for i in range(20))


def test_a_store_joins_the_smallest_first(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store.commit(logged(make(spark, *[(f"s{i}", "big", f"t{i % 5}") for i in range(50)], *[(f"t{i}", "small", literal(f"n{i}")) for i in range(5)]), "add"))
    from quadspark.operators.match import Pattern

    assert (store.estimate(Pattern(p=node("big"))), store.estimate(Pattern(p=node("small")))) == (50, 5)
    assert store.estimate(Pattern(s=node("s1"), p=node("big"))) < 2
    got = store.bgp([(Var("s"), node("big"), Var("t"), None), (Var("t"), node("small"), literal("n3"), None)])
    assert sorted(r.s for r in got.collect()) == sorted(f"s{i}" for i in range(50) if i % 5 == 3) and got.columns == ["s", "t"]
