"""The store: what it opens, what it writes, and random histories against a plain model."""

import random
import time

import pytest
from pyspark.sql import functions as F

from quadspark.functions.terms import Term, blank, literal, node
from quadspark.operators import chunks, search
from quadspark.operators.match import Pattern, QuadFilter
from quadspark.sources import snapshot
from quadspark.sources.snapshot import Store
from tests.test_quads import behind, logged, make, n


def spoil(folder, kept=()):
    """Overwrite all data files below a folder but those of some buckets, so that whoever opens one fails."""
    done = 0
    for path in folder.rglob("*.parquet"):
        if not path.name.startswith(".") and path.parent.name not in kept:
            path.write_bytes(b"spoiled")
            (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
            done += 1
    return done


def many(spark, size, start=0):
    return make(spark, *[(f"s{i}", f"p{i % 3}", literal(f"word{i % 50} number {i}"), f"g{i % 4}") for i in range(start, start + size)])


def test_a_commit_opens_only_the_buckets_of_its_ids(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", bucket_rows=8)
    q = many(spark, 1000)
    store.commit(logged(q, "add"))
    run = store._entry()["runs"][0]
    assert run["digits"] == 2
    some = q.where("s in ('s7', 's8')").cache()
    fresh = make(spark, ("new", "p0", literal("fresh")))
    heads = {"b=i" + r.quad_id[:2] for r in some.union(fresh).collect()}
    assert spoil(tmp_path / "data", heads) > 150
    with pytest.raises(Exception):
        store.quads().collect()
    store.commit(logged(some, "delete").union(logged(fresh, "add")))
    assert store.size() == 999 and store.corpus()[0] == 999
    assert n(store.stored(some)) == 0 and n(store.stored(fresh)) == 1
    back = store.changes(1, 2).collect()
    assert sorted((r.op, r.s) for r in back) == [("add", "new"), ("delete", "s7"), ("delete", "s8")]


def test_pages_open_the_buckets_that_follow(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", bucket_rows=8)
    q = many(spark, 600)
    store.commit(logged(q, "add"), "disabled")
    store.commit(logged(q.where("s in ('s1', 's2')"), "delete").union(logged(make(spark, ("new", "p", "o")), "add")), "disabled")
    want = sorted(r.quad_id for r in store.quads().collect())
    seen, after = [], None
    while rows := store.page(after, 199).collect():
        seen += [r.quad_id for r in rows]
        after = seen[-1]
    assert seen == want and len(store.page(None, 0).collect()) == 1 and store.page("zz", 5).count() == 0
    spoil(tmp_path / "data" / store._entry()["runs"][0]["folder"].rsplit("/", 1)[-1] / "quads", {f"b=i{i:02x}" for i in range(0x80, 0x90)})
    assert [r.quad_id for r in store.page("80", 5).collect()] == [i for i in want if i > "80"][:5]


def test_a_filter_answers_for_ids_that_were_never_there(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", bucket_rows=8, large_rows=100)
    q = many(spark, 1000)
    store.commit(logged(q, "add"))
    run = store._entry()["runs"][0]
    assert run["filter"] == 15 and n(store._maybe(run, q)) == 1000
    fresh = many(spark, 200, 5000)
    maybe = n(store._maybe(run, fresh))
    assert maybe < 40  # 1000 of 32,768 bits are set
    assert n(store.stored(q.union(fresh))) == 1000
    small = make(spark, *[(f"t{i}", "p", literal("x")) for i in range(6)])
    small = small.join(store._maybe(run, small), "quad_id", "left_anti")
    for path in (tmp_path / "data").iterdir():
        spoil(path / "quads")
    assert n(store.stored(small)) == 0 and n(small) > 3


def test_results_are_fetched_from_their_buckets(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", bucket_rows=8)
    store.commit(logged(many(spark, 1000), "add"))
    asked = search.one_query(spark, "word7 number")
    want = sorted(map(str, search.search_batch(store.chunks(), asked, top_k=3).collect()))
    ids = search._top(search.relevance(store.postings(["word7", "number"]), *store.corpus(), search.asked_terms(asked)), 3)
    heads = {"b=i" + r.chunk_id[:2] for r in ids.collect()}
    for path in (tmp_path / "data").iterdir():
        if (path / "chunks").exists():
            assert spoil(path / "chunks", heads) > 100
    assert len(want) == 3 and sorted(map(str, search.search_stored(store, asked, top_k=3).collect())) == want


def test_tiers_write_each_quad_a_few_times(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", fanout=3, smallest=200)
    written, merges = [], store._write
    store._write = lambda into, added, *a, **k: (written.append(added.count() if added is not None else 0), merges(into, added, *a, **k))[1]
    for i in range(13):
        store.commit(logged(many(spark, 200, 200 * i), "add"), "disabled")
        store.maintain()
        assert len(store._entry()["runs"]) <= 5
    assert store.size() == n(store.quads()) == 2600
    # Written by its commit and once for each tier, where a full copy every third commit would write 7 times as much.
    assert sum(written) <= 2600 * 4
    assert store.maintain() == 0


def test_old_versions_and_orphans_go_by_age(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    for i in range(3):
        store.commit(logged(many(spark, 5, 10 * i), "add"))
    store.compact()
    (tmp_path / "data" / "left-behind").mkdir()
    assert store.vacuum(3600) == 0 and n(store.at(2).quads()) == 10
    assert store.vacuum() == 3 and n(store.quads()) == 15 and (tmp_path / "data" / "left-behind").exists()
    with pytest.raises(ValueError):
        store.at(2)
    import os

    os.utime(tmp_path / "data" / "left-behind", (time.time() - 10**6,) * 2)
    store.vacuum()
    assert not (tmp_path / "data" / "left-behind").exists() and len(list((tmp_path / "data").iterdir())) == 1


def test_graphs_and_predicates_go_without_lists_of_ids(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    q = many(spark, 100).union(make(spark, ("a", "p0", literal("blank graph"), "x"), ("b", "p9", "s1", "g1"))).cache()
    store.commit(logged(q, "add"))
    assert store.delete_graph("g1") == 2
    run = store._entry()["runs"][-1]
    assert run["removed"] == 0 and not list((tmp_path / "data").rglob("removed/part*"))[1:]
    want = q.where("g <> 'g1'")
    assert store.size() == n(store.quads()) == n(want) and store.corpus()[0] == n(store.chunks()) == n(chunks.project(want))
    assert n(search.search_stored(store, search.one_query(spark, "number 1"))) == 0 and n(search.search_stored(store, search.one_query(spark, "number 2"))) == 1
    assert store.count(Pattern(g=node("g1"))) == 0 == n(store.match(Pattern(g=node("g1"))))
    again = q.where("s = 's1'")
    store.commit(logged(again, "add"))
    assert n(store.stored(q)) == n(want) + 1 and n(search.search_stored(store, search.one_query(spark, "number 1"))) == 1
    store.remove_matches(Pattern(p=node("p1"), g=node("g2")))
    store.remove_matches(Pattern(o=literal("word3 number 3")))
    left = {r.quad_id for r in q.where("(g <> 'g1' or s = 's1') and not (p = 'p1' and g = 'g2') and s <> 's3'").collect()}
    for _ in range(2):
        assert {r.quad_id for r in store.quads().collect()} == left and store.size() == len(left)
        assert {r.quad_id for r in store.chunks().collect()} == left - {r.quad_id for r in q.where("o_type <> 'Literal'").collect()}
        store.compact()
    assert {r.quad_id for r in store.changes(1, store.version()).collect()} == {r.quad_id for r in q.collect()} - left


def test_reindex_disabled_scoped_full(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store.commit(logged(make(spark, ("a", "p", literal("one"), "A"), ("b", "p", literal("two two"), "B"), ("c", "q", literal("three"), "B")), "add"), "disabled")
    found = lambda: sorted(r.value for r in store.chunks().collect())
    asked = lambda q: n(search.search_stored(store, search.one_query(spark, q)))
    assert found() == [] and store.corpus() == (0, 0.0) and asked("one") == 0
    store.reindex(QuadFilter(graphs=("A",)))
    assert found() == ["one"] and store.corpus() == (1, 1.0) and asked("one") == 1 and store.size() == 3
    store.reindex(QuadFilter(not_predicates=("q",)))
    assert found() == ["one", "two two"] and store.corpus() == (2, 1.5)
    store.reindex(QuadFilter(predicates=("p",)), splitter=lambda t: t.split(" "))
    assert found() == ["one", "two", "two"] and store.corpus() == (3, 1.0) and n(store.postings()) == 3
    store.reindex(QuadFilter(graphs=("B",)), full=True)
    assert found() == ["three", "two two"] and asked("one") == 0 and asked("two") == 1
    store.compact()
    assert found() == ["three", "two two"] and store.corpus() == (2, 1.5)
    assert store.reindex() == 7 and found() == ["one", "three", "two two"]
    assert n(store.changes(1, 7)) == 0


def test_counts_come_from_the_log(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    q = many(spark, 60).union(make(spark, (blank("z"), "p0", "y"))).cache()
    store.commit(logged(q, "add"))
    store.commit(logged(q.where("s in ('s0', 's1', 's2')"), "delete"))
    runs = store._entry()["runs"]
    assert runs[0]["distinct"]["p"] == 3 and store._rarest(Pattern(s=node("s5"), p=node("p1"), g=node("g0")), store._entry()) == "s"
    assert store._rarest(Pattern(p=node("p1"), g=node("g0")), store._entry()) in ("g", "p")
    left = q.where("s not in ('s0', 's1', 's2')").cache()
    layouts = {"quads-g"}
    assert layouts <= {p.name for p in (tmp_path / "data").rglob("quads-*")}
    assert n(store.match(Pattern(g=node("g3")))) == n(left.where("g = 'g3'"))
    spoil(tmp_path / "data")
    assert store.count() == n(left) and store.count(Pattern(p=node("p1"))) == n(left.where("p = 'p1'"))
    assert store.count(Pattern(g=node("g2"))) == n(left.where("g = 'g2'")) and store.count(Pattern(g=Term("", "DefaultGraph"))) == 1
    assert store.count(Pattern(p=node("p1"), g=node("g1"))) == n(left.where("p = 'p1' and g = 'g1'")) and store.count(Pattern(p=node("none"))) == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_histories_equal_a_plain_model(spark, tmp_path, seed):
    rng = random.Random(seed)
    store = Store(spark, f"file://{tmp_path}", bucket_rows=4, large_rows=20, fanout=2)
    pool = many(spark, 60).cache()
    rows = {r.quad_id: r for r in pool.collect()}
    state, indexed, states = set(), set(), {0: set()}
    for _ in range(9):
        kind = rng.choice(("commit", "commit", "commit", "disabled", "graph", "predicate", "reindex", "maintain", "compact", "late"))
        adds, dels = (set(rng.sample(sorted(rows), rng.choice((0, 3, 25)))) for _ in range(2))
        pick = lambda ids: pool.where(F.col("quad_id").isin(*ids)) if ids else pool.limit(0)
        if kind in ("commit", "disabled", "late"):
            writer = store
            if kind == "late":
                before = store._entry()
                other = set(rows) - adds - dels
                other = set(rng.sample(sorted(other), 3))
                store.commit(logged(pick(other), "add"))
                indexed |= other - state
                state |= other
                states[store.version()] = set(state)
                writer = behind(Store(spark, store.path, 4, 20, 2), before)
            writer.commit(logged(pick(adds), "add").union(logged(pick(dels), "delete")), "disabled" if kind == "disabled" else "incremental")
            fresh = adds - state  # what is deleted and added at the same place stays
            state = (state - dels) | adds
            indexed = (indexed & state) | (set() if kind == "disabled" else fresh)
        elif kind in ("graph", "predicate"):
            slot = "g" if kind == "graph" else "p"
            store.delete_graph("g1") if kind == "graph" else store.remove_matches(Pattern(p=node("p2")))
            state -= {i for i in state if rows[i][slot] in ("g1", "p2")}
            indexed &= state
        elif kind == "reindex":
            store.reindex(QuadFilter(graphs=("g0", "g2")))
            indexed |= {i for i in state if rows[i].g in ("g0", "g2")}
        else:
            getattr(store, kind)()
        states[store.version()] = set(state)
        assert {r.quad_id for r in store.quads().collect()} == state, kind
        assert {r.quad_id for r in store.chunks().collect()} == {r.quad_id for r in store.postings().collect()} == indexed, kind
        assert store.size() == store.count() == len(state) and store.corpus()[0] == len(indexed), kind
        assert {r.quad_id for r in store.stored(pool).collect()} == state, kind
    a, b = sorted(rng.sample(sorted(states), 2))
    got = {(r.op, r.quad_id) for r in store.changes(a, b).collect()}
    assert got == {("add", i) for i in states[b] - states[a]} | {("delete", i) for i in states[a] - states[b]}


def test_search_reads_the_ranges_that_can_hold_a_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshot, "RANGE_CHUNKS", 4)
    monkeypatch.setattr(search, "AHEAD", 1)
    rng = random.Random(7)
    texts = [" ".join(rng.choices(["hand", "eye", "door", "sea", f"w{i}"], [9, 5, 2, 1, 3], k=rng.choice([2, 3, 5, 9, 40, 90]))) for i in range(600)]
    rows = lambda part: make(spark, *[(f"s{i}", "text", literal(t), "g") for i, t in part])
    store = Store(spark, f"file://{tmp_path}")
    store.commit(logged(rows(list(enumerate(texts))[:400]), "add"), whole=True)
    store.commit(logged(rows(list(enumerate(texts))[400:]), "add"), whole=True)
    asked = spark.createDataFrame(list(enumerate(["hand", "hand eye", "sea door hand", "w5", "nowhere", "", "eye eye", "hand w7"])), "query_id long, query string")
    read = []
    plain = Store.postings_in
    monkeypatch.setattr(Store, "postings_in", lambda self, *a: read.append((found := plain(self, *a)).count()) or found)
    got = lambda k: sorted(map(str, search.search_stored(store, asked, top_k=k).collect()))
    want = lambda k: sorted(map(str, search.search_batch(store.chunks(), asked, top_k=k).collect()))
    assert got(20) == want(20)
    for query, share in (("hand eye", 2), ("sea", 10)):
        read.clear()
        assert len(search.search_stored(store, search.one_query(spark, query), top_k=3).collect()) == 3
        assert 0 < sum(read) < store.postings(query.split()).count() / share
    store.commit(logged(rows([(i, t) for i, t in enumerate(texts) if i % 3 == 0]), "delete"))
    assert store.bounds(["hand"]) is None
    store.compact()
    assert store.bounds(["hand"]) is not None and got(3) == want(3)


def test_layouts_deal_one_graph_over_several_files(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = Store(spark, f"file://{tmp_path}")
        store.publish(make(spark, *[(f"s{i}", "p", literal("same"), "g") for i in range(400)]))
        for slot in snapshot.LAYOUTS:
            rows = spark.read.parquet(f"{store._entry()['runs'][0]['folder']}/quads-{slot}")
            assert rows.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < 200, slot
        monkeypatch.setattr(snapshot, "TASK_ROWS", 20)
        monkeypatch.setattr(snapshot, "BROADCAST_REMOVED", 0)
        store.publish(store.quads())
        rows = spark.read.parquet(f"{store._entry()['runs'][0]['folder']}/quads-g")
        assert rows.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < 60
        store.commit(logged(store.quads().where("s < 's3'"), "delete"))
        assert store.quads().rdd.getNumPartitions() == 20 and n(store.quads()) == store.size() < 400
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_objects_are_kept_once_and_found_by_every_slot(spark, tmp_path):
    texts = [f"{'long text ' * 400}{i}" for i in range(30)]
    q = make(spark, *[(f"s{i}", "text", literal(t), f"g{i % 3}") for i, t in enumerate(texts)], *[(f"s{i}", "short", literal(f"x{i % 4}"), "g0") for i in range(30)])
    store = Store(spark, f"file://{tmp_path}")
    store.commit(logged(q, "add"), whole=True)
    store.commit(logged(q.where("s = 's4'"), "delete"), whole=True)
    state = q.where("s <> 's4'")
    for pattern in (Pattern(s=node("s7")), Pattern(s=node("s4")), Pattern(p=node("text")), Pattern(o=literal(texts[9])), Pattern(o=literal(texts[4])), Pattern(o=literal(texts[9] + "0")), Pattern(o=literal(texts[9][:256])), Pattern(o=literal("x1")), Pattern(g=node("g0")), Pattern(node("s3"), node("text"))):
        want = sorted(map(str, state.where(pattern.column()).collect()))
        assert sorted(map(str, store.match(pattern).collect())) == want, pattern
    folder = store._entry()["runs"][0]["folder"]
    longest = lambda kind, c: spark.read.parquet(f"{folder}/{kind}").agg(F.coalesce(F.max(F.length(c)), F.lit(0))).first()[0]
    assert longest("quads", "o") > 4000 and longest("chunks", "fts_value") == 0
    assert all(longest(f"quads-{slot}", "o") == 256 for slot in snapshot.LAYOUTS)
    assert {r.fts_value for r in store.chunks().collect()} == {t for i, t in enumerate(texts) if i != 4} | {"x0", "x1", "x2", "x3"}
    assert store.postings(["long"]).agg(F.sum("tf")).first()[0] == 29 * 400


def written(folder):
    """Bytes of the data files below a folder."""
    return sum(p.stat().st_size for p in folder.rglob("part-*.parquet"))


def test_layouts_leave_out_ids_that_follow_from_the_row(spark, tmp_path):
    q = many(spark, 5000).union(make(spark, ("long", "p", literal("x" * 300), "g0")))
    odd = make(spark, ("odd", "p", "o")).withColumn("quad_id", F.lit("f" * 64))
    store = Store(spark, f"file://{tmp_path}")
    store.publish(q.union(odd))
    folder = store._entry()["runs"][0]["folder"]
    for slot in snapshot.LAYOUTS:
        rows = spark.read.parquet(f"{folder}/quads-{slot}")
        assert {r.s for r in rows.where("quad_id is not null").collect()} == {"long", "odd"} and n(rows) == 5002
    by_id, layouts = written(tmp_path / "data" / folder.rsplit("/", 1)[-1] / "quads"), [written(p) for p in (tmp_path / "data").rglob("quads-*")]
    assert len(layouts) == 4 and max(layouts) < by_id / 2  # as large as the quads by id before
    for pattern in (Pattern(s=node("s7")), Pattern(s=node("odd")), Pattern(s=node("long")), Pattern(o=literal("x" * 300)), Pattern(g=node("g1"))):
        want = sorted(map(str, q.union(odd).where(pattern.column()).collect()))
        assert sorted(map(str, store.match(pattern).collect())) == want, pattern
    store.commit(logged(odd.union(q.where("s in ('s7', 'long')")), "delete"))
    assert n(store.match(Pattern(s=node("odd")))) == n(store.match(Pattern(s=node("s7")))) == n(store.match(Pattern(s=node("long")))) == 0
    assert store.size() == n(store.quads()) == 4999


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_a_merge_of_a_few_changes_leaves_the_others_in_their_order(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(snapshot, "BROADCAST_REMOVED", broadcast)
    store = Store(spark, f"file://{tmp_path}", bucket_rows=200, large_rows=100, fanout=2)
    q = many(spark, 2000).union(make(spark, ("long", "p0", literal("y" * 300), "g0"))).cache()
    store.publish(q)
    shuffled, plain = [], Store._ranged
    monkeypatch.setattr(Store, "_ranged", lambda self, rows, k, *order: (shuffled.append(rows.count()), plain(self, rows, k, *order))[1])
    state, size = q, 2001
    for i in range(2):
        new, old = many(spark, 40, 3000 + 40 * i), many(spark, 30, 30 * i)
        store.commit(logged(new, "add").union(logged(old, "delete")), "disabled")
        state, size = state.join(old, "quad_id", "left_anti").select(*q.columns).unionByName(new), size + 10
        shuffled.clear()
        store.compact()
        run = store._entry()["runs"]
        # By id and in four layouts; before, the whole store each time. The second time it is put in order anew.
        assert len(run) == 1 and len(shuffled) == 5 and (max(shuffled) < 500 if i < 1 else min(shuffled) == size), shuffled
        assert run[0].get("parts", 1) == 2 - i and run[0]["quads"] == size == store.size()
        want = {str(r) for r in state.collect()}
        assert {str(r) for r in store.quads().collect()} == want and n(store.quads()) == size
        for slot in snapshot.LAYOUTS:
            assert sorted(r.quad_id for r in store._read(run, slot).collect()) == sorted(r.quad_id for r in state.collect()), slot
        assert n(store.stored(q.unionByName(new))) == 2001 - 30 * (i + 1) + 40
        assert n(store.match(Pattern(s=node("s5")))) == 0 and n(store.match(Pattern(s=node("s3005")))) == n(store.match(Pattern(o=literal("y" * 300)))) == 1
    assert spark.conf.get("spark.sql.files.openCostInBytes") in ("4194304", "4194304b", "4MB")


def test_few_ids_are_looked_for_by_a_bitmap(spark):
    q = many(spark, 2000).cache()
    some = q.where("s < 's2'")
    asked = snapshot._marked(q, some.select("quad_id"), n(some)).cache()
    assert n(asked) == 2000 and n(asked.where("_hit").join(some, "quad_id", "left_semi")) == n(some)
    assert n(asked.where("_hit")) < n(some) + 200 and asked.drop("_hit").columns == q.columns


def test_queries_of_many_terms_leave_the_index_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "MOST_INLINE", 3)
    store = Store(spark, f"file://{tmp_path}")
    store.commit(logged(many(spark, 300), "add"), whole=True)
    store.commit(logged(many(spark, 40), "delete"), whole=True)
    asked = spark.createDataFrame(list(enumerate(["word7 number", "number 299", "word3 word4", "number 5"])), "query_id long, query string")
    want = sorted(map(str, search.search_batch(store.chunks(), asked, top_k=3).collect()))
    for path in (tmp_path / "data").iterdir():
        spoil(path / "postings")
    assert len(want) == 4 and sorted(map(str, search.search_stored(store, asked, top_k=3).collect())) == want


def test_runs_that_would_be_due_again_are_merged_in_one_go(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}", fanout=2, smallest=100)
    merges = []
    for i in range(4):
        store.commit(logged(many(spark, 100, 100 * i), "add"), "disabled")
        merges.append(store.maintain())
    assert merges == [0, 1, 0, 1] and store.deltas() == 0  # the fourth commit led to two merges before
    assert n(store.quads()) == store.size() == 400
    # How much is left of runs with removals isn't known before they are merged.
    for rows, op in ((many(spark, 100, 400), "add"), (many(spark, 100), "delete")):
        store.commit(logged(rows, op), "disabled")
    assert [len(r) for r in (store._due(store._entry()), store._entry()["runs"])] == [2, 3]
    assert store.maintain() >= 1 and n(store.quads()) == store.size() == 400 and n(store.stored(many(spark, 100))) == 0


def test_new_quads_are_shipped_once_by_id_and_for_slots_of_many_values(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshot, "TASK_ROWS", 20)
    shuffled, plain = [], Store._ranged
    monkeypatch.setattr(Store, "_ranged", lambda self, rows, k, *order: (shuffled.append(k), plain(self, rows, k, *order))[1])
    store = Store(spark, f"file://{tmp_path}", bucket_rows=100)
    q = make(spark, *[(f"s{i}", f"p{i % 3}", literal(f"o{i}"), "g") for i in range(200)]).union(make(spark, ("odd", "p0", "o")).withColumn("quad_id", F.lit("f" * 64))).cache()
    store.commit(logged(q, "add"), "disabled")
    assert shuffled == [201] * 3  # the log, by subject and by object; five times besides the log before
    run, want = store._entry()["runs"][0], sorted(map(str, q.collect()))
    sorted_files = lambda kind, *by: [[tuple(r[c] for c in by) for r in rows] for rows in by_file(spark, f"{run['folder']}/{kind}")]
    ids = sorted(sorted_files("quads", "quad_id"))
    assert len(ids) > 5 and sum(ids, []) == sorted(sum(ids, []))  # ranges, in order within
    for slot, order in (("p", "pso"), ("g", "gps")):
        files = sorted_files(f"quads-{slot}", *order)
        assert max(map(len, files)) < 60 and all(f == sorted(f) for f in files)
        assert sorted(str(r) for r in store._read([run], slot).select(*q.columns).collect()) == want
    for pattern in (Pattern(p=node("p0")), Pattern(s=node("odd"))):
        assert sorted(map(str, store.match(pattern).collect())) == sorted(map(str, q.where(pattern.column()).collect()))
    # What is stored already is neither added nor put out of order.
    store.commit(logged(q.union(many(spark, 20)), "add"), "disabled")
    assert store.size() == n(store.quads()) == 221 and store._entry()["runs"][1]["quads"] == 20
    assert spark.conf.get("spark.sql.files.openCostInBytes") in ("4194304", "4194304b", "4MB")


def by_file(spark, path):
    """Rows of each file of a folder, as they lie."""
    return [spark.read.parquet(f).collect() for f in spark.read.parquet(path).inputFiles()]


def test_changes_of_one_version_are_read_as_they_were_written(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store.commit(logged(many(spark, 30), "add"), "disabled")
    store.commit(logged(many(spark, 5, 28), "add").union(logged(many(spark, 4), "delete")), "disabled")
    store.compact()
    one, all_ = store.changes(1, store.version()), store.changes(0, store.version())
    plan = lambda rows: rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(one) and "Exchange" in plan(all_)  # both had one before
    assert {(r.op, r.s) for r in one.collect()} == {("add", f"s{i}") for i in range(30, 33)} | {("delete", f"s{i}") for i in range(4)} and n(one) == 7
    assert {(r.op, r.s) for r in all_.collect()} == {("add", f"s{i}") for i in range(4, 33)} and n(all_) == 29


def test_ids_are_broadcast_by_their_number_and_not_by_what_their_files_take(spark, tmp_path, monkeypatch):
    """Files that leave ids out are tiny, so Spark alone would send any number of ids through the driver."""
    monkeypatch.setattr(snapshot, "BROADCAST_REMOVED", 100)
    monkeypatch.setattr(snapshot, "BROADCAST_BITS", 10)
    plans, save = [], snapshot._save
    monkeypatch.setattr(snapshot, "_save", lambda rows, path, *by: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), save(rows, path, *by))[1])
    store = Store(spark, f"file://{tmp_path}", bucket_rows=100, large_rows=500)
    store.commit(logged(many(spark, 1000), "add"), "disabled")
    store.commit(logged(many(spark, 300), "delete").union(logged(many(spark, 300, 2000), "add")), "disabled")
    assert not [p for p in plans if "Broadcast" in p] and [p for p in plans if "SortMergeJoin" in p]
    assert sorted(r.s for r in store.quads().collect()) == sorted(f"s{i}" for i in [*range(300, 1000), *range(2000, 2300)])
    plans.clear()
    store.commit(logged(many(spark, 3, 500), "delete"), "disabled")
    assert store.size() == 997 and [p for p in plans if "BroadcastHashJoin" in p]


def test_postings_number_chunks_and_bounds_need_no_shuffle(spark, tmp_path, monkeypatch):
    plans, save = {}, snapshot._save
    monkeypatch.setattr(snapshot, "_save", lambda rows, path, *by: (plans.update({path.rsplit("/", 1)[-1]: rows._jdf.queryExecution().executedPlan().toString()}), save(rows, path, *by))[1])
    store = Store(spark, f"file://{tmp_path}")
    q = many(spark, 600).union(make(spark, ("long", "p0", literal("word7 " * 40 + "number"))))
    store.commit(logged(q, "add"))
    assert "Exchange" in plans["postings"] and "Exchange" not in plans["bounds"]
    run = store._entry()["runs"][0]
    kept = spark.read.parquet(f"{run['folder']}/postings")
    assert sorted(kept.columns) == ["block", "length", "no", "term", "tf"]
    want = sorted(map(str, search.postings(store.chunks()).select("term", "chunk_id", "quad_id", "length", "tf").collect()))
    assert sorted(map(str, store.postings().collect())) == want
    bounds = {(r.term, r.block): r for r in store.bounds(["word7", "number"]).collect()}
    rows = [r for r in kept.collect() if r.term in ("word7", "number")]
    assert {(r.term, r.block) for r in rows} == set(bounds)
    for key, found in bounds.items():
        own = [r for r in rows if (r.term, r.block) == key]
        assert (found.n, found.most, found.least) == (len(own), max(r.tf for r in own), min(r.length for r in own))


def test_shuffle_files_of_a_job_go_with_it(spark, tmp_path):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffled = lambda: sum(f.getName().startswith("shuffle_") for f in (files.apply(i) for i in range(files.size())))
    files = disk.getAllFiles()
    before, setting = shuffled(), spark.conf.get(snapshot._CLEANUP, None)
    snapshot._save(spark.range(100_000).repartition(8, "id"), f"file://{tmp_path}/rows")
    for _ in range(50):
        files = disk.getAllFiles()
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and spark.conf.get(snapshot._CLEANUP, None) == setting
