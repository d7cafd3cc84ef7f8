import random

import pytest
from pyspark.sql import functions as F

from quadspark.functions import terms
from quadspark.functions import text as texts
from quadspark.functions.terms import LITERAL, NAMED, Term, blank, literal, node, normalise, rejects
from quadspark.operators import chunks, match, patch, search
from quadspark.operators.bgp import Var, bgp
from quadspark.operators.match import Pattern, QuadFilter
from quadspark.sources import nquads
from quadspark.sources.log import Taken
from quadspark.sources.snapshot import Conflict, Store
from quadspark.streaming import ingest

RAW = "s string, s_type string, p string, o string, o_type string, o_datatype string, o_lang string, g string, g_type string"


def make(spark, *rows):
    """Quads from (s, p, o, g) with terms or strings; strings are nodes, a missing graph is the default one."""
    out = []
    for s, p, o, *g in rows:
        s, o = (Term(x) if isinstance(x, str) else x for x in (s, o))
        graph = Term(g[0]) if g else Term("", "DefaultGraph")
        out.append((s.value, s.type, p, o.value, o.type, o.datatype, o.lang, graph.value, graph.type))
    return normalise(spark.createDataFrame(out, RAW))


def n(df):
    return df.count()


def test_match_by_slot_and_type(spark):
    q = make(spark, ("a", "p1", literal("x")), ("a", "p2", literal("hola", "es")), (blank("a"), "p1", "b", "g1"), ("c", "p1", literal("x", datatype="d")))
    assert n(match.match(q)) == 4
    assert n(match.match(q, Pattern(s=node("a")))) == 2
    assert n(match.match(q, Pattern(s=blank("a")))) == 1
    assert n(match.match(q, Pattern(p=node("p1")))) == 3
    assert n(match.match(q, Pattern(o=literal("x")))) == 1
    assert n(match.match(q, Pattern(o=literal("x", datatype="d")))) == 1
    assert n(match.match(q, Pattern(o=literal("hola", "es")))) == 1
    assert n(match.match(q, Pattern(o=literal("hola", "ES")))) == 0
    assert n(match.match(q, Pattern(g=node("g1")))) == 1
    assert n(match.match(q, Pattern(g=Term("", "DefaultGraph")))) == 3
    assert match.count(q, Pattern(s=node("a"))).first().n == 2


def test_pages_cross(spark):
    q = make(spark, *[(f"s{i}", "p", literal(f"o{i}")) for i in range(25)])
    seen, after = [], None
    while rows := match.page(q, after, 10).collect():
        seen += [r.quad_id for r in rows]
        after = seen[-1]
    assert len(seen) == len(set(seen)) == 25
    assert n(match.page(q, None, 0)) == 1


def test_patch_is_idempotent_and_keeps_deleted_and_inserted(spark):
    a, b = make(spark, ("a", "p", "1"), ("b", "p", "2")), make(spark, ("a", "p", "1"), ("c", "p", "3"))
    state, novel = patch.commit_patch(a, b.union(b), a)
    assert n(state) == 2 and n(novel) == 2
    again, more = patch.commit_patch(state, b, a.limit(0))
    assert n(again) == 2 and n(more) == 0
    assert n(patch.commit_patch(a, b, a, QuadFilter(subjects=("c",)))[0]) == 3
    assert n(patch.replace(b)) == 2 and n(patch.wipe(a)) == 0
    assert n(patch.remove(a, b)) == 1


def test_transaction_equals_the_state_machine(spark):
    rng, rows, want = random.Random(3), [], {}
    for k in range(60):
        ops = [rng.choice(["add", "delete"]) for _ in range(rng.randint(1, 6))]
        adds, dels = False, False
        for i, op in enumerate(ops):
            rows.append((f"q{k}", k * 10 + i, op))
            if op == "add":
                adds, dels = True, False
            elif adds:
                adds = False
            else:
                dels = True
        want[f"q{k}"] = "add" if adds else "delete" if dels else None
    got = {r.quad_id: r.op for r in patch.net_effect(spark.createDataFrame(rows, "quad_id string, seq long, op string")).collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_remove_matches_is_null_safe(spark):
    q = make(spark, ("a", "p", "x"), ("a", "p", literal("y")))
    kept, gone = match.remove_matches(q, Pattern(o=literal("y")))
    assert (n(kept), n(gone)) == (1, 1)
    assert n(match.delete_graph(q, "g")[1]) == 0


def test_nquads_round_trip_and_rejects(spark):
    long = 'say "hi"\n\\ tab\t' * 400
    q = make(spark, ("urn:a", "urn:p", literal('say "hi"\n\\x', "en")), (blank("b1"), "urn:p", literal(""), "urn:g"), ("urn:a", "urn:q", literal(long)), ("urn:a", "urn:p", literal("1", datatype="urn:int")))
    lines = nquads.render(q).withColumnRenamed("line", "value")
    extra = spark.createDataFrame([("# note",), ("",), ("<a> <b> .",), ('<urn:u> <urn:p> "caf\\u00e9" . # end',)], "value string")
    back, bad = nquads.parse(lines.union(extra))
    ids = {r.quad_id for r in q.collect()}
    got = {r.quad_id: r.o for r in back.collect()}
    assert ids < set(got) and "café" in got.values() and len(got) == 5
    assert [r.value for r in bad.collect()] == ["<a> <b> ."]


def test_bgp_joins_on_the_whole_term(spark):
    q = make(spark, ("ethan", "name", literal("Ethan")), ("ethan", "knows", "gregory"), ("gregory", "name", literal("Gregory")), ("x", "knows", literal("gregory")))
    rows = bgp(q, [(Var("a"), node("knows"), Var("b"), None), (Var("b"), node("name"), Var("n"), None)]).collect()
    assert [(r.a, r.n) for r in rows] == [("ethan", "Gregory")]
    with pytest.raises(ValueError):
        bgp(q, [(Var("a"), node("knows"), None, None), (Var("c"), node("name"), None, None)])


def test_query_cleaning(spark):
    df = spark.createDataFrame([("the quick brown fox",), ("!!!",), ("Memory SDK",), ("the of",), ("e-mail",), (None,)], "q string")
    assert [r.c for r in df.select(texts.clean_query(df.q).alias("c")).collect()] == ['"quick" "brown" "fox"', "", '"memory" "sdk"', '"the" "of"', '"email"', ""]


def test_chunks_fit_and_cover():
    for size in (0, 10, 1000, 1001, 5000, 20_000):
        text = "".join(random.Random(size).choice("ab \n") for _ in range(size))
        out = texts.split_text(text)
        assert all(0 < len(c) <= 1000 for c in out)
        assert set(text.split()) <= set(" ".join(out).split()) or max(map(len, text.split()), default=0) > 800
    assert all(len(c) <= 1000 for c in texts.split_text("x" * 3500)) and sum(map(len, texts.split_text("x" * 3500))) >= 3500


def test_search_follows_filters_and_deletions(spark):
    q = make(spark, ("s1", "p", literal("Gregory works here"), "A"), ("s2", "p", literal("Gregory works there"), "B"), ("s3", "p", "Gregory"))
    c = chunks.project(q)
    assert n(c) == 2
    assert n(search.search(c, "gregory")) == 2
    assert n(search.search(c, "Gregory", QuadFilter(graphs=("A",)))) == 1
    assert n(search.search(c, "Gregory", QuadFilter(not_graphs=("B",)))) == 1
    assert n(search.search(c, "Gregory", QuadFilter(graphs=("A",)), top_k=1, prefilter=True)) == 1
    assert n(search.search(c, "!!!")) == 0 and n(search.search(c, " ")) == 0
    assert n(search.search(c, "Gregory", min_score=0.02)) == 0
    assert n(search.search(c, "Gregory", live=match.delete_graph(q, "A")[0])) == 1
    top = search.search(c, "works there").collect()
    assert [(r.graph, r.rank) for r in top] == [("B", 1)] and abs(top[0].score - 1 / 61) < 1e-12


def test_reindex_and_policies(spark):
    q = make(spark, ("s1", "p", literal("one"), "A"), ("s2", "p", literal("two"), "B"))
    none = chunks.project(q).limit(0)
    assert n(chunks.follow_commit(none, q, q, "disabled")) == 0
    assert n(chunks.follow_commit(none, q, q, "deferred", importing=True)) == 2
    assert n(chunks.reindex(q, none, QuadFilter(graphs=("A",)))) == 1
    assert chunks.report(q, QuadFilter(graphs=("A",))).first().asDict() == {"processed_quads": 2, "chunk_rows": 1}
    for bad in (0, 1537, float("nan")):
        with pytest.raises(ValueError):
            chunks.check_dimensions(bad)
    assert [chunks.check_dimensions(x) for x in (1, 1536)] == [1, 1536]


def test_pushdown(spark, tmp_path):
    make(spark, ("a", "p", literal("x"))).write.parquet(str(tmp_path / "q"))
    plan = match.match(spark.read.parquet(str(tmp_path / "q")), Pattern(p=node("p"), o=literal("x"))).select("s")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p," in plan and "g_type" not in plan


def test_statements_of_any_length_are_read_alike(spark):
    rows = [f'<a> <p> "x\u2028y\u0085{"q" * k}" . # "c" .' for k in (0, 3000)] + ['<a> <p> "' + '\\n' * 30_000 + '"@en <g> .', '<a> <p> "" .', '<a> <p> "$1 \\\\" .', '<a> <p> "bad\\" .', '<a> <p> "x" y .']
    good, bad = nquads.parse(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert sorted(len(r.o) for r in good.collect()) == [0, 4, 4, 3004, 30_000] and n(bad) == 2


def test_labels_of_the_grammar_and_odd_iris_come_back(spark):
    rows = ["_:é <urn:p> \"x\" .", "_:b1:c <urn:p> _:0.a-b .", "<a> <p> _:\u203fx .", "<a> <p> _:x. .", "_:-x <p> <o> .", "<a> <p> \"1\"^^<urn:\\u0041> _:g\u00b7 ."]
    good, bad = nquads.parse(spark.createDataFrame([(r,) for r in rows], "value string"), scope="")
    assert sorted((r.s, r.o, r.o_datatype, r.g) for r in good.collect()) == sorted([("é", "x", terms.XSD_STRING, ""), ("b1:c", "0.a-b", None, ""), ("a", "1", "urn:A", "g\u00b7")])
    assert sorted(r.value for r in bad.collect()) == sorted([rows[2], rows[3], rows[4]])
    odd = make(spark, ("urn:a>b", "urn:p q", "urn:{x}|\\^`"), ("urn:line\nfeed", "urn:p", literal("v", datatype="urn:d>\t")), (blank("b.1"), 'urn:"q"', blank("ü"), "urn:g<é>"))
    lines = nquads.render(odd).withColumnRenamed("line", "value")
    back, rest = nquads.parse(lines)
    assert n(rest) == 0 and sorted(map(str, back.collect())) == sorted(map(str, odd.collect()))
    assert all("\n" not in r.value for r in lines.collect())


def test_corrupt_rows_are_left_out(spark):
    rows = [("a", NAMED, "p", "x", LITERAL, None, None, "", "DefaultGraph"), (None, NAMED, "p", "x", LITERAL, None, None, "", "DefaultGraph"), ("a", "Odd", "p", "x", LITERAL, None, None, "", "DefaultGraph"), ("a", LITERAL, "p", "x", NAMED, None, None, "", "DefaultGraph"), ("a", NAMED, None, "x", LITERAL, None, None, "", "DefaultGraph")]
    raw = spark.createDataFrame(rows, RAW)
    assert n(normalise(raw)) == 1 and n(rejects(raw)) == 4
    stored = raw.withColumn("quad_id", F.sha2(F.to_json(F.struct("*")), 256))
    assert n(chunks.reindex(stored)) == 1 and chunks.report(stored).first().asDict() == {"processed_quads": 1, "chunk_rows": 1}


def test_vectors_of_another_length(spark):
    c = chunks.project(make(spark, ("a", "p", literal("x")), ("b", "p", literal("y")), ("c", "p", literal("z"))))
    c = c.withColumn("vector", F.when(F.col("value") == "x", F.array(F.lit(1.0), F.lit(2.0))).when(F.col("value") == "y", F.array(F.lit(1.0))).cast("array<float>"))
    assert [r.value for r in chunks.wrong_vectors(c, 2).collect()] == ["y"]


def test_own_splitter(spark):
    q = make(spark, ("a", "p", literal("one|two|three")), ("b", "p", literal("")))
    got = chunks.project(q, splitter=lambda t: t.split("|")).orderBy("chunk_id").collect()
    assert [(r.pos, r.value) for r in got] == [(0, "one"), (1, "two"), (2, "three")]
    assert chunks.report(q, splitter=lambda t: t.split("|")).first().chunk_rows == 3


def test_search_folds_queries_and_cuts_them_at_any_white_space(spark):
    c = chunks.project(make(spark, ("s1", "p", literal("le café noir, mémoire SDK")), ("s2", "p", literal("ế ǖ cafe\u0301"))))
    for query, found in (("cafe", 2), ("CAFÉ", 2), ("mémoire\u00a0sdk", 1), ("noir\u3000cafe\u0301", 1), ("noir\u2003sdk\ufeff", 1), ("e u", 1)):
        assert n(search.search(c, query)) == found, query


def test_large_filter_lists_are_joined(spark, monkeypatch):
    q = make(spark, *[(f"s{i}", "p", literal(f"o{i}"), f"g{i % 3}") for i in range(30)])
    wanted = QuadFilter(subjects=tuple(f"s{i}" for i in range(20)), not_graphs=("g0", "g1"))
    want = sorted(r.quad_id for r in q.where(wanted.column()).collect())
    monkeypatch.setattr(match, "MOST_INLINE", 1)
    assert sorted(r.quad_id for r in wanted.apply(q).collect()) == want and len(want) == 6
    assert n(search.search(chunks.project(q), "o5", wanted)) == 1 and n(search.search(chunks.project(q), "o4", wanted)) == 0


def test_literals_join_by_their_default_datatype(spark):
    rows = [("a", NAMED, "p", "x", LITERAL, None, None, "", "DefaultGraph"), ("b", NAMED, "q", "x", LITERAL, terms.XSD_STRING, None, "", "DefaultGraph"), ("c", NAMED, "q", "x", LITERAL, None, "en", "", "DefaultGraph")]
    got = bgp(normalise(spark.createDataFrame(rows, RAW)), [(Var("s"), node("p"), Var("o"), None), (Var("t"), node("q"), Var("o"), None)]).collect()
    assert [(r.s, r.t) for r in got] == [("a", "b")]


def test_deletes_come_first_at_equal_places(spark):
    log = spark.createDataFrame([("q1", 1, "add"), ("q1", 1, "delete"), ("q2", 1, "delete"), ("q2", 2, "add"), ("q2", 2, "delete")], "quad_id string, seq long, op string")
    assert {r.quad_id: r.op for r in patch.net_effect(log).collect()} == {"q1": "add", "q2": "add"}


def logged(rows, op):
    return rows.withColumn("op", F.lit(op)).withColumn("seq", F.lit(0))


def test_store_keeps_what_commits_change(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    assert store.version() == store.size() == n(store.quads()) == n(store.chunks()) == 0
    a = make(spark, *[(f"s{i}", "p", literal(f"café number {i}")) for i in range(20)], ("s1", "knows", "s2"))
    b = make(spark, *[(f"s{i}", "p", literal(f"café number {i}")) for i in range(15, 25)])
    gone = make(spark, *[(f"s{i}", "p", literal(f"café number {i}")) for i in range(5)], ("never", "p", "there"))
    assert store.commit(logged(a, "add")) == 1 and (store.size(), store.deltas()) == (21, 0)
    assert store.commit(logged(b, "add").union(logged(gone, "delete"))) == 2 and (store.size(), store.deltas()) == (21, 1)
    assert store.commit(logged(b, "add").union(logged(gone, "delete"))) == 3 and store.size() == 21
    want = {r.quad_id for r in a.union(b).join(gone, "quad_id", "left_anti").collect()}
    stored = store.quads().collect()
    assert len(stored) == len(want) and {r.quad_id for r in stored} == want
    assert store.corpus() == (20, 3.0) and n(store.chunks()) == 20
    for query in ("cafe", "CAFÉ number", "number 17", "number 3", "7 number café", ""):
        asked = search.one_query(spark, query)
        one, two = (sorted(map(str, f.collect())) for f in (search.search_stored(store, asked), search.search_batch(store.chunks(), asked)))
        assert one == two and (len(one) > 0) == (query not in ("", "number 3")), query
    plan = store.postings(["cafe", "17"])._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [17,cafe])" in plan or "In(term, [cafe,17])" in plan
    again = make(spark, ("s1", "p", literal("café number 1")))
    store.commit(logged(again, "add"))
    assert store.size() == 22 and n(store.quads()) == 22 and n(store.match(Pattern(o=literal("café number 1")))) == 1
    assert n(store.match(Pattern(s=node("s1")))) == 2 and n(store.match(Pattern(p=node("knows")))) == 1
    store.compact()
    assert (store.size(), store.deltas(), n(store.quads()), store.corpus()) == (22, 0, 22, (21, 3.0))
    assert store.vacuum() == 4 and n(store.quads()) == 22 and store.version() == 5


def behind(store, entry):
    """The store as a writer sees it that read this entry before others published; later reads see theirs."""
    seen, newest = [entry], store._entry
    store._entry = lambda: seen.pop() if seen else newest()
    return store


def test_of_two_writers_one_is_told(spark, tmp_path):
    path = f"file://{tmp_path}"
    store, q = Store(spark, path), make(spark, ("a", "p", literal("x")), ("b", "p", literal("y")))
    before = store._entry()
    store.publish(q)
    with pytest.raises(Conflict):
        behind(Store(spark, path), before).publish(q.limit(0))
    assert store.size() == 2 and n(store.quads()) == 2
    with pytest.raises(Taken):
        store.log.put(1, {})


def test_writers_of_other_quads_go_on_top(spark, tmp_path):
    path = f"file://{tmp_path}"
    store = Store(spark, path)
    store.commit(logged(make(spark, ("a", "p", literal("one")), ("b", "p", literal("two"))), "add"))
    before = store._entry()
    store.commit(logged(make(spark, ("c", "p", literal("three"))), "add").union(logged(make(spark, ("a", "p", literal("one"))), "delete")))
    store.compact()
    late = behind(Store(spark, path), before)
    assert late.commit(logged(make(spark, ("d", "p", literal("four"))), "add").union(logged(make(spark, ("b", "p", literal("two"))), "delete"))) == 4
    assert sorted(r.o for r in store.quads().collect()) == sorted(r.value for r in store.chunks().collect()) == ["four", "three"]
    assert store.size() == 2 and store.corpus() == (2, 1.0) and store.count(Pattern(p=node("p"))) == 2
    with pytest.raises(Conflict):
        behind(Store(spark, path), before).commit(logged(make(spark, ("a", "p", literal("one"))), "add"))
    merging = store._entry()
    store.commit(logged(make(spark, ("e", "p", literal("five"))), "add"))
    assert Store(spark, path)._merge(merging, merging["runs"]) == 6 and n(store.quads()) == store.size() == 3
    with pytest.raises(Conflict):
        behind(Store(spark, path), before).reindex()


def test_counts_of_chunks_without_a_term_and_entries_of_dead_writers(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    bare, rest = make(spark, ("a", "p", literal("..."))), make(spark, ("b", "p", literal("one two")), ("c", "p", literal("!")))
    store.commit(logged(bare.union(rest), "add"))
    assert store.corpus() == (3, 2 / 3)
    store.commit(logged(bare, "delete"))
    assert store.corpus() == (2, 1.0) and n(store.chunks()) == 2
    (tmp_path / "log" / f"{3:012d}.json").touch()
    (tmp_path / "log" / f"{4:012d}.json").write_text('{"runs": [')
    assert store.version() == 2 and n(store.quads()) == store.size() == 2
    assert store.commit(logged(bare, "add")) == 5 and store.size() == 3
    assert not [f for f in (tmp_path / "log").iterdir() if "beside" in f.name]
    assert store.vacuum() == 4 and n(store.quads()) == 3


def test_a_failing_projection_publishes_nothing(spark, tmp_path):
    def broken(text):
        raise RuntimeError("no")

    store, q = Store(spark, f"file://{tmp_path}"), make(spark, ("a", "p", literal("x")))
    store.commit(logged(q, "add"))
    with pytest.raises(Exception, match="no"):
        store.commit(logged(make(spark, ("b", "p", literal("y"))), "add"), splitter=broken)
    assert store.version() == 1 and n(store.quads()) == n(store.chunks()) == 1
    store.commit(logged(make(spark, ("b", "p", literal("y"))), "add"))
    assert (store.size(), n(store.chunks())) == (2, 2)


def test_streams_are_applied_in_batches_and_flushed(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", fanout=2)
    schema = "quad_id string, s string, s_type string, p string, o string, o_type string, o_datatype string, o_lang string, g string, g_type string, op string"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    put = lambda k, rows, op: rows.withColumn("op", F.lit(op)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    put(0, make(spark, ("a", "p", literal("one")), ("b", "p", literal("two"))), "add")
    query = ingest.ingest(stream, store, f"{tmp_path}/progress", keep_seconds=0.0, processingTime="1 second")
    try:
        ingest.flush(query)
        assert store.size() == 2 and n(store.chunks()) == 2
        put(1, make(spark, ("a", "p", literal("one"))), "delete")
        ingest.flush(query)
        assert store.size() == 1 and [r.value for r in store.chunks().collect()] == ["two"]
        put(2, make(spark, ("c", "p", literal("three"))), "add")
        ingest.flush(query)
        store.settle()
        assert store.size() == 2 and store.deltas() == 0 and len(store.log.numbers()) < 4 and n(search.search_stored(store, search.one_query(spark, "three"))) == 1
    finally:
        query.stop()


def test_without_training_data_operators():
    import __spark_entry__

    core, sql = __spark_entry__._core()
    assert {"scan_quads", "search_batch", "stream_import"} <= set(core) and set(sql) <= set(core)
    assert LITERAL and NAMED


def test_repeats_are_looked_for_without_shipping_ids(spark, tmp_path, monkeypatch):
    rows = [(f"s{i % 50}", NAMED, "p", f"o{i % 25}", LITERAL, terms.XSD_STRING, "" if i % 3 else None, "", "DefaultGraph") for i in range(200)]
    found = normalise(spark.createDataFrame(rows, RAW))
    assert n(found) == 50 == n(found.select("quad_id").distinct())
    plan = found._jdf.queryExecution().executedPlan().toString()
    shipped = plan[plan.index("Exchange") :]
    assert plan.count("Exchange") == 1 and "AS quad_id" not in shipped  # before, rows were shipped with their ids
    monkeypatch.setattr(nquads, "TASK_BYTES", 100)
    nquads.write(found, f"file://{tmp_path}/q")
    back = nquads.read(spark, f"file://{tmp_path}/q")[0]
    assert back.rdd.getNumPartitions() > 8 and sorted(map(str, back.collect())) == sorted(map(str, found.collect()))
