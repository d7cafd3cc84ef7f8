"""Queries over the test tables as quads, each with the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.functions.terms import COLUMNS, LITERAL, NAMED, XSD_DATE, XSD_STRING, blank, literal, node, normalise, quad_id, terms
from quadspark.functions.text import STOPWORDS, WHITE, clean_query
from quadspark.operators import chunks as chunking
from quadspark.operators import match as matching
from quadspark.operators import patch as patching
from quadspark.operators import search as searching
from quadspark.operators.bgp import Var, bgp
from quadspark.operators.match import Pattern, QuadFilter
from quadspark.sources import nquads
from quadspark.sources.folders import new_folder
from quadspark.sources.snapshot import Store
from quadspark.sources.tables import FACTS, _select, id_sql, quads, quads_sql, raw_quads
from quadspark.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_LIST = ", ".join(COLUMNS)


def _query(sql: str | None = None):
    """Register a query under its name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


def _with(body: str, *tables: str, where: str = "true") -> str:
    return f"with quads as ({quads_sql(*tables, where=where)}) {body}"


# Scans, export and import


@_query(_with(f"select {_LIST} from quads"))
def scan_quads(spark, d):
    return quads(spark, d)


@_query(_with("select quad_id, s as subject, s_type as subject_type, p as predicate, o as object, o_type as object_type, nullif(o_datatype, '') as datatype, nullif(o_lang, '') as lang, g as graph, g_type as graph_type from quads"))
def export_quads(spark, d):
    t = terms(quads(spark, d))
    return t.select("quad_id", F.col("subject.value").alias("subject"), F.col("subject.term_type").alias("subject_type"), F.col("predicate.value").alias("predicate"), F.col("object.value").alias("object"), F.col("object.term_type").alias("object_type"), F.col("object.datatype").alias("datatype"), F.col("object.lang").alias("lang"), F.col("graph.value").alias("graph"), F.col("graph.term_type").alias("graph_type"))


_ESCAPED = "replace(replace(replace(replace(o, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), '\"', chr(92) || '\"')"
_TERM = "case when {0}_type = 'BlankNode' then '_:' || {0} else '<' || {0} || '>' end"
_LINE = f"""{_TERM.format('s')} || ' <' || p || '> ' || case when o_type = 'Literal' then '"' || {_ESCAPED} || '"' ||
 case when coalesce(o_lang, '') <> '' then '@' || o_lang when coalesce(nullif(o_datatype, ''), '{XSD_STRING}') <> '{XSD_STRING}' then '^^<' || o_datatype || '>' else '' end
 else {_TERM.format('o')} end || case when g_type = 'DefaultGraph' then '' else ' ' || {_TERM.format('g')} end || ' .'"""


@_query(_with(f"select {_LINE} as line from quads"))
def nquads_lines(spark, d):
    return nquads.render(quads(spark, d))


@_query(_with(f"select {_LIST} from quads"))
def nquads_roundtrip(spark, d):
    path = new_folder(spark, "nquads")
    nquads.write(quads(spark, d), path)
    return nquads.read(spark, path)[0]


# Patterns


def _matched(pattern: Pattern, *tables: str):
    return lambda spark, d: matching.match(quads(spark, d, *tables), pattern)


_MATCHES = {
    "match_subject": (Pattern(s=node("urn:customer:7")), "s = 'urn:customer:7' and s_type = 'NamedNode'"),
    "match_predicate": (Pattern(p=node("urn:nation")), "p = 'urn:nation'"),
    "match_object_literal": (Pattern(o=literal("BUILDING")), f"o = 'BUILDING' and o_type = 'Literal' and (o_datatype is null or o_datatype in ('', '{XSD_STRING}'))"),
    "match_object_node": (Pattern(o=node("urn:nation:3")), "o = 'urn:nation:3' and o_type = 'NamedNode'"),
    "match_graph": (Pattern(g=node("urn:g:orders")), "g = 'urn:g:orders' and g_type = 'NamedNode'"),
    "match_default_graph": (Pattern(g=matching.Term("", "DefaultGraph")), "g = '' and g_type = 'DefaultGraph'"),
    "match_blank": (Pattern(s=blank("c1t0")), "s = 'c1t0' and s_type = 'BlankNode'"),
    "match_spog": (Pattern(node("urn:order:0"), node("urn:status"), literal("P"), node("urn:g:orders")), "s = 'urn:order:0' and p = 'urn:status' and o = 'P' and o_type = 'Literal' and g = 'urn:g:orders'"),
    "match_plain_string": (Pattern(p=node("urn:status"), o=literal("F")), "p = 'urn:status' and o = 'F' and o_type = 'Literal'"),
    "match_typed_date": (Pattern(o=literal("1995-03-15", datatype=XSD_DATE)), f"o = '1995-03-15' and o_datatype = '{XSD_DATE}'"),
}
for _name, (_pattern, _sql) in _MATCHES.items():
    QUERIES[_name], ORACLES[_name] = _matched(_pattern), _with(f"select {_LIST} from quads where {_sql}")


@_query(_with(f"select {_LIST} from quads where o_lang = 'fr' and o_type = 'Literal' and o = (select text from documents where lang = 'fr' order by doc_id limit 1)"))
def match_lang_literal(spark, d):
    text = spark.read.parquet(f"{d}/documents.parquet").where("lang = 'fr'").orderBy("doc_id").select("text").first()[0]
    return matching.match(quads(spark, d), Pattern(o=literal(text, "fr")))


@_query(_with(f"select {_LIST} from quads where quad_id > '8' order by quad_id limit 25"))
def page_after(spark, d):
    return matching.page(quads(spark, d), "8", 25.7)


@_query(_with("select count(*) as n from quads where p = 'urn:status' and o = 'O' and g = 'urn:g:orders'"))
def count_pattern(spark, d):
    return matching.count(quads(spark, d), Pattern(p=node("urn:status"), o=literal("O"), g=node("urn:g:orders")))


@_query(_with("select count(*) as n from quads"))
def size(spark, d):
    return matching.count(quads(spark, d))


# Patches


def _changes(spark, d):
    """Insertions give every pending order the status X, deletions take the old one away."""
    rows = spark.read.parquet(f"{d}/orders.parquet").where("o_orderstatus = 'P'")
    old = quads(spark, d, "orders", where=F.col("o_orderstatus") == "P").where("p = 'urn:status'")
    new = raw_quads(rows.withColumn("o_orderstatus", F.lit("X")), "orders").where("p = 'urn:status'")
    return normalise(new), old


_STATUS = FACTS["orders"][1]
_NEW = f"select {id_sql()} as quad_id, * from ({_select('orders', _STATUS, "(select * replace (chr(88) as o_orderstatus) from orders where o_orderstatus = 'P')")})"
_OLD = f"select {id_sql()} as quad_id, * from ({_select('orders', _STATUS, "(select * from orders where o_orderstatus = 'P')")})"
_PATCH = f"ins as ({_NEW}), del as ({_OLD})"


def _patched(body: str) -> str:
    return f"with quads as ({quads_sql('orders')}), {_PATCH} {body}"


@_query(_patched(f"select {_LIST} from quads union select {_LIST} from ins"))
def patch_merge(spark, d):
    new, old = _changes(spark, d)
    return patching.commit_patch(quads(spark, d, "orders"), new, old.limit(0))[0]


@_query(_patched(f"select {_LIST} from quads where quad_id not in (select quad_id from del) union select {_LIST} from ins"))
def patch_delete_insert(spark, d):
    new, old = _changes(spark, d)
    return patching.commit_patch(quads(spark, d, "orders"), new, old)[0]


@_query(_patched(f"select {_LIST} from ins where quad_id not in (select quad_id from quads)"))
def patch_novel(spark, d):
    new, old = _changes(spark, d)
    return patching.commit_patch(quads(spark, d, "orders"), new.unionByName(old), old.limit(0))[1]


@_query(_patched(f"select {_LIST} from quads where quad_id not in (select quad_id from del) union select {_LIST} from ins"))
def patch_filtered(spark, d):
    new, old = _changes(spark, d)
    more = quads(spark, d, "nation")
    return patching.commit_patch(quads(spark, d, "orders"), new.unionByName(more), old, QuadFilter(graphs=("urn:g:orders",), not_predicates=("urn:date",)))[0]


@_query(_patched(f"select {_LIST} from ins"))
def import_replace(spark, d):
    return patching.replace(_changes(spark, d)[0])


@_query(_patched(f"select {_LIST} from quads"))
def add_quad(spark, d):
    state = quads(spark, d, "orders")
    return patching.add(state, matching.match(state, Pattern(s=node("urn:order:1"))))


@_query(_with(f"select {_LIST} from quads where not (s = 'urn:order:1' and p = 'urn:status')", "orders"))
def remove_quad(spark, d):
    state = quads(spark, d, "orders")
    return patching.remove(state, matching.match(state, Pattern(node("urn:order:1"), node("urn:status"))))


@_query(_with(f"select {_LIST} from quads where false", "orders"))
def wipe(spark, d):
    return patching.wipe(quads(spark, d, "orders"))


@_query(_patched("select distinct quad_id from ins where quad_id in (select quad_id from quads) union select quad_id from del"))
def presence(spark, d):
    new, old = _changes(spark, d)
    return patching.present(new.unionByName(old), quads(spark, d, "orders"))


@_query(f"""with log as (
 select event_id as seq, case when event_id % 3 = 2 then 'delete' else 'add' end as op,
 sha256(concat_ws(chr(0), concat('urn:user:', cast(user_id as varchar)), '{NAMED}', 'urn:did', event_type, '{LITERAL}', '{XSD_STRING}', '', '', 'DefaultGraph')) as quad_id from events),
 last as (select *, lag(op) over w as before, lead(seq) over w is null as final from log window w as (partition by quad_id order by seq))
 select quad_id, op from last where final and (op = 'add' or coalesce(before, 'delete') = 'delete')""")
def tx_net_effect(spark, d):
    rows = spark.read.parquet(f"{d}/events.parquet")
    shaped = rows.selectExpr("event_id as seq", "case when event_id % 3 = 2 then 'delete' else 'add' end as op", "concat('urn:user:', cast(user_id as string)) as s", f"'{NAMED}' as s_type", "'urn:did' as p", "event_type as o", f"'{LITERAL}' as o_type", f"'{XSD_STRING}' as o_datatype", "cast(null as string) as o_lang", "'' as g", "'DefaultGraph' as g_type")
    return patching.net_effect(shaped.withColumn("quad_id", quad_id())).select("quad_id", "op")


@_query(_with(f"select {_LIST} from quads where not (p = 'urn:segment' and o = 'BUILDING')", "customer"))
def remove_matches(spark, d):
    return matching.remove_matches(quads(spark, d, "customer"), Pattern(p=node("urn:segment"), o=literal("BUILDING")))[0]


@_query(_with(f"select {_LIST} from quads where g = 'urn:g:orders'"))
def delete_graph(spark, d):
    return matching.delete_graph(quads(spark, d), "urn:g:orders")[1]


# Pattern joins


@_query(_with("select s as customer, o as nation from quads where p = 'urn:nation' and o_type = 'NamedNode'", "customer"))
def bgp_1(spark, d):
    return bgp(quads(spark, d, "customer"), [(Var("customer"), node("urn:nation"), Var("nation"), None)])


@_query(_with("select a.s as customer, b.o as name from quads a join quads b on a.s = b.s where a.p = 'urn:segment' and a.o = 'BUILDING' and b.p = 'urn:name'", "customer"))
def bgp_2(spark, d):
    return bgp(quads(spark, d, "customer"), [(Var("customer"), node("urn:segment"), literal("BUILDING"), None), (Var("customer"), node("urn:name"), Var("name"), None)])


@_query(_with("select a.s as customer, b.s as nation, c.o as name, b.o as region from quads a join quads b on a.o = b.s join quads c on c.s = b.s where a.p = 'urn:nation' and b.p = 'urn:region' and c.p = 'urn:name'", "customer", "nation"))
def bgp_3(spark, d):
    return bgp(quads(spark, d, "customer", "nation"), [(Var("customer"), node("urn:nation"), Var("nation"), None), (Var("nation"), node("urn:region"), Var("region"), None), (Var("nation"), node("urn:name"), Var("name"), None)])


@_query(_with("select a.s as customer, a.o as name, b.o as segment, c.o as nation, d.o as nation_name from quads a join quads b on a.s = b.s join quads c on a.s = c.s join quads d on d.s = c.o where a.p = 'urn:name' and b.p = 'urn:segment' and c.p = 'urn:nation' and d.p = 'urn:name'", "customer", "nation"))
def bgp_star(spark, d):
    """Three patterns on one subject, and a fourth on its nation, joined by the counts in a store's log."""
    store = Store(spark, new_folder(spark, "store"))
    store.publish(quads(spark, d, "customer", "nation"))
    own, nation = Var("customer"), Var("nation")
    return store.bgp([(own, node("urn:name"), Var("name"), None), (own, node("urn:segment"), Var("segment"), None), (own, node("urn:nation"), nation, None), (nation, node("urn:name"), Var("nation_name"), None)])


# Chunks and search. A literal is one chunk where SQL has to follow; chunks_long and search_chunked cut texts.

_WHOLE_CHUNKS = "select quad_id || '#000000' as chunk_id, quad_id, s as subject, p as predicate, g as graph, trim(o, ' ') as value from quads where o_type = 'Literal' and trim(o, ' ') <> ''"
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
_NO_WORD = r"[^\p{L}\p{N}\p{M}]+"


def _docs(spark, d):
    return quads(spark, d, "documents")


@_query(_with(_WHOLE_CHUNKS, "documents"))
def chunks_whole(spark, d):
    return chunking.project(_docs(spark, d), whole=True).select("chunk_id", "quad_id", "subject", "predicate", "graph", "value")


@_query()
def chunks_long(spark, d):
    return chunking.project(quads(spark, d, "documents")).select("chunk_id", "quad_id", "pos", "subject", "value")


@_query(_with(f"select (select count(*) from quads) as processed_quads, (select count(*) from ({_WHOLE_CHUNKS}) where graph in ('urn:src:src1', 'urn:src:src2')) as chunk_rows", "documents"))
def reindex_report(spark, d):
    return chunking.report(_docs(spark, d), QuadFilter(graphs=("urn:src:src1", "urn:src:src2")), whole=True)


@_query(f"with quads as ({quads_sql('documents')}), fresh as ({_WHOLE_CHUNKS}) select chunk_id, value from fresh where graph not in ('urn:src:src3') and quad_id not in (select quad_id from quads where g = 'urn:src:src4')")
def reindex_scoped(spark, d):
    """Chunks of deleted quads go, and those of an excluded graph were never made."""
    whole = _docs(spark, d)
    state = matching.delete_graph(whole, "urn:src:src4")[0]
    stale = chunking.project(whole.where("g <> 'urn:src:src3'"), whole=True)
    return chunking.reindex(state, stale, QuadFilter(not_graphs=("urn:src:src3",)), whole=True).select("chunk_id", "value")


@_query(f"with quads as (select * from ({quads_sql('documents')}) where g = 'urn:src:src5') {_WHOLE_CHUNKS}")
def insert_data_projects(spark, d):
    """A commit that is no import adds the chunks of what is new."""
    state = _docs(spark, d).where("g <> 'urn:src:src5'")
    after, novel = patching.commit_patch(state, _docs(spark, d), state.limit(0))
    chunks = chunking.follow_commit(chunking.project(state, whole=True).limit(0), after, novel, whole=True)
    return chunks.select("chunk_id", "quad_id", "subject", "predicate", "graph", "value")


_ASKED = ["the thing of", "hand", "est la", "THE, of!", "!!!", "  ", "Memory SDK", "e-mail thing", "thing hand the", "\u00c9l\u00e9\u00e9", "thing\u00a0hand", "cafe\u0301\u3000UNE"]


def _asked(spark, d) -> DataFrame:
    """The queries above, and every turn of the conversations whose id is divisible by 100."""
    own = spark.range(1).select(F.posexplode(F.array(*[F.lit(q) for q in _ASKED])).alias("query_id", "query")).select(F.col("query_id").cast("long").alias("query_id"), "query")
    turns = spark.read.parquet(f"{d}/conversations.parquet").where("conv_id % 100 = 0")
    return own.unionByName(turns.select((F.lit(1000) + F.col("conv_id") * 1000 + F.col("turn")).cast("long").alias("query_id"), F.col("text").alias("query")))


_ASKED_SQL = "(select unnest(range({})) as query_id, unnest([{}]) as query union all select 1000 + conv_id * 1000 + turn, text from conversations where conv_id % 100 = 0)".format(len(_ASKED), ", ".join("'" + q + "'" for q in _ASKED))
_TERMS_SQL = f"""cut as (select query_id, list_filter(list_transform(regexp_split_to_array(query, '{WHITE}'), lambda t: regexp_replace(lower(t), '{_NO_WORD}', '', 'g')), lambda t: t <> '') as all_terms from asked),
terms as (select query_id, case when len(list_filter(all_terms, lambda t: t not in ({_STOP}))) > 0 then list_filter(all_terms, lambda t: t not in ({_STOP})) else all_terms end as terms from cut)"""


@_query(f"with asked as (select doc_id as query_id, text as query from documents), {_TERMS_SQL} select query_id, coalesce(list_aggregate(list_transform(terms, lambda t: '\"' || t || '\"'), 'string_agg', ' '), '') as cleaned from terms")
def sanitize_queries(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select(F.col("doc_id").alias("query_id"), clean_query(F.col("text")).alias("cleaned"))


def _search_sql(tail: str, top: int = 100, extra: str = "") -> str:
    n, k1, b = "(select count(*) from tokens)", searching.K1, searching.B
    return f"""with quads as ({quads_sql('documents')}), every as ({_WHOLE_CHUNKS}), chunks as (select * from every {extra}),
asked as (select * from {_ASKED_SQL}), {_TERMS_SQL},
folded as (select query_id, list_distinct(list_filter(list_transform(terms, lambda t: strip_accents(t)), lambda t: t <> '')) as terms from terms),
wanted as (select query_id, unnest(terms) as term, len(terms) as n_terms from folded),
tokens as (select chunk_id, list_filter(regexp_split_to_array(strip_accents(lower(value)), '{_NO_WORD}'), lambda t: t <> '') as terms from chunks),
flat as (select chunk_id, len(terms) as length, unnest(terms) as term from tokens),
postings as (select term, chunk_id, length, count(*) as tf from flat where term in (select term from wanted) group by all),
freq as (select term, count(*) as df from postings group by term),
mean as (select avg(len(terms)) as mean from tokens),
part as (select p.term, chunk_id, greatest(ln(({n} - df + 0.5) / (df + 0.5)), {searching.LEAST_IDF}) * tf * ({k1} + 1) / (tf + {k1} * (1 - {b} + {b} * length / mean)) as part from postings p join freq using (term), mean),
hits as (select query_id, chunk_id, round(sum(part), 12) as bm25 from part join wanted using (term) group by query_id, chunk_id, n_terms having count(*) = n_terms),
ranked as (select *, row_number() over (partition by query_id order by bm25 desc, chunk_id) as rank from hits),
found as (select query_id, {id_sql(("subject", f"'{NAMED}'", "predicate", "value", f"'{LITERAL}'", f"'{XSD_STRING}'", "''", "graph", "case when graph = '' then 'DefaultGraph' else 'NamedNode' end"))} as id, subject, predicate, graph, value as text, (1.0 / (60 + rank))::double as score, rank from ranked join chunks using (chunk_id) where rank <= {top})
{tail}"""


_FOUND = "query_id, id, subject, predicate, graph, text, score, rank"


@_query()
def search_chunked(spark, d):
    return searching.search_batch(chunking.project(_docs(spark, d)), _asked(spark, d))


@_query(_search_sql(f"select {_FOUND} from found"))
def search_batch(spark, d):
    return searching.search_batch(chunking.project(_docs(spark, d), whole=True), _asked(spark, d))


@_query(_search_sql("select id, subject, predicate, graph, text, score, rank from found where query_id = 1", top=10))
def search_top(spark, d):
    return searching.search(chunking.project(_docs(spark, d), whole=True), "hand", top_k=10)


@_query(_search_sql(f"select {_FOUND} from found where graph in ('urn:src:src1', 'urn:src:src2', 'urn:src:src3') and graph not in ('urn:src:src2')"))
def search_filtered(spark, d):
    return searching.search_batch(chunking.project(_docs(spark, d), whole=True), _asked(spark, d), QuadFilter(graphs=("urn:src:src1", "urn:src:src2", "urn:src:src3"), not_graphs=("urn:src:src2",)))


@_query(_search_sql(f"select {_FOUND} from found where score >= 0.0125"))
def search_min_score(spark, d):
    return searching.search_batch(chunking.project(_docs(spark, d), whole=True), _asked(spark, d), min_score=0.0125)


@_query(_search_sql(f"select {_FOUND} from found", extra="where graph <> 'urn:src:src1'"))
def search_live(spark, d):
    """Deleted quads are not found, though their chunks are still there."""
    whole = _docs(spark, d)
    return searching.search_batch(chunking.project(whole, whole=True), _asked(spark, d), live=matching.delete_graph(whole, "urn:src:src1")[0])


@_query(_search_sql(f"select {_FOUND} from found"))
def search_stored(spark, d):
    """The same from postings that a store keeps, half of the corpus in a version of its own, some of it removed again."""
    docs, store = _docs(spark, d), Store(spark, new_folder(spark, "store"))
    later = F.col("g").isin("urn:src:src1", "urn:src:src2")
    gone = quads(spark, d, "nation")
    first = docs.where(~later).unionByName(gone)
    store.publish(first, chunking.project(first, whole=True))
    log = docs.where(later).withColumn("op", F.lit("add")).unionByName(gone.withColumn("op", F.lit("delete")))
    store.commit(log.withColumn("seq", F.lit(0)), whole=True)
    return searching.search_stored(store, _asked(spark, d))


@_query(_search_sql("select id, count(*) as n from found group by id"))
def search_result_ids(spark, d):
    return searching.search_batch(chunking.project(_docs(spark, d), whole=True), _asked(spark, d)).groupBy("id").agg(F.count("*").alias("n"))


# Streams


def _table_stream(spark, d, table):
    """A table's quads as a stream, whether it is one file or a folder of them; a stream takes a file by a pattern only."""
    rows = spark.readStream.schema(spark.read.parquet(f"{d}/{table}.parquet").schema).parquet(f"{d}/{table}[.]parquet")
    return raw_quads(rows, table).withColumn("quad_id", quad_id()).select(*COLUMNS)


def _event_stream(spark, d):
    return _table_stream(spark, d, "events")


def _distinct_events(extra: str = "") -> str:
    return f"select distinct {_LIST} from ({quads_sql('events')}) {extra}"


@_query(_distinct_events())
def stream_import(spark, d):
    store = Store(spark, new_folder(spark, "store"))
    ingest.add_all(_event_stream(spark, d), store, new_folder(spark, "progress"), policy="disabled").awaitTermination()
    return store.quads()


@_query(f"{_distinct_events()} where o <> 'click' union {quads_sql('nation')}")
def stream_remove(spark, d):
    store = Store(spark, new_folder(spark, "store"))
    store.publish(patching.replace(quads(spark, d, "events").unionByName(quads(spark, d, "nation"))))
    clicks = _event_stream(spark, d).where("o = 'click'")
    ingest.remove_all(clicks, store, new_folder(spark, "progress")).awaitTermination()
    return store.quads()


@_query(_with("select quad_id || '#000000' as chunk_id, trim(o, ' ') as value from (select distinct * from quads) where trim(o, ' ') <> ''", "documents"))
def stream_index(spark, d):
    """The index follows a stream of whole documents."""
    store = Store(spark, new_folder(spark, "store"))
    ingest.add_all(_table_stream(spark, d, "documents"), store, new_folder(spark, "progress"), whole=True).awaitTermination()
    return store.chunks().select("chunk_id", "value")


# Stores


def _changed(spark, d) -> Store:
    """Orders as published, then the pending ones' status changed by a commit."""
    store = Store(spark, new_folder(spark, "store"))
    store.publish(quads(spark, d, "orders"))
    new, old = _changes(spark, d)
    store.commit(new.withColumn("op", F.lit("add")).unionByName(old.withColumn("op", F.lit("delete"))).withColumn("seq", F.lit(0)), policy="disabled")
    return store


@_query(_patched(f"select {_LIST} from quads where quad_id not in (select quad_id from del) union select {_LIST} from ins"))
def store_commit(spark, d):
    return _changed(spark, d).quads()


@_query(_patched(f"select {_LIST} from (select * from quads where quad_id not in (select quad_id from del) union select * from ins) where o = 'X'"))
def store_match_object(spark, d):
    return _changed(spark, d).match(Pattern(o=literal("X")))


@_query(_patched("select count(*) as n from (select quad_id from quads where quad_id not in (select quad_id from del) union select quad_id from ins)"))
def store_size(spark, d):
    """From the store's log alone."""
    return spark.range(1).select(F.lit(_changed(spark, d).size()).cast("long").alias("n"))


@_query(_patched(f"select {_LIST} from quads where quad_id not in (select quad_id from del) union select {_LIST} from ins"))
def store_compact(spark, d):
    store = _changed(spark, d)
    store.compact()
    store.vacuum()
    return store.quads()


def _log(adds: DataFrame, dels: DataFrame) -> DataFrame:
    return adds.withColumn("op", F.lit("add")).unionByName(dels.withColumn("op", F.lit("delete"))).withColumn("seq", F.lit(0))


@_query(_patched("select quad_id from quads where quad_id in (select quad_id from del) or quad_id in (select quad_id from ins)"))
def store_presence(spark, d):
    """Which of some ids are stored, from the buckets of these ids."""
    store = Store(spark, new_folder(spark, "store"), bucket_rows=1000, large_rows=1000)
    store.publish(quads(spark, d, "orders"))
    new, old = _changes(spark, d)
    return store.stored(new.unionByName(old)).select("quad_id")


@_query(_patched(f"select {_LIST} from quads where quad_id not in (select quad_id from del) union select {_LIST} from ins"))
def store_filtered_commit(spark, d):
    """A commit whose filter leaves the nations out."""
    store = Store(spark, new_folder(spark, "store"))
    store.publish(quads(spark, d, "orders"))
    new, old = _changes(spark, d)
    store.commit(_log(new.unionByName(quads(spark, d, "nation")), old), "disabled", keep=QuadFilter(graphs=("urn:g:orders",)))
    return store.quads()


@_query(_patched("select 'add' as op, quad_id, s, p, o, g from ins where quad_id not in (select quad_id from quads) union all select 'delete', quad_id, s, p, o, g from quads where quad_id in (select quad_id from del) and quad_id not in (select quad_id from ins)"))
def store_changes(spark, d):
    """What a version changed, after a merge of all runs."""
    store = _changed(spark, d)
    store.compact()
    return store.changes(1, store.version()).select("op", "quad_id", "s", "p", "o", "g")


@_query(_with(f"select {_LIST} from quads where p <> 'urn:status' and g <> ''", "nation", "orders"))
def store_remove_matches(spark, d):
    """A predicate and the default graph are removed, each by a note in the log."""
    store = Store(spark, new_folder(spark, "store"))
    store.publish(quads(spark, d, "nation", "orders"))
    store.remove_matches(Pattern(p=node("urn:status")))
    store.delete_graph(matching.Term("", "DefaultGraph"))
    return store.quads()


@_query(f"with quads as (select * from ({quads_sql('documents')}) where g <> 'urn:src:src3') {_WHOLE_CHUNKS}")
def store_delete_graph(spark, d):
    """The chunks of a deleted graph go with it."""
    store = Store(spark, new_folder(spark, "store"))
    store.commit(_log(_docs(spark, d), _docs(spark, d).limit(0)), whole=True)
    store.delete_graph("urn:src:src3")
    return store.chunks().select("chunk_id", "quad_id", "subject", "predicate", "graph", "value")


@_query(f"with quads as (select * from ({quads_sql('documents')}) where g in ('urn:src:src1', 'urn:src:src2')) {_WHOLE_CHUNKS}")
def store_reindex(spark, d):
    """Nothing is indexed by the commit, and two graphs are afterwards, one after the other."""
    store = Store(spark, new_folder(spark, "store"))
    store.commit(_log(_docs(spark, d), _docs(spark, d).limit(0)), "disabled")
    for graph in ("urn:src:src1", "urn:src:src2"):
        store.reindex(QuadFilter(graphs=(graph,)), whole=True)
    return store.chunks().select("chunk_id", "quad_id", "subject", "predicate", "graph", "value")


@_query(_patched("select p, count(*) as n from (select quad_id, p from quads where quad_id not in (select quad_id from del) union select quad_id, p from ins) group by p"))
def store_counts(spark, d):
    """Quads by predicate, from the log alone."""
    store = _changed(spark, d)
    found = [(p, store.count(Pattern(p=node(p)))) for p in ("urn:customer", "urn:status", "urn:date")]
    return spark.createDataFrame(found, "p string, n long").where("n > 0")


@_query(_with(f"select {_LIST} from quads", "orders"))
def store_tiers(spark, d):
    """Orders in six commits, with runs of like size merged in between."""
    store = Store(spark, new_folder(spark, "store"), fanout=2)
    for part in range(6):
        rows = quads(spark, d, "orders", where=F.col("o_orderkey") % 6 == part)
        store.commit(_log(rows, rows.limit(0)), "disabled")
        store.maintain()
    return store.quads()


@_query(_with(f"select {_LIST} from quads where s = 'urn:order:7'", "orders"))
def store_as_of(spark, d):
    """A subject as it was before a commit."""
    return _changed(spark, d).at(1).match(Pattern(s=node("urn:order:7")))


@_query(_patched(f"select {_LIST} from (select * from quads where quad_id not in (select quad_id from del) union select * from ins) where quad_id > '8' order by quad_id limit 25"))
def store_page(spark, d):
    """A page of quads by id, from the buckets that follow the last one."""
    return _changed(spark, d).page("8", 25.7)
