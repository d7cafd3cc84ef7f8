"""The test tables as quads, in Spark and in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.functions.terms import BLANK, COLUMNS, DEFAULT, KEY, LANG_STRING, LITERAL, NAMED, XSD_DATE, XSD_STRING, quad_id

# Per fact: table, subject, its type, predicate, object, its type, datatype, language, graph; all but types and
# predicate are SQL expressions that Spark and DuckDB read alike.
_ORDER = ("concat('urn:order:', cast(o_orderkey as varchar(32)))", NAMED)
FACTS = {
    "nation": [
        ("concat('urn:nation:', cast(n_nationkey as varchar(32)))", NAMED, "urn:name", "n_name", LITERAL, XSD_STRING, None, "''"),
        ("concat('urn:nation:', cast(n_nationkey as varchar(32)))", NAMED, "urn:region", "concat('urn:region:', cast(n_regionkey as varchar(32)))", NAMED, None, None, "''"),
    ],
    "customer": [
        ("concat('urn:customer:', cast(c_custkey as varchar(32)))", NAMED, "urn:name", "c_name", LITERAL, XSD_STRING, None, "''"),
        ("concat('urn:customer:', cast(c_custkey as varchar(32)))", NAMED, "urn:segment", "c_mktsegment", LITERAL, XSD_STRING, None, "''"),
        ("concat('urn:customer:', cast(c_custkey as varchar(32)))", NAMED, "urn:nation", "concat('urn:nation:', cast(c_nationkey as varchar(32)))", NAMED, None, None, "''"),
    ],
    "orders": [
        (*_ORDER, "urn:customer", "concat('urn:customer:', cast(o_custkey as varchar(32)))", NAMED, None, None, "'urn:g:orders'"),
        (*_ORDER, "urn:status", "o_orderstatus", LITERAL, XSD_STRING, None, "'urn:g:orders'"),
        (*_ORDER, "urn:date", "cast(cast(o_orderdate as date) as varchar(32))", LITERAL, XSD_DATE, None, "'urn:g:orders'"),
    ],
    "documents": [("concat('urn:doc:', cast(doc_id as varchar(32)))", NAMED, "urn:text", "text", LITERAL, LANG_STRING, "lang", "concat('urn:src:', source)")],
    "conversations": [("concat('c', cast(conv_id as varchar(32)), 't', cast(turn as varchar(32)))", BLANK, "urn:says", "text", LITERAL, XSD_STRING, None, "concat('urn:conv:', role)")],
    "events": [("concat('urn:user:', cast(user_id as varchar(32)))", NAMED, "urn:did", "event_type", LITERAL, XSD_STRING, None, "''")],
}
ALL = ("nation", "customer", "orders", "documents", "conversations")


def _select(table: str, fact: tuple, source: str | None = None) -> str:
    s, s_type, p, o, o_type, datatype, lang, g = fact
    text = lambda v: "cast(null as varchar(256))" if v is None else f"'{v}'"
    kind = f"case when {g} = '' then '{DEFAULT}' else '{NAMED}' end"
    return f"select {s} as s, '{s_type}' as s_type, '{p}' as p, {o} as o, '{o_type}' as o_type, {text(datatype)} as o_datatype, {lang or 'cast(null as varchar(256))'} as o_lang, {g} as g, {kind} as g_type from {source or table}"


def raw_quads(rows: DataFrame, table: str) -> DataFrame:
    """Facts of one table's rows as term columns."""
    found = [rows.selectExpr(*[part.strip() for part in _columns(table, fact)]) for fact in FACTS[table]]
    return reduce(DataFrame.unionByName, found)


def _columns(table: str, fact: tuple) -> list[str]:
    s, s_type, p, o, o_type, datatype, lang, g = fact
    text = lambda v: "cast(null as string)" if v is None else f"'{v}'"
    cast = lambda e: e.replace("varchar(32)", "string")
    return [f"{cast(s)} as s", f"'{s_type}' as s_type", f"'{p}' as p", f"{cast(o)} as o", f"'{o_type}' as o_type", f"{text(datatype)} as o_datatype", f"{lang or 'cast(null as string)'} as o_lang", f"{g} as g", f"case when {g} = '' then '{DEFAULT}' else '{NAMED}' end as g_type"]


def quads(spark: SparkSession, sf_dir: str, *tables: str, where: Column | None = None) -> DataFrame:
    """Quads of the named tables, all if none is named; ``where`` filters the tables' rows.

    Facts are keyed, so they are distinct as they are, but for events.
    """
    parts = []
    for t in tables or ALL:
        rows = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        parts.append(raw_quads(rows if where is None else rows.where(where), t))
    return reduce(DataFrame.unionByName, parts).withColumn("quad_id", quad_id()).select(*COLUMNS)


def id_sql(columns: tuple[str, ...] = KEY) -> str:
    return f"sha256(concat_ws(chr(0), {', '.join(f"coalesce({c}, '')" for c in columns)}))"


def quads_sql(*tables: str, where: str = "true") -> str:
    """The same as a select for DuckDB."""
    union = " union all ".join(_select(t, f, f"(select * from {t} where {where})") for t in tables or ALL for f in FACTS[t])
    return f"select {id_sql()} as quad_id, * from ({union})"
