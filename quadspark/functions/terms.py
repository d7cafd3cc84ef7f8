"""Terms, quad ids and row shapes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Term types and datatype IRIs.
NAMED, BLANK, LITERAL, DEFAULT = "NamedNode", "BlankNode", "Literal", "DefaultGraph"
XSD_STRING = "http://www.w3.org/2001/XMLSchema#string"
XSD_DATE = "http://www.w3.org/2001/XMLSchema#date"
LANG_STRING = "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"

_REQUIRED = ("quad_id", "s", "s_type", "p", "o", "o_type")
QUADS = T.StructType([T.StructField(c, T.StringType()) for c in (*_REQUIRED, "o_datatype", "o_lang", "g", "g_type")])
COLUMNS = QUADS.fieldNames()
KEY = ("s", "s_type", "p", "o", "o_type", "o_datatype", "o_lang", "g", "g_type")


@dataclass(frozen=True)
class Term:
    """A value with its type; literals may have a language or a datatype."""

    value: str
    type: str = NAMED
    lang: str | None = None
    datatype: str | None = None


def node(value: str) -> Term:
    return Term(value)


def blank(label: str) -> Term:
    return Term(label, BLANK)


def literal(value: str, lang: str | None = None, datatype: str | None = None) -> Term:
    return Term(value, LITERAL, lang or None, datatype or (LANG_STRING if lang else XSD_STRING))


DEFAULT_GRAPH = Term("", DEFAULT)


def hash_key(*fields: Column) -> Column:
    """SHA-256 of fields joined by NUL; a missing field counts as empty."""
    return F.sha2(F.concat_ws("\u0000", *[F.coalesce(f, F.lit("")) for f in fields]), 256)


def quad_id() -> Column:
    return hash_key(*[F.col(c) for c in KEY])


def valid() -> Column:
    """Rows that form a quad: all required parts, known term types, a node as predicate."""
    there = (F.col("s").isNotNull()) & F.col("p").isNotNull() & F.col("o").isNotNull() & F.col("g").isNotNull()
    types = F.col("s_type").isin(NAMED, BLANK) & F.col("o_type").isin(NAMED, BLANK, LITERAL) & F.col("g_type").isin(NAMED, BLANK, DEFAULT)
    return F.coalesce(there & types, F.lit(False))


def normalise(raw: DataFrame, tasks: int = 0) -> DataFrame:
    """Flat term columns to stored quads: literal parts only on literals, empty tags to null, ids, no repeats.

    A literal with a language gets rdf:langString; one without a datatype keeps none. Invalid rows are left out.
    Repeats are looked for in so many tasks, or in the session's number of them.
    """
    is_literal = F.col("o_type") == LITERAL
    lang = F.when(is_literal & (F.col("o_lang") != ""), F.col("o_lang"))
    shaped = raw.where(valid()).withColumn("o_lang", lang)
    datatype = F.when(is_literal, F.when(F.col("o_lang").isNotNull(), F.lit(LANG_STRING)).otherwise(F.nullif(F.col("o_datatype"), F.lit(""))))
    shaped = shaped.withColumn("o_datatype", datatype).select(*COLUMNS[1:])
    # Rows go to the task of their id without it, and get it there
    dealt = shaped.repartition(tasks, quad_id()) if tasks else shaped.repartition(quad_id())
    return dealt.withColumn("quad_id", quad_id()).select(*COLUMNS).dropDuplicates(["quad_id"])


def rejects(raw: DataFrame) -> DataFrame:
    """Rows that ``normalise`` leaves out."""
    return raw.where(~valid())


def terms(quads: DataFrame) -> DataFrame:
    """Quads with one struct per term; empty languages and datatypes count as absent."""
    empty = F.lit(None).cast("string")
    term = lambda kind, value, datatype=empty, lang=empty: F.struct(kind.alias("term_type"), value.alias("value"), datatype.alias("datatype"), lang.alias("lang"))
    return quads.select(
        "quad_id",
        term(F.col("s_type"), F.col("s")).alias("subject"),
        term(F.lit(NAMED), F.col("p")).alias("predicate"),
        term(F.col("o_type"), F.col("o"), F.nullif(F.col("o_datatype"), F.lit("")), F.nullif(F.col("o_lang"), F.lit(""))).alias("object"),
        term(F.col("g_type"), F.col("g")).alias("graph"),
    )
