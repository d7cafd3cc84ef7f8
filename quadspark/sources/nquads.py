"""N-Quads text in and out."""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadspark.functions.terms import BLANK, COLUMNS, DEFAULT, LANG_STRING, LITERAL, NAMED, XSD_STRING, normalise

# Characters of blank labels by the N-Quads grammar, first ones and all but dots.
_FIRST = r"0-9A-Za-z_:\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{2FF}\x{370}-\x{37D}\x{37F}-\x{1FFF}\x{200C}-\x{200D}\x{2070}-\x{218F}\x{2C00}-\x{2FEF}\x{3001}-\x{D7FF}\x{F900}-\x{FDCF}\x{FDF0}-\x{FFFD}\x{10000}-\x{EFFFF}"
_LABEL = rf"[{_FIRST}](?:[{_FIRST}.\x{{B7}}\x{{300}}-\x{{36F}}\x{{203F}}-\x{{2040}}-]*[{_FIRST}\x{{B7}}\x{{300}}-\x{{36F}}\x{{203F}}-\x{{2040}}-])?"
# Fixed value: the shape of a statement. Groups: subject node, blank; predicate; object node, blank, literal's quote,
# literal, datatype, language; graph's bracket, node, blank. Quantifiers inside a literal give nothing back, so lines of
# any length match without recursion.
LINE = rf'^\s*(?:<([^>\n]*)>|_:({_LABEL}))\s*<([^>\n]*)>\s*(?:<([^>\n]*)>|_:({_LABEL})|(")((?:[^"\\\n\r]++|\\[^\n\r])*+)"(?:\^\^<([^>\n]*)>|@([A-Za-z0-9-]+))?)\s*(?:(<)([^>\n]*)>|_:({_LABEL}))?\s*\.\s*(?:#[^\n]*)?$'
# Fixed value: characters that stand in an IRI as escapes only.
_NOT_IN_IRI = r'[\x00-\x20<>"{}|^`\\]'
_GROUPS = 12
#: Bytes of N-Quads whose repeats a task looks for, where the session has too few shuffle partitions for that.
TASK_BYTES = 32_000_000

_ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}
_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))")


@F.pandas_udf(T.StringType())
def _unescaped(values: pd.Series) -> pd.Series:
    one = lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _ESCAPES.get(m[3], m[0])
    return values.map(lambda v: None if v is None else _ESCAPE.sub(one, v))


def _unescape(value: Column) -> Column:
    """Only values that hold a backslash go to Python."""
    return F.when(F.contains(value, F.lit("\\")), _unescaped(F.when(F.contains(value, F.lit("\\")), value))).otherwise(value)


def parse(lines: DataFrame, scope: str = "", tasks: int = 0) -> tuple[DataFrame, DataFrame]:
    """Quads and rejected lines of a table of ``value``; blank lines and comments are neither.

    ``scope`` is put before blank labels, so that labels of different imports stay apart; ``tasks`` as in ``normalise``.
    """
    said = lines.where(~F.rlike("value", F.lit(r"^\s*(?:#[^\n]*)?$")))
    # One match a line: the groups come out a line each, as no group holds a line feed. The optimiser would repeat the
    # match in every column, but not across a generator.
    groups = F.split(F.regexp_replace("value", F.lit(LINE), F.lit("\n".join(f"${i}" for i in range(1, _GROUPS + 1)))), "\n", -1)
    cut = said.withColumn("_g", F.explode(F.array(F.when(~F.contains("value", F.lit("\n")), groups))))
    fits = F.coalesce(F.size("_g") == _GROUPS, F.lit(False))
    g = [None, *[F.col("_g")[i] for i in range(_GROUPS)]]
    some = lambda i: g[i] != ""
    literal = some(6)
    label = lambda i: F.concat(F.lit(scope), g[i])
    raw = cut.where(fits).select(
        F.when(some(2), label(2)).otherwise(_unescape(g[1])).alias("s"),
        F.when(some(2), BLANK).otherwise(NAMED).alias("s_type"),
        _unescape(g[3]).alias("p"),
        F.when(some(5), label(5)).otherwise(_unescape(F.when(literal, g[7]).otherwise(g[4]))).alias("o"),
        F.when(literal, LITERAL).when(some(5), BLANK).otherwise(NAMED).alias("o_type"),
        F.when(literal, F.when(some(9), LANG_STRING).when(some(8), _unescape(g[8])).otherwise(XSD_STRING)).alias("o_datatype"),
        F.when(literal & some(9), g[9]).alias("o_lang"),
        F.when(some(12), label(12)).otherwise(_unescape(g[11])).alias("g"),
        F.when(some(12), BLANK).when(some(10), NAMED).otherwise(DEFAULT).alias("g_type"),
    )
    return normalise(raw, tasks), cut.where(~fits).drop("_g")


def read(spark: SparkSession, path: str, scope: str = "") -> tuple[DataFrame, DataFrame]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    tasks = math.ceil(sum(files.getContentSummary(f.getPath()).getLength() for f in files.globStatus(at) or []) / TASK_BYTES)
    return parse(spark.read.text(path), scope, tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else 0)


def _escaped(value: Column) -> Column:
    for mark, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ('"', '\\"')):
        value = F.replace(value, F.lit(mark), F.lit(code))
    return value


def _iri(value: Column) -> Column:
    """What an IRI may not hold, as \\u escapes; hardly any has such characters."""
    one = lambda c: F.when(F.rlike(c, F.lit(_NOT_IN_IRI)), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(c)), 4, "0"))).otherwise(c)
    return F.when(F.rlike(value, F.lit(_NOT_IN_IRI)), F.array_join(F.transform(F.split(value, ""), one), "")).otherwise(value)


def render(quads: DataFrame) -> DataFrame:
    """``line`` per quad; the datatype of plain and tagged literals is left out."""
    node = lambda c: F.concat(F.lit("<"), _iri(F.col(c)), F.lit(">"))
    term = lambda c: F.when(F.col(f"{c}_type") == BLANK, F.concat(F.lit("_:"), c)).otherwise(node(c))
    tail = F.when(F.coalesce("o_lang", F.lit("")) != "", F.concat(F.lit("@"), "o_lang")).when(F.coalesce(F.nullif("o_datatype", F.lit("")), F.lit(XSD_STRING)) != XSD_STRING, F.concat(F.lit("^^"), node("o_datatype"))).otherwise("")
    value = F.when(F.col("o_type") == LITERAL, F.concat(F.lit('"'), _escaped(F.col("o")), F.lit('"'), tail)).otherwise(term("o"))
    graph = F.when(F.col("g_type") == DEFAULT, "").otherwise(F.concat(F.lit(" "), term("g")))
    return quads.select(F.concat(term("s"), F.lit(" "), node("p"), F.lit(" "), value, graph, F.lit(" .")).alias("line"))


def write(quads: DataFrame, path: str) -> None:
    render(quads.select(*COLUMNS)).write.text(path)
