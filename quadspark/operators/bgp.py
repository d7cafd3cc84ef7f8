"""Basic graph patterns: one scan per pattern or per star of patterns, joined on shared variables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.functions.terms import COLUMNS, LANG_STRING, LITERAL, NAMED, XSD_STRING, Term
from quadspark.operators.match import Pattern
from quadspark.sources.folders import new_folder

#: Rows of a subject up to which a star's patterns are put together in one row; those of larger ones are joined.
MOST_IN_A_STAR = 1000
_PARTS = ("", "_type", "_datatype", "_lang")


@dataclass(frozen=True)
class Var:
    name: str


Slot = Term | Var | None


def _fixed(slots: tuple[Slot, Slot, Slot, Slot]) -> Pattern:
    return Pattern(*[t if isinstance(t, Term) else None for t in slots])


def _bound(slots: tuple[Slot, Slot, Slot, Slot]) -> tuple[dict[str, Column], Column, list[str]]:
    """Columns of a pattern's variables, what must hold where one stands twice, and their names.

    A binding keeps the term's type, datatype and language beside its value. A literal without a datatype is an
    xsd:string, or with a language an rdf:langString, so it joins with those.
    """
    columns, names, same = {}, [], F.lit(True)
    for place, slot in zip("spog", slots, strict=True):
        if not isinstance(slot, Var):
            continue
        kind = F.lit(NAMED) if place == "p" else F.col(f"{place}_type")
        literal = F.col(f"{place}_type") == LITERAL if place == "o" else F.lit(False)
        blank = F.lit("")
        parts = {"": F.col(place), "_type": kind, "_datatype": F.when(literal, F.coalesce(F.nullif("o_datatype", blank), F.when(F.coalesce("o_lang", blank) != "", LANG_STRING).otherwise(XSD_STRING))).otherwise(blank) if place == "o" else blank, "_lang": F.when(literal, F.coalesce("o_lang", blank)).otherwise(blank) if place == "o" else blank}
        if slot.name in names:
            same = reduce(lambda both, k: both & (columns[slot.name + k] == parts[k]), _PARTS, same)
            continue
        names.append(slot.name)
        columns |= {slot.name + k: v for k, v in parts.items()}
    return columns, same, names


def _scan(quads: DataFrame, slots: tuple[Slot, Slot, Slot, Slot]) -> tuple[DataFrame, list[str]]:
    """Bindings of one pattern."""
    columns, same, names = _bound(slots)
    return quads.where(_fixed(slots).column()).where(same).select(*[v.alias(k) for k, v in columns.items()]), names


def _joined(left: tuple[DataFrame, list[str]], right: tuple[DataFrame, list[str]]) -> tuple[DataFrame, list[str]]:
    (rows, known), (more, names) = left, right
    shared = [n for n in names if n in known]
    return rows.join(more, [n + k for n in shared for k in _PARTS]), [*known, *[n for n in names if n not in known]]


def _star(quads: DataFrame, patterns: list[tuple[Slot, Slot, Slot, Slot]]) -> tuple[DataFrame, list[str]]:
    """Bindings of patterns with one subject variable, from one scan.

    What any of them matches is written out; then the rows of a subject come together in one row, a list for each
    pattern, and the lists are multiplied. Subjects of more than MOST_IN_A_STAR rows don't fit one row, so for these
    the patterns are joined.
    """
    subject = patterns[0][0].name
    path = new_folder(quads.sparkSession, "star")
    wanted = reduce(lambda a, b: a | b, [F.coalesce(_fixed(p).column(), F.lit(False)) for p in patterns])
    quads.where(wanted).select(*COLUMNS).write.parquet(path)
    rows = quads.sparkSession.read.schema(quads.select(*COLUMNS).schema).parquet(path)
    large = rows.groupBy("s", "s_type").count().where(F.col("count") > MOST_IN_A_STAR).select("s", "s_type")
    few, many = rows.join(large, ["s", "s_type"], "left_anti"), rows.join(large, ["s", "s_type"], "left_semi")

    lists, named = [], []
    for i, p in enumerate(patterns):
        columns, same, names = _bound(p)
        own = {k: v for k, v in columns.items() if k not in {subject + x for x in _PARTS}}
        struct = F.struct(F.lit(1).alias("_"), *[v.alias(k) for k, v in own.items()])
        lists.append(F.collect_list(F.when(_fixed(p).column() & same, struct)).alias(f"_list{i}"))
        named.append([n for n in names if n != subject])
    grouped = few.groupBy("s", "s_type").agg(*lists).where(reduce(lambda a, b: a & b, [F.size(f"_list{i}") > 0 for i in range(len(patterns))]))
    bound = {"": F.col("s"), "_type": F.col("s_type"), "_datatype": F.lit(""), "_lang": F.lit("")}
    out, known = grouped.select(*[v.alias(subject + k) for k, v in bound.items()], *[f"_list{i}" for i in range(len(patterns))]), [subject]
    for i, names in enumerate(named):
        out = out.withColumn(f"_list{i}", F.explode(f"_list{i}"))
        for name in names:
            if name in known:
                out = out.where(reduce(lambda a, b: a & b, [F.col(name + k) == F.col(f"_list{i}")[name + k] for k in _PARTS]))
            else:
                out = out.withColumns({name + k: F.col(f"_list{i}")[name + k] for k in _PARTS})
                known.append(name)
        out = out.drop(f"_list{i}")
    joined, _ = reduce(_joined, [_scan(many, p) for p in patterns])
    columns = [n + k for n in known for k in _PARTS]
    return out.select(*columns).unionByName(joined.select(*columns)), known


def bgp(quads: DataFrame, patterns: list[tuple[Slot, Slot, Slot, Slot]], size: Callable[[Pattern], float] | None = None, read: Callable[[Pattern], DataFrame] | None = None) -> DataFrame:
    """All bindings of a list of (s, p, o, g) patterns, values in a column per variable.

    Patterns with the same subject variable are answered by one scan. These and the others are joined in an order that
    shares variables, smallest first if ``size`` tells how many quads match a pattern; patterns that share no variable
    with the others are refused. ``read`` gives the quads of a single pattern, if that is cheaper than a scan.
    """
    stars: dict[str, list] = {}
    for i, p in enumerate(patterns):
        stars.setdefault(p[0].name if isinstance(p[0], Var) else f"_{i}", []).append(p)
    units = list(stars.values())
    names = [{slot.name for p in unit for slot in p if isinstance(slot, Var)} for unit in units]
    weight = [min(size(_fixed(p)) for p in unit) if size else i for i, unit in enumerate(units)]
    order, left = [], sorted(range(len(units)), key=lambda i: weight[i])
    known: set[str] = set()
    while left:
        i = next((i for i in left if not order or names[i] & known), None)
        if i is None:
            raise ValueError("a pattern shares no variable with the others")
        order.append(i)
        left.remove(i)
        known |= names[i]
    found = [_star(quads, units[i]) if len(units[i]) > 1 else _scan(read(_fixed(units[i][0])) if read else quads, units[i][0]) for i in order]
    rows, columns = reduce(_joined, found)
    return rows.select(*[n for p in patterns for slot in p if isinstance(slot, Var) for n in [slot.name] if n in columns and not (columns.remove(n))])
