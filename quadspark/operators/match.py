"""Pattern filters, pages, counts and removals."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.functions.terms import LANG_STRING, LITERAL, NAMED, XSD_STRING, Term


@dataclass(frozen=True)
class Pattern:
    """One term per slot; None matches anything. A None graph means every graph."""

    s: Term | None = None
    p: Term | None = None
    o: Term | None = None
    g: Term | None = None

    def column(self) -> Column:
        """The predicate. Values and types must be equal; the predicate slot compares values alone."""
        tests = [F.lit(True)]
        for slot in ("s", "o", "g"):
            if (term := getattr(self, slot)) is not None:
                tests += [F.col(slot) == term.value, F.col(f"{slot}_type") == term.type]
        if self.p is not None:
            tests.append(F.col("p") == self.p.value)
        if self.o is not None and self.o.type == LITERAL:
            tests.append(_literal(self.o))
        out = tests[0] if len(tests) == 1 else tests[1]
        for t in tests[2:]:
            out = out & t
        return out


def _literal(term: Term) -> Column:
    """Language tags are compared as they are; a plain or tagged literal also matches rows without a datatype."""
    tests = [F.col("o_lang") == term.lang] if term.lang else []
    datatype = term.datatype or (LANG_STRING if term.lang else XSD_STRING)
    same = F.col("o_datatype") == datatype
    if datatype in (XSD_STRING, LANG_STRING):
        same = F.col("o_datatype").isNull() | (F.col("o_datatype") == "") | same
    return tests[0] & same if tests else same


#: Values of a list that go into the plan as they are.
MOST_INLINE = 500


@dataclass(frozen=True)
class QuadFilter:
    """Values of subjects, predicates and graphs to include and to exclude; an empty list means no limit."""

    subjects: tuple[str, ...] = ()
    predicates: tuple[str, ...] = ()
    graphs: tuple[str, ...] = ()
    not_subjects: tuple[str, ...] = ()
    not_predicates: tuple[str, ...] = ()
    not_graphs: tuple[str, ...] = ()

    def column(self, s: str = "s", p: str = "p", g: str = "g") -> Column:
        out = F.lit(True)
        for name, wanted, unwanted in ((s, self.subjects, self.not_subjects), (p, self.predicates, self.not_predicates), (g, self.graphs, self.not_graphs)):
            if wanted:
                out = out & F.col(name).isin(*wanted)
            if unwanted:
                out = out & ~F.col(name).isin(*unwanted)
        return out


    def apply(self, rows: DataFrame, s: str = "s", p: str = "p", g: str = "g") -> DataFrame:
        """Rows that pass; lists of more than MOST_INLINE values become tables that are joined."""
        for name, values, how in ((s, self.subjects, "left_semi"), (p, self.predicates, "left_semi"), (g, self.graphs, "left_semi"), (s, self.not_subjects, "left_anti"), (p, self.not_predicates, "left_anti"), (g, self.not_graphs, "left_anti")):
            if len(values) > MOST_INLINE:
                listed = rows.sparkSession.createDataFrame([(v,) for v in set(values)], f"`{name}` string")
                rows = rows.join(listed, name, how)
            elif values:
                rows = rows.where(F.col(name).isin(*values) if how == "left_semi" else ~F.col(name).isin(*values))
        return rows


def match(quads: DataFrame, pattern: Pattern = Pattern()) -> DataFrame:
    return quads.where(pattern.column())


def count(quads: DataFrame, pattern: Pattern = Pattern()) -> DataFrame:
    """One row: ``n``."""
    return match(quads, pattern).agg(F.count("*").alias("n"))


def page(quads: DataFrame, after: str | None, limit: float) -> DataFrame:
    """The next quads by id, at least one."""
    rows = quads if after is None else quads.where(F.col("quad_id") > after)
    return rows.orderBy("quad_id").limit(max(1, math.floor(limit)))


def remove_matches(quads: DataFrame, pattern: Pattern) -> tuple[DataFrame, DataFrame]:
    """What stays and what the pattern removes."""
    hit = F.coalesce(pattern.column(), F.lit(False))
    return quads.where(~hit), quads.where(hit)


def delete_graph(quads: DataFrame, graph: str | Term) -> tuple[DataFrame, DataFrame]:
    """Remove a graph; a string names a node."""
    return remove_matches(quads, Pattern(g=Term(graph, NAMED) if isinstance(graph, str) else graph))
