"""Query cleaning, index tokens and chunking of literal text."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that a query drops unless it has no others.
STOPWORDS = (
    "a an and are as at be been being but by did do does for from had has have how i if in into is it its me my not "
    "of on or our please that the their these those this to us was we were what when where which who why with you your"
).split()

CHUNK_SIZE, CHUNK_OVERLAP, SEPARATORS = 1000, 200, ("\n\n", "\n", " ", "")

_NO_WORD = r"[^\p{L}\p{N}\p{M}]+"
#: White space of any script, also the byte order mark, as browsers cut words.
WHITE = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"
_BASES = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))}
#: Latin small letters with marks, by letter; the marks themselves, U+0300 to U+036F, are dropped.
_FOLDED = {c: base[0] for c, base in _BASES.items() if len(base) > 1 and base[0].isascii() and c.islower()}
_MARKS = "".join(map(chr, range(0x300, 0x370)))


def query_terms(query: Column) -> Column:
    """Terms of a query: cut at white space, lower-cased, all but letters, digits and marks removed, stopwords dropped."""
    cut = F.transform(F.split(F.coalesce(query, F.lit("")), WHITE), lambda t: F.regexp_replace(F.lower(t), _NO_WORD, ""))
    kept = F.filter(cut, lambda t: F.length(t) > 0)
    content = F.filter(kept, lambda t: ~t.isin(*STOPWORDS))
    return F.when(F.size(content) > 0, content).otherwise(kept)


def clean_query(query: Column) -> Column:
    """The terms, each in quotes, joined by spaces; empty if there is nothing to search for."""
    return F.array_join(F.transform(query_terms(query), lambda t: F.concat(F.lit('"'), t, F.lit('"'))), " ")


def fold(text: Column) -> Column:
    """Lower case without accents on Latin letters."""
    small = F.lower(text)
    return F.when(F.rlike(small, F.lit(r"[^\x00-\x7F]")), F.translate(small, "".join(_FOLDED) + _MARKS, "".join(_FOLDED.values()))).otherwise(small)


def index_terms(text: Column) -> Column:
    """Terms of indexed text, repeats kept: accents folded and cut at everything but letters, digits and marks."""
    return F.filter(F.split(fold(text), _NO_WORD), lambda t: F.length(t) > 0)


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Cut a text at the coarsest separators that make pieces fit, then pack neighbours up to ``size``.

    A chunk starts with the last pieces of the one before it, up to ``overlap`` characters; none is longer than
    ``size`` and none is blank.
    """

    def pieces(part: str, level: int) -> list[str]:
        if len(part) <= size:
            return [part]
        mark = separators[level] if level < len(separators) else ""
        if not mark:
            step = max(1, size - overlap)
            return [part[i : i + size] for i in range(0, max(1, len(part) - overlap), step)]
        cut = part.split(mark)
        return [p for i, c in enumerate(cut) for p in pieces(c + (mark if i < len(cut) - 1 else ""), level + 1)]

    out: list[str] = []
    held: list[str] = []
    length = 0
    for piece in pieces(text, 0):
        if held and length + len(piece) > size:
            out.append("".join(held))
            while held and (length > overlap or length + len(piece) > size):
                length -= len(held.pop(0))
        held.append(piece)
        length += len(piece)
    out.append("".join(held))
    return [c for c in (o.strip() for o in out) if c]


def chunked(text: Column, splitter: Callable[[str], list[str]] | None = None, whole: bool = False) -> Column:
    """Array of chunks; with ``whole`` a text is one chunk. Texts that fit in one never leave the JVM unless a
    splitter of one's own is given."""
    one = F.filter(F.array(F.trim(text)), lambda t: F.length(t) > 0)
    if whole:
        return one
    own = splitter or split_text

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: own(t) if t else [])

    if splitter is not None:
        return cut(text)
    return F.when(F.length(text) <= CHUNK_SIZE, one).otherwise(cut(F.when(F.length(text) > CHUNK_SIZE, text)))
