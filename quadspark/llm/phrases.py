"""Collocations of each language, counted inside the distinct chunks of a prefix-free parse."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadspark.llm import scratch

#: Words of a phrase at most, occurrences that it needs, phrases of a language, and the share in percent of a phrase's
#: occurrences from which a longer phrase takes its place.
MOST_WORDS, LEAST, TOP, SHARE = 4, 30, 2000, 80
NO_LANG = "und"
#: A word starts a chunk if its hash is divisible by this.
EVERY = 16
#: Bytes that are parsed at once, but for a word or chunk that has more; rows of partial counts that a task holds.
WINDOW, HELD = 1 << 20, 300_000
#: Bits of the bitmap that tells which shorter phrases are frequent: 8 MB at any size of the input. When it gets full
#: it keeps more phrases than it need, which are counted and then found to be too few; counts are exact all the same.
BITS = 26
#: Numbers that the phrases of a language are dealt by before its best meet.
SALTS = 32

# Kinds of bytes: of a word, white space between words, end of a piece.
_WORD, _SPACE, _END = 0, 1, 2
_KINDS = np.array([_SPACE if b in b" \t" else _END if b in b".,;:!?\n\x0b\x0c\r" else _WORD for b in range(256)], np.uint8)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_EDGE = re.compile(rb"[ \t.,;:!?\n-\r]")
_NEXT = rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}"

# An odd base of the polynomial hash modulo 2^64, and two odd multipliers that mix.
_BASE, _MIX, _STEP = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_MIX)
    return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to ``size`` - 1."""
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, hash and piece of every word of a run of bytes; a hash depends on the word's bytes alone."""
    kinds = _KINDS[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = kinds == _WORD
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[0::2], edges[1::2]
    size = 1 << max(20, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return starts, ends, _mixed((sums[ends] - sums[starts]) * down[starts]), np.cumsum(kinds == _END)[starts] if len(starts) else starts


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after the other."""
    at = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - at, sizes)


def _strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Slices of bytes as strings."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[_ranges(starts, sizes)]))])


# The parse


def _parsed(data: np.ndarray, limit: int, overlap: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Chunks of a run of small bytes, how many of their words are their own, and where each starts.

    A chunk starts with a piece and at every word whose hash says so, and owns the words up to the next chunk; up to
    ``overlap`` words of the same piece follow. Words from ``limit`` on are there to follow, not to be owned. Words
    are followed by one space each.
    """
    starts, ends, hashes, pieces = _words(data)
    first = np.ones(len(starts), bool)
    first[1:] = pieces[1:] != pieces[:-1]
    own = int(np.searchsorted(starts, limit))
    heads = np.flatnonzero((first | (hashes % np.uint64(EVERY) == 0))[:own])
    owned = np.diff(np.append(heads, own))
    piece_ends = np.append(np.flatnonzero(first)[1:], len(starts))
    stops = np.minimum(heads + owned + overlap, piece_ends[np.searchsorted(piece_ends, heads, side="right")]) if len(heads) else heads
    owned = np.minimum(owned, stops - heads)
    words = _ranges(heads, stops - heads)
    spaced = np.append(data, np.uint8(32))
    sizes = ends[words] - starts[words] + 1
    text = spaced[_ranges(starts[words], sizes)]
    text[np.cumsum(sizes) - 1] = 32
    offsets = np.zeros(len(heads) + 1, np.int32)
    offsets[1:] = np.append(0, np.cumsum(sizes))[np.cumsum(stops - heads)]
    return pa.Array.from_buffers(pa.string(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(text)]), owned, starts[heads]


def _windows(texts: Iterator[tuple[str, bytes]], overlap: int, window: int) -> Iterator[tuple[bytes, int, list[int], list[str]]]:
    """Bytes to parse, where their own words end, and starts and languages of the texts in them.

    Short texts come together, a line feed between them. A text of more than a window comes in several, cut between
    words, each with the words that follow it.
    """
    held, starts, langs, size = [], [], [], 0
    for lang, text in texts:
        if size and size + len(text) > window:
            yield b"\n".join(held), size, starts, langs
            held, starts, langs, size = [], [], [], 0
        at = 0
        while len(text) - at > window:
            edge = _EDGE.search(text, at + window)
            if edge is None:
                break
            more = re.compile(_NEXT % overlap).match(text, edge.start()).end()
            yield text[at:more], edge.start() - at, [0], [lang]
            at = edge.start()
        held.append(text[at:] if at else text)
        starts.append(size)
        langs.append(lang)
        size += len(held[-1]) + 1
    if held:
        yield b"\n".join(held), size, starts, langs


def _parse(overlap: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((lang.as_py(), (text.as_py() or b"").translate(_LOWER)) for lang, text in zip(batch.column(0), batch.column(1), strict=True))
            for data, limit, starts, langs in _windows(texts, overlap, window):
                chunks, owned, places = _parsed(np.frombuffer(data, np.uint8), limit, overlap)
                names, codes = np.unique(np.array(langs, object), return_inverse=True)
                own = codes[np.searchsorted(starts, places, side="right") - 1]
                yield pa.RecordBatch.from_arrays([pa.DictionaryArray.from_arrays(pa.array(own, pa.int32()), pa.array(names, pa.string())).cast(pa.string()), chunks, pa.array(owned, pa.int32())], names=["lang", "chunk", "owned"])

    return run


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_words: int = MOST_WORDS, window: int = WINDOW) -> DataFrame:
    """Distinct chunks of the parse: ``lang, owned, chunk, times``; a phrase lies in the chunk that owns its first word."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG))
    own = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    chunks = own.mapInArrow(_parse(most_words - 1, window), "lang string, chunk string, owned int")
    return chunks.groupBy("lang", "owned", "chunk").agg(F.count("*").alias("times"))


# Counts


def _grams(data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Start, end and string of every word of strings that lie one after the other, and places of their phrases in the bitmap.

    ``places[k - 1][i]`` is that of the k words from word i on; it depends on them and on the seed of their string,
    and means nothing where the string ends before. The last bytes of strings are spaces.
    """
    starts, ends, hashes, _ = _words(data)
    of = np.searchsorted(offsets, starts, side="right") - 1
    one = _mixed(hashes ^ seeds[of])
    now, places = one, []
    for k in range(most):
        if k:
            now = _mixed(now * np.uint64(_STEP) + np.append(one[k:], np.zeros(min(k, len(one)), np.uint64)))
        places.append(now >> np.uint64(64 - BITS))
    return starts, ends, of, places


def _seeds(langs: pa.Array) -> np.ndarray:
    """A number per row that tells its language."""
    coded = langs.dictionary_encode()
    of = np.array([_words(np.frombuffer(name.encode() + b" ", np.uint8))[2].sum() if name else np.uint64(7) for name in coded.dictionary.to_pylist()], np.uint64)
    return of[coded.indices.to_numpy()]


def _contents(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of strings one after the other, and where each starts and the last one ends."""
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8), (ends - ends[0]).astype(np.int64)


def _slices(batch: pa.RecordBatch, column: int, window: int) -> Iterator[pa.RecordBatch]:
    """Slices of so many bytes in a column of strings at most, unless one row has more."""
    ends = _contents(batch.column(column))[1]
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + window, side="right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop


def _summed(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["lang", "phrase", "n"])


def _counted(k: int, frequent, window: int):
    """Count phrases of ``k`` words whose two shorter ones are in the bitmap, summed within a task as far as it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(frequent.value, np.uint8) if frequent is not None else None
        held: list[pa.Table] = []
        fresh = 0
        for batch in batches:
            for part in _slices(batch, 1, window):
                data, offsets = _contents(part.column(1))
                starts, ends, of, places = _grams(data, offsets, _seeds(part.column(0)), max(1, k - 1))
                heads = np.searchsorted(of, np.arange(part.num_rows))
                own = np.arange(len(of)) - heads[of] < part.column(2).to_numpy()[of]
                own[max(0, len(of) - k + 1) :] = False
                at = np.flatnonzero(own)
                at = at[of[at + k - 1] == of[at]]
                if bits is not None:
                    known = (bits[places[k - 2] >> np.uint64(3)] >> (places[k - 2] & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
                    at = at[(known[at] & known[at + 1]) > 0]
                if not len(at):
                    continue
                phrases = _strings(data, starts[at], ends[at + k - 1] - starts[at], pa.string())
                langs = part.column(0).dictionary_encode()
                table = pa.table({"lang": pa.DictionaryArray.from_arrays(pa.array(langs.indices.to_numpy()[of[at]]), langs.dictionary).cast(pa.string()), "phrase": phrases, "n": part.column(3).take(pa.array(of[at]))})
                held.append(_summed([table]))
                fresh += held[-1].num_rows
                if fresh >= HELD:
                    held = [_summed(held)]
                    fresh = 0
                    if held[0].num_rows >= HELD // 2:
                        yield from held.pop().combine_chunks().to_batches(max_chunksize=20_000)
        if held:
            yield from _summed(held).combine_chunks().to_batches(max_chunksize=20_000)

    return run


def _placed(k: int, window: int):
    """Places in the bitmap of phrases of ``k`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1, window):
                data, offsets = _contents(part.column(1))
                _, _, of, places = _grams(data, offsets, _seeds(part.column(0)), k)
                heads = np.searchsorted(of, np.arange(part.num_rows))
                yield pa.RecordBatch.from_arrays([pa.array(places[k - 1][heads].astype(np.int64))], names=["place"])

    return run


def _bitmap(phrases: DataFrame, k: int, window: int) -> bytes:
    """A bit for each of some phrases, of 2^BITS; rows of 4 KB are made by the executors, 2^BITS / 32768 at most."""
    spaced = phrases.select("lang", F.concat("phrase", F.lit(" ")).alias("phrase"))
    places = spaced.mapInArrow(_placed(k, window), "place long")
    blocks = places.groupBy((F.col("place") / 32768).cast("long").alias("block")).agg(F.bitmap_construct_agg(F.col("place") % 32768).alias("bits"))
    out = bytearray(1 << (BITS - 3))
    for row in blocks.collect():
        out[row.block * 4096 : (row.block + 1) * 4096] = row.bits
    return bytes(out)


def counts(chunks: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST, window: int = WINDOW) -> list[DataFrame]:
    """``lang, phrase, f`` of all phrases of 1, 2, ... words that occur ``least`` times, one table for each length.

    A phrase occurs no more often than what it is made of, so only those are counted whose first and last words but
    one are frequent, as far as a bitmap of fixed size can tell.
    """
    spark, out, frequent = chunks.sparkSession, [], None
    for k in range(1, most_words + 1):
        found = chunks.select("lang", "chunk", "owned", "times").mapInArrow(_counted(k, frequent, window), "lang string, phrase string, n long")
        found = found.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        out.append(scratch.write(found, f"phrases{k}"))
        if k < most_words:
            frequent = spark.sparkContext.broadcast(_bitmap(out[-1], k, window))
    return out


# Scores


def _exact(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def _scored(known: DataFrame, phrases: DataFrame) -> DataFrame:
    """``lang, phrase, a, k, l, r, score`` of phrases by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = phrases.withColumn("words", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    join = lambda part: F.array_join(part, " ")
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", join(F.slice("words", F.lit(1), F.col("k"))).alias("left"), join(F.slice("words", F.col("k") + 1, F.size("words"))).alias("right"))
    lefts, rights = (known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)) for side, name in (("left", "l"), ("right", "r")))
    cuts = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
    whole = F.expr("cast((cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    best = cuts.withColumn("score", whole).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.*")


def _covered(levels: list[DataFrame], share: int) -> DataFrame:
    """``lang, phrase, most``: phrases that lie inside a longer one, and how often the most frequent of these occurs."""
    inside = None
    for k, longer in enumerate(levels, 1):
        if k < 3:
            continue
        parts = [(i, n) for n in range(2, k) for i in range(1, k - n + 2)]
        cut = longer.withColumn("words", F.split("phrase", " "))
        own = cut.select("lang", F.col("f").alias("most"), F.explode(F.array(*[F.array_join(F.slice("words", i, n), " ") for i, n in parts])).alias("phrase"))
        inside = own if inside is None else inside.unionByName(own)
    return inside.groupBy("lang", "phrase").agg(F.max("most").alias("most"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_words: int = MOST_WORDS, least: int = LEAST, share: int = SHARE, top: int = TOP, window: int = WINDOW) -> DataFrame:
    """The best phrases of 2 to ``most_words`` words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are cut into pieces at punctuation and line ends and into words at spaces and tabs, only A-Z lower-cased.
    ``a``, ``l`` and ``r`` are the occurrences of the phrase and of the two parts of its lowest-scoring cut, ``n`` the
    words of the language, and the score is floor(2000000 a / (l + r)). Phrases of fewer than ``least`` occurrences
    don't count, nor do those that lie inside a longer one with ``share`` percent of their occurrences. Null and empty
    texts have no words, a null language is ``und``, repeated rows count as often as they are there, other columns
    don't matter, and an empty table gives no rows.

    Texts are parsed into overlapping chunks whose ends depend on the words alone, so what is repeated gives the same
    chunks, which are counted once with their frequency. No text, language or phrase is gathered in one task.
    """
    if most_words < 2:
        raise ValueError("a phrase has two words at least")
    chunks = scratch.write(dictionary(docs, text_col, lang_col, most_words, window), "chunks")
    sizes = chunks.groupBy("lang").agg(F.sum(F.col("owned") * F.col("times")).alias("n"))
    levels = counts(chunks, most_words, least, window)
    known = levels[0]
    for more in levels[1:]:
        known = known.unionByName(more)
    phrases = levels[1]
    for more in levels[2:]:
        phrases = phrases.unionByName(more)
    found = _scored(known, phrases)
    if most_words > 2:
        found = found.join(_covered(levels, share), ["lang", "phrase"], "left")
        found = found.where(F.col("most").isNull() | (_exact(F.col("most")) * 100 < _exact(F.col("a")) * share))
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    dealt = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    dealt = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "salt")
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '{NO_LANG}') AS lang, {_SMALL} AS text FROM documents),
pieces AS (SELECT d, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece, generate_subscripts(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]'), 1) AS p FROM docs),
words AS (SELECT d, p, lang, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) AS w, generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) AS i FROM pieces),
sizes AS (SELECT lang, count(*)::BIGINT AS n FROM words GROUP BY lang),
runs AS (SELECT lang, [w, {", ".join(f"lead(w, {k}) OVER s" for k in range(1, MOST_WORDS))}] AS w FROM words WINDOW s AS (PARTITION BY d, p ORDER BY i)),
f AS MATERIALIZED (SELECT lang, k, array_to_string(w[1 : k], ' ') AS phrase, count(*)::BIGINT AS f FROM runs, range(1, {MOST_WORDS + 1}) t(k) WHERE w[k] IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
parts AS MATERIALIZED (SELECT lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS first, array_to_string(w[cut + 1 :], ' ') AS second FROM c, range(1, {MOST_WORDS}) t(cut) WHERE cut < k),
cuts AS (SELECT p.lang, p.phrase, a, cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score FROM parts p
      JOIN f x ON x.lang = p.lang AND x.phrase = first JOIN f y ON y.lang = p.lang AND y.phrase = second),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, a, unnest(list_transform(range(1, k - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS phrase FROM c JOIN range(2, {MOST_WORDS}) t(n) ON n < k),
most AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN most USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < {SHARE}::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN sizes USING (lang) WHERE rank <= {TOP}
"""
