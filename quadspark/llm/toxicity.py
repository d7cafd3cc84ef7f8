"""Toxicity scores: gradient-boosted trees over dense features of whole texts, with isotonic calibration."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadspark.llm import scratch

#: Labelled rows that a model is fitted on at most, chosen by a hash of their id; all of them where there are fewer.
MOST_ROWS = 60_000
#: Words, and word beginnings of each length, that the lexicon learns at most; a score from here on predicts 1.
LEXICON, THRESHOLD = 2_000, 0.3
#: A word must be in so many toxic texts and stand out by so many standard deviations.
LEAST_TEXTS, LEAST_SIGMA = 5, 5.0
_TREES, _DEPTH, _SEED = 40, 4, 7
_BEGINNINGS = (4, 5)

# Common insults, and second-person words, in four languages.
INSULTS = frozenset(
    "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb ugly jerk bastard fool filth "
    "dummkopf trottel abschaum widerlich blödmann arschloch imbécile crétin salaud connard minable "
    "idiota estúpido imbécil basura asqueroso cabrón inútil".split()
)
SECOND_PERSON = frozenset("you your yours yourself u du dich dir dein deine ihr euch tu toi te ton ta vous votre tú usted ustedes vosotros tus".split())

_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[^\W\d_][0-9@$*!|]+[^\W\d_]")
_DRAWN = re.compile(r"([^\W\d_])\1\1")
_UPPER, _LOUD, _MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!?", b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PLAIN = str.maketrans("0134578@$!|", "oieastbasil")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features(text: str | None, words: dict[str, float], starts: dict[str, float]) -> list[float]:
    """The dense features of one text; zeros for an empty one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    found = _WORD.findall(text.lower())
    n, size = max(1, len(found)), max(1, len(text))
    hits = [i for i, w in enumerate(found) if w in words or w in INSULTS]
    weights = [words.get(found[i], 1.0) for i in hits]
    begun = [starts[w[:k]] for w in found for k in _BEGINNINGS if len(w) > k and w[:k] in starts]
    near = sum(1 for i in hits if not SECOND_PERSON.isdisjoint(found[max(0, i - 3) : i + 4]))
    masked = _MASKED.findall(text) if len(raw) != len(raw.translate(None, b"0123456789@$*!|")) else []
    hidden = sum(1 for w in set(re.findall(r"\S+", text)) if (p := w.lower().translate(_PLAIN).strip(".,;:!?\"'()")) in INSULTS and w.lower().strip(".,;:!?\"'()") not in INSULTS) if masked else 0
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    return [
        sum(1 for i in hits if found[i] in INSULTS) / n,
        len(hits) / n,
        float(min(len(hits), 50)),
        sum(weights) / n,
        max(weights, default=0.0),
        float(len({found[i] for i in hits})),
        len(begun) / n,
        sum(begun) / n,
        float(min(len(begun), 50)),
        near / n,
        sum(1 for w in found if w in SECOND_PERSON) / n,
        count(_UPPER) / size,
        count(_LOUD) / size,
        count(_MARKS) / size,
        len(masked) / n,
        hidden / n,
        float(bool(_DRAWN.search(text))),
        float(min(n, 5000)),
    ]


@dataclass
class Model:
    """Learned word weights, boosted trees and calibration; ``trees`` is None where there was nothing to learn from."""

    words: dict[str, float]
    starts: dict[str, float]
    trees: Any = None
    calibration: Any = None


def _featured(rows: DataFrame, text_col: str, model: Model) -> DataFrame:
    """``_own``, a struct of all columns of ``rows``, whatever their names, and ``_features``."""
    words, starts = model.words, model.starts
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_own"))
    schema = T.StructType([*packed.schema.fields, T.StructField("_features", T.ArrayType(T.DoubleType()))])
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                made = pa.array([features(t, words, starts) for t in part.column(0).flatten()[at].to_pylist()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), made], names=["_own", "_features"])

    return packed.mapInArrow(run, schema)


def _lexicon(terms: DataFrame, positive: int, total: int) -> dict[str, float]:
    """Terms of ``doc, toxic, term`` that mark toxic texts, with their log odds; a bounded number of them."""
    rate = positive / total
    counts = terms.groupBy("term").agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).where(f"p >= {LEAST_TEXTS}")
    sigma = (F.col("p") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    weight = F.log((F.col("p") + 0.5) / (positive + 1)) - F.log((F.col("n") - F.col("p") + 0.5) / (total - positive + 1))
    best = counts.select("term", sigma.alias("sigma"), weight.alias("weight")).where(f"sigma >= {LEAST_SIGMA} and weight > 1")
    return {r.term: r.weight for r in best.orderBy(F.desc("sigma"), "term").limit(LEXICON).collect()}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from labelled documents that are not held out.

    At most MOST_ROWS of them take part, chosen by a hash of the id. Half of them give the lexicon, three tenths
    the trees and two tenths the calibration, so nothing is judged on rows it was learned from. Null labels, ids
    and texts are left out. Without both labels in the rows the model predicts 0.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    count = known.count()
    if count > MOST_ROWS:
        share = int(MOST_ROWS * 0.97 / count * (1 << 32))
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 32)) < share)
    known = known.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(10)))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    rows = scratch.write(own.join(F.broadcast(known), "doc_id"), "labelled")
    first = rows.where("fold < 5")
    positive, total = first.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    if not 0 < positive < total:
        return Model({}, {})
    terms = first.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("term")).where("length(term) > 1")
    words = _lexicon(terms, positive, total)
    begun = first.select("toxic", F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")).alias("all"))
    cut = lambda k: F.transform(F.filter("all", lambda w: F.length(w) > k), lambda w: F.substring(w, 1, k))
    starts = _lexicon(begun.select("toxic", F.explode(F.array_distinct(F.concat(*[cut(k) for k in _BEGINNINGS]))).alias("term")), positive, total)
    model = Model(words, starts)
    featured = scratch.write(_featured(rows.where("fold >= 5").select("text", "toxic", "fold"), "text", model).select("_own.toxic", "_own.fold", "_features"), "features")
    scratch.discard(rows)
    ready = featured.select(F.col("toxic").cast("double").alias("label"), "fold", array_to_vector("_features").alias("features"))
    if ready.where("fold < 8").select("label").distinct().count() < 2:
        return model
    model.trees = GBTClassifier(maxIter=_TREES, maxDepth=_DEPTH, seed=_SEED, maxBins=64).fit(ready.where("fold < 8"))
    rest = model.trees.transform(ready.where("fold >= 8")).select("label", vector_to_array("probability")[1].alias("raw"))
    if not rest.isEmpty():
        model.calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(rest)
    scratch.discard(featured)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``score`` from 0 to 1 and ``predicted`` to every row; columns of those names are replaced, others of any name stay.

    Null and empty texts are scored as texts without words, repeated rows alike, and an empty table gives no rows.
    The score is the calibrated probability with a fiftieth of the trees' own, which keeps the order within a step.
    """
    rows = _featured(docs.drop("score", "predicted"), text_col, model)
    if model.trees is None:
        made = F.lit(0.0)
    else:
        rows = model.trees.transform(rows.withColumn("_vector", array_to_vector("_features")), {model.trees.featuresCol: "_vector", model.trees.probabilityCol: "_probability", model.trees.rawPredictionCol: "_raw", model.trees.predictionCol: "_predicted"})
        rows = rows.withColumn("_tree", vector_to_array("_probability")[1])
        made = F.col("_tree")
        if model.calibration is not None:
            rows = model.calibration.transform(rows, {model.calibration.featuresCol: "_tree", model.calibration.predictionCol: "_calibrated"})
            made = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(0.98) * F.col("_calibrated") + F.lit(0.02) * F.col("_tree")))
    kept = [F.col(f"_own.`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    return rows.select(*kept, made.alias("score"), (made >= THRESHOLD).cast("int").alias("predicted"))
