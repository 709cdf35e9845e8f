"""Toxicity: boosted trees over dense features, calibrated by isotonic regression.

The lexicon (words and word beginnings) is learned from labelled rows. Features are its
densities, how near its words stand to a second person, capitals, punctuation and
obfuscation. Trees and calibration come from pyspark.ml.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from larder.llm.common import short_batches, slices, stored, with_struct

# Bound of the fit: labelled rows. The lexicon takes every entry of theirs that passes both limits.
MOST_ROWS = 40_000
LEAST_TOXIC = 5
LEAST_RATIO = 6.0
BEGINNINGS = (4, 5, 6)
TREES, DEPTH, RATE = 30, 4, 0.2
CALIBRATION_FOLDS = 4
SEED = 7
# Words of the second person.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu toi te ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestra".split()
)
NEAR = 4
PLAIN = str.maketrans("013457@$!|", "oieastasii")
_WORD = re.compile(r"\w+(?:[@$!|*.'-]+\w+)*")
_PIECE = re.compile(r"\w+")
_CACHE = 100_000
FEATURES = 16
STRONG = 3.0
# Capital letters and punctuation among the first 256 code points.
_CAPITALS = [c for c in range(256) if chr(c).isupper()]
_MARKS = [ord(c) for c in "?.,;:*%&#$"]


def entries_of(word: str) -> list[str]:
    """The word, the pieces of a joined word, and the beginnings of all of them, which end in a star."""
    found = [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]
    if not word.isalnum():
        for piece in _PIECE.findall(word):
            found += [piece, *(piece[:k] + "*" for k in BEGINNINGS if len(piece) > k)]
    return found


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Entry to log ratio, from rows (text, label); their number bounds that of the entries."""
    schema = pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            counts = (Counter(), Counter())
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                words = set(_WORD.findall((text or "").lower()))
                counts[label == 1].update({e for w in words for e in entries_of(w)})
            every = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(every, pa.string()), pa.array([counts[1][e] for e in every], pa.int64()),
                 pa.array([counts[0][e] for e in every], pa.int64())], schema=schema,
            )

    seen = short_batches(labelled).mapInArrow(run, "entry string, toxic long, clean long").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    ).filter(F.col("toxic") >= LEAST_TOXIC)
    n = labelled.agg(F.sum(F.col("label")), F.count(F.lit(1))).first()
    bad, good = max(int(n[0] or 0), 1), max(int(n[1] or 0) - int(n[0] or 0), 1)
    ratio = F.log(F.col("toxic") / bad / ((F.col("clean") + 0.5) / good))
    best = seen.withColumn("ratio", ratio).filter(F.col("ratio") >= math.log(LEAST_RATIO))
    return {r["entry"]: float(r["ratio"]) for r in best.collect()}


class Features:
    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > _CACHE:
                self.known.clear()
            found = self.known[word] = max([self.lexicon.get(e, 0.0) for e in entries_of(word)])
        return found

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        raw = _WORD.findall(text)
        n = len(raw)
        if not n:
            return [0.0] * FEATURES
        words = [w.lower() for w in raw]
        get = self.known.get
        weights = [get(w) for w in words]
        if None in weights:
            weights = [self.weight(w) if x is None else x for w, x in zip(words, weights)]
        hits = [i for i, w in enumerate(weights) if w]
        found = sorted((weights[i] for i in hits), reverse=True)
        strong = sum(w > STRONG for w in found)
        persons = [] if SECOND_PERSON.isdisjoint(words) else [i for i, w in enumerate(words) if w in SECOND_PERSON]
        near = 0
        if hits and persons:
            at = np.searchsorted(persons, hits)
            p = np.array([-(10**9), *persons, 10**9])
            near = int((np.minimum(np.abs(p[at] - hits), np.abs(p[at + 1] - hits)) <= NEAR).sum())
        odd = [] if all(map(str.isalpha, words)) else [w for w in words if not w.isalpha()]
        hidden = sum(
            1 for w in odd
            if self.weight(re.sub(r"[^\w]|_", "", w.translate(PLAIN))) > 0 and self.weight(w) == 0
        )
        length = len(text)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        seen = np.bincount(np.minimum(codes, 256), minlength=257)
        return [
            len(hits) / n,
            sum(found) / n,
            found[0] if found else 0.0,
            sum(found[:3]),
            math.log1p(len(hits)),
            strong / n,
            math.log1p(strong),
            near / n,
            len(persons) / n,
            float(seen[_CAPITALS].sum()) / length,
            sum(map(str.isupper, raw)) / n,
            float(seen[ord("!")]) / length,
            float(seen[_MARKS].sum()) / length,
            sum(any(map(str.isalpha, w)) for w in odd) / n,
            hidden / n,
            math.log1p(n),
        ]


VECTOR = StructType([StructField("features", ArrayType(DoubleType()))])


def with_features(
    df: DataFrame, lexicon: dict[str, float], text: str, into: str, keep: list[str] | None = None
) -> DataFrame:
    def setup():
        features = Features(lexicon)
        return lambda texts: [{"features": features(t)} for t in texts]

    return with_struct(df, [text], into, VECTOR, setup, keep)


@dataclass
class Model:
    """A fitted scorer; without both labels it gives every text the share of label 1."""

    lexicon: dict[str, float]
    trees: object | None
    calibration: object | None
    share: float


def sample(labels: DataFrame, key: str, most: int = MOST_ROWS) -> DataFrame:
    """At most about ``most`` rows, picked by the hash of their key: all, if there are fewer."""
    n = labels.count()
    if n <= most:
        return labels
    return labels.filter(F.pmod(F.xxhash64(F.lit(SEED), key), F.lit(1_000_000)) < int(1_000_000 * 0.95 * most / n))


def fit(labelled: DataFrame) -> Model:
    """Fits on rows (key, text, label); null labels are left out.

    One row in CALIBRATION_FOLDS, by the hash of its key, calibrates and is not fitted on.
    """
    rows = stored(labelled.filter("label IS NOT NULL").select("key", "text", F.col("label").cast("int").alias("label")), "labelled")
    fold = F.pmod(F.xxhash64(F.lit(SEED + 1), "key"), F.lit(CALIBRATION_FOLDS))
    fitted = rows.filter(fold != 0)
    n = fitted.agg(F.sum("label"), F.count(F.lit(1))).first()
    bad, every = int(n[0] or 0), int(n[1] or 0)
    if not bad or bad == every:
        return Model({}, None, None, bad / every if every else 0.0)
    lexicon = learn_lexicon(fitted)
    table = stored(with_features(rows, lexicon, "text", "made", ["key", "label"]).select("key", "label", "made.features"), "features")
    vectors = table.withColumn("features", array_to_vector("features"))
    grower = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=SEED
    )
    trees = grower.fit(vectors.filter(fold != 0).coalesce(6))
    held = trees.transform(vectors.filter(fold == 0)).select(
        vector_to_array("probability")[1].alias("raw"), F.col("label").cast("double").alias("label")
    )
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(held) if not held.isEmpty() else None
    return Model(lexicon, trees, calibration, bad / every)


def score(
    df: DataFrame, model: Model, text: str = "text", into: str = "toxicity", keep: list[str] | None = None
) -> DataFrame:
    """Adds the double ``into``, 0 to 1, from the text alone.

    Null and empty texts have all features 0 and are scored like any other. Rows, also
    repeated ones, and other columns stay (``keep`` names fewer); an existing column ``into`` is replaced.
    """
    rest = df.drop(into)
    names = list(keep) if keep is not None else rest.columns
    if model.trees is None:
        return rest.select(*[F.col(f"`{c}`") for c in names]).withColumn(into, F.lit(float(model.share)))
    packed = rest.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    made = with_features(packed, model.lexicon, "_text", "_made", ["_row"]).select(
        "_row", array_to_vector("_made.features").alias("features")
    )
    raw = model.trees.transform(made).select("_row", vector_to_array("probability")[1].alias("raw"))
    if model.calibration is not None:
        raw = model.calibration.setPredictionCol("calibrated").transform(raw).select("_row", F.col("calibrated").alias("raw"))
    return raw.select(*[F.col(f"_row.`{c}`").alias(c) for c in names], F.round("raw", 6).alias(into))
