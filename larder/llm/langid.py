"""Language ID: known words first, then ever shorter character n-grams.

Word counts per language are gathered from all training rows. The most frequent words of a
language are its known words; the n-grams of all its words, each weighted by the count of
its word, serve unseen words: every position takes the longest known n-gram that starts there.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from larder.llm.common import short_batches, slices, stored, with_struct

UNKNOWN = "und"
LONGEST = 4
MOST_WORDS = 20_000  # known words per language
MOST_GRAMS = 20_000  # n-grams per language
SMOOTHING = 0.5
UNSEEN_WEIGHT = 0.5
EVIDENCE = 10.0  # words after which more text adds no confidence
_FLUSH = 200_000
_CACHE = 100_000
_AT_ONCE = 20_000
_WORD = re.compile(r"[^\W\d_]+")
_CUT = 64  # a longer word is counted and scored by its pieces of this length


def words_of(text: str | None) -> list[str]:
    found = _WORD.findall((text or "").lower())
    if found and max(map(len, found)) > _CUT:
        found = [w[i : i + _CUT] for w in found for i in range(0, len(w), _CUT)]
    return found


def _word_counts(labelled: DataFrame) -> DataFrame:
    """Rows (lang, word, n) over all of ``labelled`` (text, lang), summed in each task first."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def out(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counter)), pa.array(list(counter)), pa.array(list(counter.values()), pa.int64())],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for part in slices(batches):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, counts.values())) > _FLUSH:
                yield from out(counts)
                counts = {}
        yield from out(counts)

    return short_batches(labelled).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")
    )


def _most_frequent(counts: DataFrame, unit: str, most: int) -> DataFrame:
    """At most ``most`` units per language: those above a count, found on the counts of counts."""
    sizes = counts.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("units"))
    upto = Window.partitionBy("lang").orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0)
    least = (
        sizes.withColumn("upto", F.sum("units").over(upto)).filter(F.col("upto") <= most)
        .groupBy("lang").agg(F.min("n").alias("least"))
    )
    return counts.join(F.broadcast(least), "lang").filter("n >= least").select("lang", unit, "n")


class Model:
    """Log frequencies per language of known words and n-grams."""

    def __init__(self, langs: list[str], totals: dict, words: list, grams: list):
        self.langs = langs
        at = {lang: i for i, lang in enumerate(langs)}
        self.words = self._table(words, at, [totals.get(lang, 0) for lang in langs])
        sums: dict[int, list[float]] = {}
        for lang, gram, n in grams:
            sums.setdefault(len(gram), [0.0] * len(langs))[at[lang]] += n
        self.grams: dict[str, list[float]] = {}
        for size, sizes in sums.items():
            self.grams.update(self._table([g for g in grams if len(g[1]) == size], at, sizes))

    @staticmethod
    def _table(counts: list, at: dict[str, int], totals: list[float]) -> dict[str, list[float]]:
        table: dict[str, list[float]] = {}
        for lang, unit, n in counts:
            table.setdefault(unit, [0.0] * len(at))[at[lang]] = float(n)
        size = len(table)
        bottom = [math.log(t + SMOOTHING * size + 1) for t in totals]
        return {u: [math.log(n + SMOOTHING) - b for n, b in zip(ns, bottom)] for u, ns in table.items()}

    def unseen(self, word: str) -> list[float] | None:
        """Mean over the positions of the longest known n-gram that starts there."""
        marked, total, found = f"<{word}>", [0.0] * len(self.langs), 0
        for i in range(len(marked)):
            for size in range(LONGEST, 0, -1):
                logs = self.grams.get(marked[i : i + size]) if i + size <= len(marked) else None
                if logs:
                    total = [a + b for a, b in zip(total, logs)]
                    found += 1
                    break
        return [UNSEEN_WEIGHT * t / found for t in total] if found else None


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.table = np.zeros((len(model.words) + 1 + _CACHE + _AT_ONCE, len(model.langs)), dtype=np.float32)
        self.known = {w: i for i, w in enumerate(model.words)}
        if model.words:
            self.table[: len(model.words)] = list(model.words.values())
        self.size = len(model.words)

    def _index(self, word: str) -> int:
        i = self.known.get(word)
        if i is None:
            logs = self.model.unseen(word)
            i = self.size
            self.table[i] = logs if logs else 0.0
            self.known[word] = i
            self.size += 1
        return i

    def __call__(self, text: str | None) -> dict:
        words = words_of(text)
        if not words or not self.model.langs:
            return {"lang": UNKNOWN, "score": 0.0}
        total, n = np.zeros(len(self.model.langs)), len(words)
        for begin in range(0, n, _AT_ONCE):
            if self.size > len(self.model.words) + _CACHE:  # only here, where no row is in use
                self.known = {w: i for i, w in enumerate(self.model.words)}
                self.size = len(self.known)
            some = words[begin : begin + _AT_ONCE]
            get = self.known.get
            at = [get(w) for w in some]
            if None in at:
                at = [self._index(w) if i is None else i for w, i in zip(some, at)]
            total += self.table[at].sum(axis=0, dtype=np.float64)
        if not total.any():
            return {"lang": self.model.langs[0], "score": 0.0}
        odds = total / n * min(n, EVIDENCE)
        odds = np.exp(odds - odds.max())
        best = int(np.argmax(np.round(odds, 12)))
        return {"lang": self.model.langs[best], "score": round(float(odds[best] / odds.sum()), 6)}


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Model from all rows with a language; null texts add nothing.

    What reaches the driver is bounded by MOST_WORDS and MOST_GRAMS per language.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL")
    counts = stored(_word_counts(rows), "words")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    marked = counts.withColumn("marked", F.concat(F.lit("<"), "word", F.lit(">")))
    grams = marked.select(
        "lang",
        "n",
        F.explode(F.flatten(F.array(*[
            F.expr(
                f"CASE WHEN length(marked) >= {k} THEN transform(sequence(1, length(marked) - {k - 1}),"
                f" i -> substring(marked, i, {k})) ELSE cast(array() AS array<string>) END"
            )
            for k in range(1, LONGEST + 1)
        ]))).alias("gram"),
    ).filter(~F.col("gram").isin("<", ">")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    grams = stored(grams, "grams")
    words = [tuple(r) for r in _most_frequent(counts, "word", MOST_WORDS).collect()]
    kept = [tuple(r) for r in _most_frequent(grams, "gram", MOST_GRAMS).collect()]
    return Model(sorted(totals), totals, sorted(words), sorted(kept))


RESULT = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])


def identify(
    df: DataFrame, model: Model, text: str = "text", into: str = "language", keep: list[str] | None = None
) -> DataFrame:
    """Adds the struct ``into``: lang and score (0 to 1, the share of the best language).

    Null texts and texts without a letter get "und" and 0; so do all texts if the model saw
    no language. A text of which the model knows no word and no n-gram has score 0. Equal scores go to the first language by name. Other columns and repeated
    rows stay (``keep`` names fewer columns); an existing column ``into`` is replaced.
    """
    def setup():
        scorer = Scorer(model)
        return lambda texts: [scorer(t) for t in texts]

    return with_struct(df, [text], into, RESULT, setup, keep)
