"""Benchmark decontamination by spaced seeds.

A seed hashes some of the words of a window and ignores the others, by a fixed mask, so a
few replaced words do not hide an overlap. Seeds of the documents meet those of the test
items; around each hit the words of both are laid side by side, and an overlap counts if
enough words of some window agree. Items too short for that are looked up whole. In scripts
without spaces every letter is a word. Everything is a built-in expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed masks: 1 is a word that counts, 0 one that may differ. Wherever 10 words of a window of 13
# agree, one of the masks lies on agreeing words only, so no overlap lacks a seed.
MASKS = ("1101111", "1110100011", "111001011", "11010111", "101000110101")
WINDOW = 13
LEAST_EQUAL = 10
BROADCAST_SEEDS = 500_000
# Scripts without spaces between words. Their letters count half a word: items that consist mostly
# of them need twice as many equal ones, in a window twice as long, half of which meets the masks.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}&&\p{L}]"


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; in UNSPACED scripts single letters."""
    apart = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"({UNSPACED})", " $1 ")
    return F.filter(F.split(apart, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _hashed(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    words = df.select(F.col(f"`{key}`").alias(name), words_of(F.col(f"`{text}`")).alias("_words"))
    return words.select(name, F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))


def _items(items: DataFrame, key: str, text: str) -> DataFrame:
    """Hashed items with _scale: 2 where most words are letters of UNSPACED scripts, else 1."""
    words = items.filter(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("item"), words_of(F.col(f"`{text}`")).alias("_words")
    )
    letters = F.size(F.filter("_words", lambda w: w.rlike(f"^{UNSPACED}$")))
    return words.select(
        "item",
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        F.when(2 * letters > F.size("_words"), 2).otherwise(1).alias("_scale"),
    )


def _seed_rows(hashed: DataFrame, name: str, masks: Sequence[str], at: str) -> DataFrame:
    """Rows (name, at, _seed): every mask at every place of the words where it fits."""
    places = hashed.select(name, "_hashes", F.explode(F.expr("sequence(0, size(_hashes))")).alias(at))
    seeds = []
    for number, mask in enumerate(masks):
        chosen = ", ".join(f"get(_hashes, {at} + {j})" for j, c in enumerate(mask) if c == "1")
        seeds.append(f"CASE WHEN {at} + {len(mask)} <= size(_hashes) THEN xxhash64({number}, {chosen}) END")
    listed = places.select(name, at, F.explode(F.array(*[F.expr(s) for s in seeds])).alias("_seed"))
    return listed.filter("_seed IS NOT NULL")


def _best(equal: Column, window: Column) -> Column:
    """Most agreeing words in a window of that many words (or all, if there are fewer)."""
    last = F.greatest(F.size(equal) - window, F.lit(0))
    return F.array_max(
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.aggregate(F.slice(equal, i + 1, window), F.lit(0), lambda a, e: a + e),
        )
    )


def overlaps(
    df: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    masks: Sequence[str] = MASKS,
    least_equal: int = LEAST_EQUAL,
) -> DataFrame:
    """Confirmed overlaps: doc, item, start (word of the document where the item would begin), n_equal.

    Documents and items with fewer than ``least_equal`` words have no overlap here (see
    ``whole_copies``); so have null and empty texts. MASKS find every overlap for 10 of 13; other masks or a smaller ``least_equal``
    may miss some. Null keys meet nothing. Rows with equal keys count as one document
    or item, repeated rows change nothing, and other columns are ignored.
    """
    docs = _hashed(df.filter(F.col(f"`{key}`").isNotNull()), key, text, "doc")
    tests = _items(items, item_key, item_text)
    test_seeds = _seed_rows(tests, "item", masks, "_item_at").distinct()
    if test_seeds.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        test_seeds = F.broadcast(test_seeds)
    hits = (
        _seed_rows(docs, "doc", masks, "_doc_at")
        .join(test_seeds, "_seed")
        .groupBy("doc", "item", (F.col("_doc_at") - F.col("_item_at")).alias("start"))
        .agg(F.count(F.lit(1)).alias("n_seeds"))
    )
    aligned = hits.join(tests.withColumnRenamed("_hashes", "_theirs"), "item").join(
        docs.withColumnRenamed("_hashes", "_ours"), "doc"
    )
    skip = F.greatest(-F.col("start"), F.lit(0))
    ours = F.slice("_ours", F.greatest(F.col("start"), F.lit(0)) + 1, F.greatest(F.size("_theirs") - skip, F.lit(0)))
    theirs = F.slice("_theirs", skip + 1, F.size("_theirs"))
    laid = aligned.select("doc", "item", "start", "_scale", ours.alias("_ours"), theirs.alias("_theirs"))
    equal = F.zip_with("_ours", "_theirs", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    flagged = laid.select("doc", "item", "start", "_scale", equal.alias("_equal")).select(
        "doc",
        "item",
        "start",
        "_scale",
        _best(F.col("_equal"), F.col("_scale") * WINDOW).alias("n_best"),
        F.aggregate("_equal", F.lit(0), lambda a, e: a + e).alias("n_equal"),
    )
    return flagged.filter(F.col("n_best") >= F.col("_scale") * least_equal).drop("_scale").distinct()


def whole_copies(
    df: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    masks: Sequence[str] = MASKS,
    least_equal: int = LEAST_EQUAL,
) -> DataFrame:
    """Items with too few words for ``overlaps`` that a document holds word for word: doc, item, n_equal.

    An item of one word is found in every document with that word. Items without words meet nothing.
    """
    short = _items(items, item_key, item_text).withColumn("n_equal", F.size("_hashes"))
    short = short.filter((F.col("n_equal") > 0) & (F.col("n_equal") < F.col("_scale") * least_equal)).select(
        "item", "n_equal", F.xxhash64("n_equal", "_hashes").alias("_seed")
    ).distinct()
    lengths = sorted(r["n_equal"] for r in short.select("n_equal").distinct().collect())  # fewer than 2 * least_equal
    if short.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        short = F.broadcast(short)
    docs = _hashed(df.filter(F.col(f"`{key}`").isNotNull()), key, text, "doc")
    places = docs.select("doc", "_hashes", F.explode(F.expr("sequence(0, size(_hashes))")).alias("_at"))
    runs = [
        F.expr(f"CASE WHEN _at + {n} <= size(_hashes) THEN xxhash64({n}, slice(_hashes, _at + 1, {n})) END")
        for n in lengths
    ] or [F.lit(None).cast("long")]
    listed = places.select("doc", F.explode(F.array(*runs)).alias("_seed")).filter("_seed IS NOT NULL")
    return listed.join(short, "_seed").select("doc", "item", "n_equal").distinct().filter(F.lit(bool(lengths)))


def contaminated(df: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row per contaminated document: the key, item_ids, n_equal (most agreeing words)."""
    found = overlaps(df, items, key=key, **options).select("doc", "item", "n_equal")
    found = found.unionByName(whole_copies(df, items, key=key, **options))
    best = found.groupBy("doc", "item").agg(F.max("n_equal").alias("n_equal"))
    return best.groupBy(F.col("doc").alias(key)).agg(
        F.sort_array(F.collect_set("item")).alias("item_ids"), F.max("n_equal").cast("long").alias("n_equal")
    )


def clean(df: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df``, with all their columns, whose document overlaps no item."""
    return df.join(contaminated(df, items, key, **options).select(key), key, "left_anti").select(*df.columns)
