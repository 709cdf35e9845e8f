"""Document fingerprints: a hash tree over paragraphs and sections.

A paragraph is a piece of text up to the end of a sentence or line, 48 characters at most;
the first 64 characters are cut into pieces of 8, so that short texts branch too. 16
paragraphs make a section. The root is equal for equal texts; sections and paragraphs
that differ show where two texts were edited. A fingerprint is the root, a colon and eight
hex digits per paragraph. Everything is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARAGRAPH = r"[^\n.!?]{1,48}[\n.!?]*|[\n.!?]+"
HEAD, HEAD_PIECE = 64, r"[^\n.!?]{1,8}[\n.!?]*|[\n.!?]+"
SECTION = 16
LEAF_DIGITS = 8
_SPLIT = r"(?<=\G.{8})"


def paragraphs(text: Column) -> Column:
    """Pieces of the text, in order and without gaps."""
    return F.concat(
        F.regexp_extract_all(F.left(text, F.lit(HEAD)), F.lit(f"({HEAD_PIECE})"), F.lit(1)),
        F.regexp_extract_all(F.substring(text, HEAD + 1, 2**31 - 1), F.lit(f"({PARAGRAPH})"), F.lit(1)),
    )


def _sections(hashes: Column) -> Column:
    starts = F.when(F.size(hashes) > 0, F.sequence(F.lit(1), F.size(hashes), F.lit(SECTION)))
    cut = F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(hashes, i, SECTION), ""), 256))
    return F.coalesce(cut, F.expr("cast(array() AS array<string>)"))


def with_fingerprint(df: DataFrame, text: str, into: str) -> DataFrame:
    """Adds the string ``into``. Null texts count as empty; the root of no paragraphs is that of ''."""
    names = [c for c in df.columns if c != into]
    hashed = df.select(
        *[F.col(f"`{c}`") for c in names],
        F.transform(paragraphs(F.coalesce(F.col(text), F.lit(""))), lambda p: F.sha2(p, 256)).alias("_hashes"),
    )
    leaves = F.array_join(F.transform(F.col("_hashes"), lambda h: F.left(h, F.lit(LEAF_DIGITS))), "")
    root = F.sha2(F.array_join(_sections(F.col("_hashes")), ""), 256)
    return hashed.select(*[F.col(f"`{c}`") for c in names], F.concat(root, F.lit(":"), leaves).alias(into))


def root_of(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, ":", 1)


def leaves_of(fingerprint: Column) -> Column:
    """Short paragraph hashes, in order."""
    parts = F.split(F.substring_index(fingerprint, ":", -1), _SPLIT)
    return F.filter(parts, lambda p: p != "")


def likeness(one: Column, other: Column) -> Column:
    """Shared share of the distinct paragraphs of two fingerprints, 1 for equal roots."""
    a, b = leaves_of(one), leaves_of(other)
    shared = F.size(F.array_intersect(a, b)).cast("double")
    every = F.size(F.array_union(a, b))
    return F.when(root_of(one) == root_of(other), F.lit(1.0)).otherwise(shared / F.greatest(every, F.lit(1)))


def edited_sections(one: Column, other: Column) -> Column:
    """Numbers of the sections, from 0, whose paragraphs differ between two fingerprints."""
    a, b = leaves_of(one), leaves_of(other)
    last = F.floor((F.greatest(F.size(a), F.size(b)) - 1) / SECTION).cast("int")
    numbers = F.when(last >= 0, F.sequence(F.lit(0), last))
    differ = F.filter(
        numbers,
        lambda i: ~F.slice(a, i * SECTION + 1, SECTION).eqNullSafe(F.slice(b, i * SECTION + 1, SECTION)),
    )
    return F.coalesce(differ, F.expr("cast(array() AS array<int>)"))


def _bucket(value: Column, bounds: list[float]) -> Column:
    """Number of bounds up to the value, looked up in two steps."""
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    numbers = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    if not groups:
        return F.lit(0)
    coarse = F.size(F.filter(numbers([g[0] for g in groups]), lambda b: b <= value))
    fine = F.element_at(F.array(*[numbers(g) for g in groups]), F.greatest(coarse, F.lit(1)))
    return F.when(coarse == 0, 0).otherwise(
        (coarse - 1) * step + F.size(F.filter(fine, lambda b: b <= value))
    )


def with_next(df: DataFrame, order: str, values: list[str], prepare=lambda d: d) -> DataFrame:
    """Adds next_<value> of the row that follows by ``order`` (after the last: the first).

    Rows are dealt to ranges of about equal counts; the first row of a range is copied to
    the range before it, so no task sees more than a range. Rows with equal ``order`` follow
    each other by ``values``. A null ``order`` has no place: its next values are null.
    ``prepare`` adds columns after the rows are dealt. Other names with a leading underscore
    must be free.
    """
    ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.col(order).cast("double")
    bounds = df.select(place.alias("_p")).approxQuantile("_p", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    dealt = df.withColumn("_range", F.when(place.isNotNull(), _bucket(place, sorted(set(bounds)))).otherwise(
        -1 - F.pmod(F.xxhash64(*values), F.lit(ranges))))
    firsts = dealt.filter(place.isNotNull()).groupBy("_range").agg(F.min(order).alias("_first"))
    by_range = Window.orderBy("_range")
    ends = firsts.select(
        F.col("_first").alias(order),
        F.coalesce(F.lag("_range").over(by_range), F.max("_range").over(Window.partitionBy())).alias("_before"),
    )
    twice = dealt.join(F.broadcast(ends), order, "left").select(
        *dealt.drop("_range").columns,
        F.explode(F.filter(
            F.array(F.struct(F.lit(0).alias("copy"), F.col("_range").alias("range")),
                    F.struct(F.lit(1).alias("copy"), F.col("_before").alias("range"))),
            lambda s: s["range"].isNotNull(),
        )).alias("_at"),
    )
    spread = prepare(
        twice.select(*dealt.drop("_range").columns, F.col("_at.copy").alias("_copy"), F.col("_at.range").alias("_range"))
        .repartition("_range")
    )
    following = Window.partitionBy("_range").orderBy("_copy", order, *values)
    wanted = [c for c in spread.columns if c not in ("_copy", "_range", order)]
    return spread.withColumns(
        {f"next_{c}": F.when(F.col(order).isNotNull(), F.lead(c).over(following)) for c in wanted}
    ).filter("_copy = 0").drop("_copy", "_range")


def compare_with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last floor(n/4) characters replaced by the first as many of the
    next text by ``key`` (all of a shorter one). Null texts count as empty, other columns
    are ignored, repeated rows stay repeated. A row with a null key is edited with nothing
    and has a null near_next.
    """
    given = df.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    pairs = with_next(given, key, ["_text"], lambda d: with_fingerprint(d, "_text", "_print"))
    n = F.length("_text")
    edited = F.concat(
        F.expr("left(_text, length(_text) - floor(length(_text) / 4))"),
        F.coalesce(F.expr("left(next__text, cast(floor(length(_text) / 4) AS int))"), F.lit("")),
    )
    named = pairs.select(
        key, n.cast("long").alias("n_chars"), "_print", F.col("next__print").alias("_next"), edited.alias("_edited")
    )
    both = with_fingerprint(named.withColumn("edited_sha256", F.sha2(F.col("_edited"), 256)), "_edited", "_other")
    return both.select(
        key,
        "n_chars",
        "edited_sha256",
        F.col("_print").alias("fingerprint"),
        F.col("_other").alias("edited_fingerprint"),
        likeness(F.col("_print"), F.col("_other")).alias("near_edited"),
        likeness(F.col("_print"), F.col("_next")).alias("near_next"),
        edited_sections(F.col("_print"), F.col("_other")).alias("edited_sections"),
    )
