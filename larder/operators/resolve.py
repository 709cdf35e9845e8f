"""Entity resolution for materials without a barcode: which known SKU their record most likely means.

Descriptions are sets of q-grams. The rarest q-grams of a record are its blocking keys, as many as
make sure that two records of the least similarity share one; so no pair is missed and frequent
q-grams join nothing. Pairs are compared field by field, and the weights of agreement are learned by
expectation maximisation over the counts of comparison patterns, without labels.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import config
from larder.session import work_dir

SETTINGS = config.ResolutionSettings()
SIMILARITY = "similarity_level"
FIELDS = ("base_uom", "material_group", "material_type", "shelf_life_days")
MISSING = 2  # level of a field that one side does not have; 1 agrees, 0 differs


def grams(text: Column, q: int = SETTINGS.gram) -> Column:
    """Distinct q-grams of the words of a text; empty without letters or digits."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    padded = F.concat(F.lit(" "), plain, F.lit(" "))
    places = F.sequence(F.lit(1), F.greatest(F.length(padded) - (q - 1), F.lit(1)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.transform(places, lambda i: F.substring(padded, i, F.lit(q))))
    )


def _blocked(records: DataFrame, frequency: DataFrame, least: float) -> DataFrame:
    """Rows (id, n_grams, key): the rarest q-grams of each record."""
    ranked = (
        records.select("id", F.size("grams").alias("n_grams"), F.explode("grams").alias("key"))
        .join(frequency.hint("merge"), "key")
        .groupBy("id", "n_grams")
        .agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("ranked"))
    )
    keys = F.col("n_grams") - F.ceil(F.col("n_grams") * least - 1e-9) + 1
    return ranked.select("id", "n_grams", F.explode(F.slice("ranked", F.lit(1), keys.cast("int"))).alias("r")).select(
        "id", "n_grams", "r.key"
    )


def candidate_pairs(
    unknown: DataFrame, known: DataFrame, settings: config.ResolutionSettings = SETTINGS
) -> DataFrame:
    """All pairs (left_id, right_id, similarity) whose q-gram sets have at least the least Jaccard similarity.

    Both sides have ``id`` and ``grams``; records without grams are in no pair. The joins name their
    method: texts that repeat fill small files, by whose size a broadcast would be picked.
    """
    counts = unknown.select(F.explode("grams").alias("key")).unionByName(known.select(F.explode("grams").alias("key")))
    frequency = counts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    side = lambda df, name: _blocked(df, frequency, settings.least_similarity).withColumnsRenamed(
        {"id": f"{name}_id", "n_grams": f"{name}_n"}
    )
    near = (F.col("left_n") >= F.col("right_n") * settings.least_similarity - 1e-9) & (
        F.col("right_n") >= F.col("left_n") * settings.least_similarity - 1e-9
    )
    pairs = side(unknown, "left").join(side(known, "right").hint("merge"), "key").filter(near).select("left_id", "right_id").distinct()
    sets = lambda df, name: df.select(F.col("id").alias(f"{name}_id"), F.col("grams").alias(f"{name}_grams"))
    both = pairs.join(sets(unknown, "left").hint("merge"), "left_id").join(sets(known, "right").hint("merge"), "right_id")
    shared = F.size(F.array_intersect("left_grams", "right_grams"))
    share = shared / (F.size("left_grams") + F.size("right_grams") - shared)
    return both.select("left_id", "right_id", share.alias("similarity")).filter(
        F.col("similarity") >= settings.least_similarity
    )


def compared(pairs: DataFrame, records: DataFrame, settings: config.ResolutionSettings = SETTINGS) -> DataFrame:
    """Adds the level of similarity and of agreement in every field."""
    steps = sum((F.when(F.col("similarity") >= s, 1).otherwise(0) for s in settings.similarity_steps), F.lit(0))
    fields = lambda name: records.select(F.col("id").alias(f"{name}_id"), *[F.col(f).alias(f"{name}_{f}") for f in FIELDS])
    both = pairs.join(fields("left").hint("merge"), "left_id").join(fields("right").hint("merge"), "right_id")
    levels = {
        f: F.when(F.col(f"left_{f}").isNull() | F.col(f"right_{f}").isNull(), MISSING)
        .when(F.col(f"left_{f}") == F.col(f"right_{f}"), 1).otherwise(0)
        for f in FIELDS
    }
    return both.select("left_id", "right_id", "similarity", steps.alias(SIMILARITY), *[c.alias(f) for f, c in levels.items()])


def record_classes(records: DataFrame) -> DataFrame:
    """Records that agree in q-grams and all fields as one: ``id`` is the smallest of theirs, ``n`` their number.

    Copies of one record are alike in every comparison, so a class stands for them. Records without an
    id or without grams are in no class. The classes are written once.
    """
    path = work_dir(records.sparkSession, "classes")
    grouped = records.filter(F.col("id").isNotNull() & (F.size("grams") > 0)).groupBy("grams", *FIELDS).agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n")
    )
    grouped.write.parquet(path)
    return records.sparkSession.read.schema(grouped.schema).parquet(path)


def members(records: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (id, class): every record with the id of its class."""
    named = classes.select("grams", *FIELDS, F.col("id").alias("class"))
    same = F.lit(True)
    for c in ("grams", *FIELDS):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return records.filter(F.col("id").isNotNull()).alias("a").join(named.alias("b").hint("merge"), same).select("a.id", "b.class")


def expanded(pairs: DataFrame, left: DataFrame, right: DataFrame, cell: int = 10_000) -> DataFrame:
    """Pairs of classes as pairs of their members.

    Members of a class are dealt to cells of about ``cell`` records, so no task holds a whole large class.
    """
    cells = right.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("_cells"))
    dealt = right.join(cells.hint("merge"), "class").select(
        F.col("class").alias("right_id"), F.pmod(F.xxhash64("id"), F.col("_cells")).cast("int").alias("_cell"), F.col("id").alias("_right")
    )
    spread = pairs.join(cells.withColumnRenamed("class", "right_id").hint("merge"), "right_id").withColumn(
        "_cell", F.explode(F.sequence(F.lit(0), F.col("_cells") - 1))
    )
    named = left.select(F.col("class").alias("left_id"), F.col("id").alias("_left"))
    both = spread.join(named.hint("merge"), "left_id").join(dealt.hint("merge"), ["right_id", "_cell"])
    rest = [c for c in pairs.columns if c not in ("left_id", "right_id")]
    return both.select(F.col("_left").alias("left_id"), F.col("_right").alias("right_id"), *rest)


@dataclass(frozen=True)
class MatchWeights:
    """Share of matches among pairs, and per field the chance of each level among matches and others."""

    share: float
    matches: tuple[tuple[float, ...], ...]
    others: tuple[tuple[float, ...], ...]

    def probability(self, pattern: Sequence[int]) -> float:
        odds = self.share / (1 - self.share)
        for level, m, u in zip(pattern, self.matches, self.others):
            odds *= m[level] / u[level]
        return odds / (1 + odds)


def fit_weights(counts: dict[tuple[int, ...], int], levels: Sequence[int], rounds: int = 200) -> MatchWeights:
    """Expectation maximisation over pattern counts, with fields independent among matches and among others.

    It starts from high levels meaning a match. Half a pair per level keeps chances above zero.
    """
    rising = [[2.0 ** k for k in range(n)] for n in levels]
    rising = [r if i == 0 else [0.1, 0.8, 0.1] for i, r in enumerate(rising)]
    even = [[1.0] * n for n in levels]
    normal = lambda rows: tuple(tuple(x / sum(r) for x in r) for r in rows)
    weights = MatchWeights(0.1, normal(rising), normal(even))
    total = sum(counts.values())
    for _ in range(rounds):
        if not total:
            break
        m = [[0.5] * n for n in levels]
        u = [[0.5] * n for n in levels]
        matched = 0.0
        for pattern, n in counts.items():
            p = weights.probability(pattern) * n
            matched += p
            for i, level in enumerate(pattern):
                m[i][level] += p
                u[i][level] += n - p
        share = min(max(matched / total, 0.5 / (total + 1)), 1 - 0.5 / (total + 1))
        now = MatchWeights(share, normal(m), normal(u))
        done = math.isclose(now.share, weights.share, rel_tol=1e-9)
        weights = now
        if done:
            break
    return weights


def sku_resolution(registry: DataFrame, settings: config.ResolutionSettings = SETTINGS) -> DataFrame:
    """The registry with materials that lack a barcode joined to the SKU they most likely are.

    Barcoded rows keep their id at confidence 1. Others take the id of their most probable partner if
    it is likely enough, with the probability (below 1) as confidence and ``resolved_to`` as its
    material; the rest keep their synthetic id at 0. Ties go to the most similar and then the first
    partner. Classes of equal records are compared, counted by the pairs of records they stand for, and
    the first record of a class is its partner, so copies cost no pairs. Only counts of comparison
    patterns, a few hundred at most, pass through the driver.
    """
    spark, path = registry.sparkSession, work_dir(registry.sparkSession, "resolution")
    records = registry.select(
        F.col("sap_material_number").alias("id"), "unified_sku_id", "ean_barcode", grams(F.col("material_description"), settings.gram).alias("grams"), *FIELDS
    ).filter(F.col("id").isNotNull())
    records.write.parquet(f"{path}/records")
    records = spark.read.schema(records.schema).parquet(f"{path}/records")
    unknown, known = records.filter("ean_barcode IS NULL"), records.filter("ean_barcode IS NOT NULL")
    left, right = record_classes(unknown), record_classes(known)
    pairs = compared(candidate_pairs(left, right, settings), left.unionByName(right), settings)
    for name, side in (("left", left), ("right", right)):
        size = side.select(F.col("id").alias(f"{name}_id"), F.col("n").alias(f"{name}_size"))
        pairs = pairs.join(size.hint("merge"), f"{name}_id")
    pairs = pairs.withColumn("_size", F.col("left_size") * F.col("right_size")).drop("left_size", "right_size")
    pairs.write.parquet(f"{path}/pairs")
    pairs = spark.read.schema(pairs.schema).parquet(f"{path}/pairs")
    names = [SIMILARITY, *FIELDS]
    sizes = pairs.groupBy(*names).agg(F.sum("_size").alias("count"))
    counts = {tuple(r[n] for n in names): r["count"] for r in sizes.collect()}
    levels = [len(settings.similarity_steps) + 1, *[3] * len(FIELDS)]
    weights = fit_weights(counts, levels)
    rows = [(*pattern, weights.probability(pattern)) for pattern in counts]
    chances = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names) + ", _chance double")
    best = (
        pairs.join(F.broadcast(chances), names)  # one row per pattern
        .groupBy("left_id")
        .agg(F.min(F.struct((-F.col("_chance")).alias("c"), (-F.col("similarity")).alias("s"), "right_id")).alias("best"))
        .select(F.col("left_id").alias("class"), (-F.col("best.c")).alias("_chance"), F.col("best.right_id").alias("_to"))
    )
    best = best.filter(F.col("_chance") >= settings.least_probability)
    named = known.select(F.col("id").alias("_to"), F.col("unified_sku_id").alias("_sku"))
    of_class = best.join(named.hint("merge"), "_to")
    found = members(unknown, left).join(of_class.hint("merge"), "class").drop("class").withColumnRenamed("id", "sap_material_number")
    joined = registry.join(found.hint("merge"), "sap_material_number", "left")
    exact = F.col("ean_barcode").isNotNull()
    return joined.withColumns({
        "unified_sku_id": F.when(exact, F.col("unified_sku_id")).otherwise(F.coalesce("_sku", "unified_sku_id")),
        "match_confidence": F.when(exact, F.lit(1.0))
        .when(F.col("_chance").isNull(), F.lit(0.0)).otherwise(F.least("_chance", F.lit(settings.most_probability))),
        "resolved_to": F.when(~exact, F.col("_to")),
    }).drop("_chance", "_to", "_sku")
