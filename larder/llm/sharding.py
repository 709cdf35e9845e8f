"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A key belongs to the next virtual node clockwise. A shard takes its own keys first; what
it has no room for goes on clockwise to the next shard with room, so no shard exceeds its
bound and a change of the ring moves few keys. Only one count per arc leaves the executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from larder.functions.grouping import numbered_within

POINTS = 1 << 16  # places on the ring
NODES_PER_SHARD = 64
_SPLITS = 64  # parts of an arc, for numbering its rows in several tasks


def ring(shards: Sequence[int], nodes: int = NODES_PER_SHARD) -> list[tuple[int, int]]:
    """Places of the virtual nodes and their shards, clockwise; one node per place."""
    places: dict[int, int] = {}
    for shard in sorted(shards):
        for node in range(nodes):
            digest = hashlib.blake2b(f"{shard}:{node}".encode(), digest_size=8).digest()
            places.setdefault(int.from_bytes(digest, "little") % POINTS, shard)
    if set(places.values()) != set(shards):
        raise ValueError("too many shards for the places on the ring")
    return sorted(places.items())


def arc_table(nodes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Arc of every place: the number of the next node clockwise."""
    out, arc = [], 0
    for place in range(POINTS):
        while arc < len(nodes) and nodes[arc][0] < place:
            arc += 1
        out.append((place, arc % len(nodes)))
    return out


def bounds(total: int, shards: Sequence[int], slack: float) -> dict[int, int]:
    """Most rows per shard: the mean and ``slack``; without slack counts differ by one at most."""
    names = sorted(shards)
    if slack > 0:
        most = -(-int(total * (1 + slack) * 1000) // (1000 * len(names))) + 1
        return dict.fromkeys(names, most)
    return {s: total // len(names) + (i < total % len(names)) for i, s in enumerate(names)}


def plan(nodes: list[tuple[int, int]], counts: dict[int, int], room: dict[int, int]) -> list[tuple]:
    """Segments (arc, first, end, shard, slot): which rows of an arc go to which shard."""
    left, slots, segments = dict(room), dict.fromkeys(room, 0), []

    def take(arc: int, first: int, n: int, shard: int) -> None:
        segments.append((arc, first, first + n, shard, slots[shard]))
        slots[shard] += n
        left[shard] -= n

    over: list[list[tuple[int, int]]] = []
    for arc, (_, shard) in enumerate(nodes):
        n, own = counts.get(arc, 0), min(counts.get(arc, 0), left[shard])
        if own:
            take(arc, 0, own, shard)
        over.append([(own, n)] if n > own else [])
    waiting: list[tuple[int, int, int]] = []
    for lap in range(2):
        for arc, (_, shard) in enumerate(nodes):
            while waiting and left[shard]:
                source, first, end = waiting.pop(0)
                n = min(end - first, left[shard])
                take(source, first, n, shard)
                if first + n < end:
                    waiting.insert(0, (source, first + n, end))
            if lap == 0:
                waiting += [(arc, first, end) for first, end in over[arc]]
    return segments


def assign(
    df: DataFrame,
    key: str,
    shards: Sequence[int],
    slack: float = 0.0,
    into: str = "placed",
    nodes: int = NODES_PER_SHARD,
) -> DataFrame:
    """Adds the struct ``into``: shard, slot (0.. without gaps in a shard), arc.

    Every row is placed, repeated rows one by one; a null key has a fixed place on the
    ring. Rows of an arc are ordered by the hash of the key and all columns that can be
    ordered. The counts of the arcs and the plan have at most shards times nodes entries.
    """
    spark = df.sparkSession
    rest = df.drop(into)
    names = rest.columns
    places = ring(shards, nodes)
    arcs = spark.createDataFrame(arc_table(places), "_place int, _arc int")
    mixed: Column = F.xxhash64(F.lit("ring"), F.col(f"`{key}`"))
    given = rest.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
        mixed.alias("_hash"),
        F.pmod(mixed, F.lit(POINTS)).cast("int").alias("_place"),
    )
    on_arc = given.join(F.broadcast(arcs), "_place").withColumn(
        "_part", F.pmod(F.shiftrightunsigned("_hash", 16), F.lit(_SPLITS)).cast("int")
    )
    counts = {r[0]: r[1] for r in on_arc.groupBy("_arc").agg(F.count(F.lit(1))).collect()}
    total = sum(counts.values())
    segments = plan(places, counts, bounds(total, shards, slack))
    schema = StructType(
        [StructField("_arc", IntegerType())] + [StructField(c, LongType()) for c in ("_first", "_end")]
        + [StructField("_shard", IntegerType()), StructField("_slot", LongType())]
    )
    chosen = spark.createDataFrame(segments, schema)
    ranked = numbered_within(on_arc, "_arc", "_part", ["_hash", "_row"], "_rank")
    place = F.col("_rank") - 1
    found = ranked.join(F.broadcast(chosen), "_arc").filter((place >= F.col("_first")) & (place < F.col("_end")))
    return found.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in names],
        F.struct(
            F.col("_shard").alias("shard"),
            (F.col("_slot") + place - F.col("_first")).alias("slot"),
            F.col("_arc").alias("arc"),
        ).alias(into),
    )


def write_shards(placed: DataFrame, path: str, into: str = "placed", rows_per_file: int = 1_000_000) -> None:
    """Writes one folder per shard; a shard is cut by slot, so no task holds a whole one."""
    part = F.floor(F.col(f"{into}.slot") / rows_per_file)
    flat = placed.withColumns({"shard": F.col(f"{into}.shard"), "_part": part, "_slot": F.col(f"{into}.slot")})
    (
        flat.repartition("shard", "_part").sortWithinPartitions("shard", "_slot").drop(into, "_part", "_slot")
        .write.partitionBy("shard").parquet(path)
    )
