"""Conversation prefix trie: which conversations begin alike, and what sharing their heads saves.

Each prefix of a conversation has a 128-bit digest, the running combination of hashes of its turns
with their depths, so prefixes are digested without holding a conversation. A count-min sketch of
all prefix digests screens them: an estimate of one proves that no other conversation begins so,
and then the same holds for every longer prefix. Such tails leave as nodes at once; only prefixes
that may be shared are shuffled and grouped by digest.

Sums over subtrees need no walk through levels. A node belongs to its smallest member, and once a
conversation owns a node it owns all nodes below on its path. So a conversation adds to each node
above: one leaf if it owns the node it ends in, the lengths of the turns on its path that it does
not own, and one child where its first own node hangs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.grouping import numbered_within
from larder.llm.common import frequent_cells, has_bit, shared_array, stored, width_for

BLOCK_BITS = 12  # turns of one conversation are sorted and summed in blocks of this many bits
SKETCH_ROWS = 3
MOST_CELLS = 1 << 26  # cells of a row of the sketch, one bit each; the sketch grows up to that
LEAST_CELLS = 1 << 12
HOT_SHARE = 10_000  # a node with more than one in so many of all prefixes is broadcast: so many at most
IDS_A_CHUNK_BITS = 8
_NO_TURN = -(1 << 62)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, place, one, two, n_chars): place from 0 by turn (null first), role and text.

    ``one`` and ``two`` are hashes of role and text. A null role or text is empty; rows without
    conv_id belong to no conversation and are left out.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turn = F.col("turn").cast("long")
    read = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"),
        F.coalesce(F.shiftright(turn, BLOCK_BITS), F.lit(_NO_TURN)).alias("_block"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    placed = numbered_within(read, "conv_id", "_block", order, "place")
    return placed.select(
        "conv_id",
        (F.col("place") - 1).alias("place"),
        F.xxhash64("role", "text").alias("one"),
        F.xxhash64(F.lit("two"), F.col("text"), F.col("role")).alias("two"),
        F.length("text").cast("long").alias("n_chars"),
    )


def rebuilt(turns: DataFrame, shared: int = 6, family: int = 100) -> DataFrame:
    """Numbered turns where each conversation takes its head from the first one of its family.

    Conversation c starts with the first h turns of conversation c - c % family (fewer if it is
    shorter, none if it is absent), h = crc32(decimal c) % shared, and goes on with its own turns
    after its first h. Gives (conv_id, depth, one, two, n_chars, n_turns); depth counts from 1, and
    every conversation also has a row of depth 0, so those without turns are there as well.
    """
    head = F.crc32(F.col("conv_id").cast("string")) % shared
    first = F.col("conv_id") - F.col("conv_id") % family
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    firsts = sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    taken = (
        sizes.select("conv_id", "n", head.alias("head"), first.alias("first"))
        .join(firsts, "first", "left")
        .withColumn("taken", F.least("head", F.coalesce("n_first", F.lit(0))))
        .withColumn("n_turns", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
        .select("conv_id", "first", "head", "taken", "n_turns")
    )
    columns = ["conv_id", "depth", "one", "two", "n_chars", "n_turns"]
    heads = (
        turns.filter(F.col("place") < shared - 1)
        .withColumnRenamed("conv_id", "first")
        .join(taken, "first")
        .filter("place < head")
        .withColumn("depth", F.col("place") + 1)
    )
    own = (
        turns.filter(F.col("place") >= head)
        .join(taken, "conv_id")
        .withColumn("depth", F.col("taken") + F.col("place") - F.col("head") + 1)
    )
    zero = F.lit(0).cast("long")
    roots = taken.select("conv_id", zero.alias("depth"), zero.alias("one"), zero.alias("two"), zero.alias("n_chars"), "n_turns")
    return heads.select(columns).unionByName(own.select(columns)).unionByName(roots)


def _running(df: DataFrame, group: str, place: str, sums: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds running values over ``place`` inside ``group``: name -> (aggregate, column).

    Values run inside blocks; the totals of earlier blocks are joined, so a long group is spread.
    ``aggregate`` is bit_xor or sum.
    """
    combine = {"sum": lambda a, b: a + b, "bit_xor": lambda a, b: a.bitwiseXOR(b)}
    function = {"sum": F.sum, "bit_xor": F.bit_xor}
    df = df.withColumn("_block", F.shiftright(place, BLOCK_BITS))
    totals = df.groupBy(group, "_block").agg(*[function[a](c).alias(f"_{n}") for n, (a, c) in sums.items()])
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        group, "_block", *[F.coalesce(function[a](f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n, (a, _) in sums.items()]
    )
    inside = Window.partitionBy(group, "_block").orderBy(place)
    for name, (aggregate, column) in sums.items():
        df = df.withColumn(name, function[aggregate](column).over(inside))
    df = df.join(starts, [group, "_block"])
    for name, (aggregate, _) in sums.items():
        df = df.withColumn(name, combine[aggregate](F.col(name), F.col(f"_{name}")))
    return df.drop("_block", *[f"_{n}" for n in sums])


def digested(turns: DataFrame) -> DataFrame:
    """Rows of ``rebuilt`` with the digest (key_one, key_two) of each prefix and ``upto``, its code points."""
    root = F.col("depth") == 0
    tagged = turns.withColumn("one", F.when(root, F.lit(0)).otherwise(F.xxhash64("depth", "one", "two"))).withColumn(
        "two", F.when(root, F.lit(0)).otherwise(F.xxhash64(F.col("two"), F.lit("two"), F.col("one"), F.col("depth")))
    )
    run = _running(tagged, "conv_id", "depth", {
        "key_one": ("bit_xor", "one"), "key_two": ("bit_xor", "two"), "upto": ("sum", "n_chars"),
    })
    return run.select("conv_id", "depth", "key_one", "key_two", "n_chars", "upto", "n_turns")


def _cells(one: np.ndarray, two: np.ndarray, width: int) -> np.ndarray:
    """One cell for each row of the sketch, as positions in one array."""
    one, two = one.astype(np.uint64), two.astype(np.uint64) | np.uint64(1)
    places = [(one + np.uint64(j) * two) >> np.uint64(20) & np.uint64(width - 1) for j in range(SKETCH_ROWS)]
    return np.stack([p.astype(np.int64) + j * width for j, p in enumerate(places)])


def screened(prefixes: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """Adds ``alone_from`` per conversation: the least depth whose prefix is proven to be its alone."""
    keys = prefixes.filter("depth > 0").select("key_one", "key_two")
    width = width_for(4 * keys.count(), LEAST_CELLS, most_cells)

    def hits(batch: pa.RecordBatch) -> np.ndarray:
        return _cells(np.asarray(batch.column(0)), np.asarray(batch.column(1)), width).ravel()

    sketch = shared_array(prefixes, frequent_cells(keys, hits, SKETCH_ROWS * width, 2))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = sketch()
        for batch in batches:
            cells = _cells(np.asarray(batch.column("key_one")), np.asarray(batch.column("key_two")), width)
            alone = ~has_bit(repeated, cells).all(axis=0)  # a cell that was hit once bounds the count by one
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("depth"), pa.array(alone)], ["conv_id", "depth", "alone"]
            )

    judged = prefixes.filter("depth > 0").select("conv_id", "depth", "key_one", "key_two").mapInArrow(
        judge, "conv_id long, depth long, alone boolean"
    )
    least = judged.filter("alone").groupBy("conv_id").agg(F.min("depth").alias("alone_from"))
    return prefixes.join(least, "conv_id", "left")


def _with_nodes(members: DataFrame, nodes: DataFrame, n_members: int) -> DataFrame:
    """Members with the columns of their node; the few nodes with very many members are broadcast."""
    keys = ["key_one", "key_two"]
    hot = F.col("n_convs") * HOT_SHARE > F.lit(n_members)
    first = members.join(F.broadcast(nodes.filter(hot)), keys, "left")
    rest = first.filter("owner IS NULL").select(*members.columns).join(nodes.filter(~hot), keys)
    return first.filter("owner IS NOT NULL").unionByName(rest)


def _ends(members: DataFrame) -> DataFrame:
    """Rows (key_one, key_two, ends_sha256) of the nodes some conversation ends in.

    The hash runs over all ids in order, so it is sequential by nature; ids are sorted in chunks of
    close ids on many tasks first, and the last step reads chunks as a stream.
    """
    keys = ["key_one", "key_two"]
    chunks = (
        members.filter("depth = n_turns")
        .withColumn("chunk", F.shiftright("conv_id", IDS_A_CHUNK_BITS))
        .groupBy(*keys, "chunk")
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for one, two, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "ids"))):
                if (one, two) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (one, two), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*keys, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], [*keys, "ends_sha256"])

    ordered = chunks.repartition(*keys).sortWithinPartitions(*keys, "chunk")
    return ordered.mapInArrow(digest, "key_one long, key_two long, ends_sha256 string")


def trie(prefixes: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per node of the trie of ``digested`` prefixes.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (code points that members beyond the first repeat, over the subtree) and ends_sha256. Without
    conversations there is no node. All tables handed on are written, so lost executors cost a step.
    """
    prefixes = stored(prefixes, "prefixes")
    marked = stored(screened(prefixes, most_cells), "screened")
    shared = F.col("alone_from").isNull() | (F.col("depth") < F.col("alone_from"))
    members = marked.filter(shared)
    ends_here = (F.col("depth") == F.col("n_turns")).cast("long")
    nodes = members.groupBy("key_one", "key_two").agg(
        F.count(F.lit(1)).alias("n_convs"), F.sum(ends_here).alias("n_ends"), F.min("conv_id").alias("owner")
    )
    nodes = stored(nodes, "nodes")
    n_members = nodes.agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0]
    known = stored(_with_nodes(members, nodes, n_members), "members")

    owned = F.col("conv_id") == F.col("owner")
    not_owned = lambda c: F.when(~owned, F.col(c))
    per_conv = known.groupBy("conv_id").agg(
        F.coalesce(F.min(F.when(owned, F.col("depth"))), F.first("alone_from")).alias("owns_from"),
        F.max_by(not_owned("owner"), not_owned("depth")).alias("hangs_on"),
        F.max(not_owned("upto")).alias("not_owned_upto"),
        F.greatest(
            F.first("alone_from").isNotNull().cast("long"),
            F.max((owned & (F.col("n_convs") == F.col("n_ends"))).cast("long")),
        ).alias("leaf"),
        F.first("alone_from").alias("alone_from"),
        F.first("n_turns").alias("n_turns"),
    )
    per_conv = stored(per_conv, "owners")
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") == F.col("owns_from"), F.col("hangs_on")).otherwise(F.col("conv_id"))
    with_conv = known.drop("alone_from", "n_turns").join(per_conv, "conv_id")
    before_owned = F.col("owns_from").isNull() | (F.col("depth") < F.col("owns_from"))
    goes_on = F.col("depth") < F.col("n_turns")
    inner = with_conv.groupBy("key_one", "key_two").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.max(F.when(owned, parent)).alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum((goes_on & (F.col("depth") + 1 >= F.col("owns_from"))).cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.when(before_owned, F.col("not_owned_upto") - F.col("upto") + F.col("n_chars")).otherwise(0)).alias("saved_tokens"),
    )
    inner = inner.join(_ends(members), ["key_one", "key_two"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))
    )

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    one = F.lit(1).cast("long")
    first_alone = per_conv.filter("alone_from IS NOT NULL").withColumn("depth", F.col("alone_from")).withColumn("parent_conv_id", parent)
    later = marked.filter(F.col("depth") > F.col("alone_from")).withColumn("parent_conv_id", F.col("conv_id"))

    def tail(df: DataFrame) -> DataFrame:
        return df.select(
            "conv_id", "depth", "parent_conv_id", one.alias("n_convs"),
            goes_on.cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
            F.when(goes_on, F.lit(EMPTY_SHA256)).otherwise(F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends_sha256"),
        )

    return inner.select(columns).unionByName(tail(first_alone)).unionByName(tail(later))
