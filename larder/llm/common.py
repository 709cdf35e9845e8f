"""Shared pieces: written tables, per-row Python helpers, linked groups, bounded cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from larder.session import work_dir

SLICE_ROWS = 256
# Texts can be long, so the batches that Python tasks get are short, unless the session says otherwise.
BATCH_ROWS = 512
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back, which cuts the lineage."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def short_batches(df: DataFrame) -> DataFrame:
    """The same rows; sets the batch length of the session where it is still the default."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    return df


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Short slices, so that long texts are held as Python objects for few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def with_struct(
    df: DataFrame,
    inputs: Sequence[str],
    into: str,
    result: StructType,
    setup: Callable[[], Callable[..., list[dict | None]]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Adds the struct column ``into``, made from lists of the input columns.

    ``setup`` runs once per task and gives the function that makes it, so what the function
    keeps between calls goes with the task.
    All other columns, or those in ``keep``, pass through unread; a column already named
    ``into`` is replaced.
    """
    rest = df.drop(into)
    names = rest.columns
    given = short_batches(rest.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")))
    row_type = given.schema["_row"].dataType
    if keep is not None:
        names = list(keep)
        row_type = StructType([row_type[c] for c in names])
    schema = StructType([StructField("_row", row_type, False), StructField("_out", result)])
    wanted, row_fields = _arrow_struct(result), list(_arrow_struct(row_type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = setup()
        for part in slices(batches):
            rows = part.column("_row")
            made = pa.array(function(*[rows.field(c).to_pylist() for c in inputs]), type=wanted)
            if keep is None:
                kept = rows
            else:
                kept = pa.StructArray.from_arrays([rows.field(c) for c in names], fields=row_fields)
            yield pa.RecordBatch.from_arrays([kept, made], ["_row", "_out"])

    out = given.mapInArrow(run, schema)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in names], F.col("_out").alias(into))


def _arrow_struct(schema: StructType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """Smallest id reachable from every linked id: rows (id, root), linked ids only.

    ``links`` has columns a and b. Neighbours are joined to the smallest id around, first
    among larger ids, then among smaller ones, until the edges stay the same. Only edges
    move; every round is written, so no lineage builds up. Links with a null end are left out.
    """
    edges = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = stored(edges.distinct(), label)
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select("u", "v", "m")
        edges = small.select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.*").filter("u != v").distinct()
        edges = stored(edges, label)
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    row = edges.agg(F.count(F.lit(1)), digest).first()
    return (row[0], row[1])


def cells(df: DataFrame, group: str, member: str, size: Column, block: int) -> DataFrame:
    """Rows dealt to cells so that any two members of a group meet in one.

    A group of up to ``block`` rows is one cell. A larger one is cut into blocks, and each
    row goes to the cells of its block with every block. Adds cell_i, cell_j and part, the
    block of the row; two rows of one block meet in all its cells but count in (i, i) only.
    """
    blocks = F.ceil(size / F.lit(block)).cast("int")
    dealt = df.withColumn("_blocks", blocks).withColumn(
        "part", F.pmod(F.xxhash64(group, member), F.col("_blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        dealt.withColumn("_other", other)
        .withColumn("cell_i", F.least("part", "_other"))
        .withColumn("cell_j", F.greatest("part", "_other"))
        .drop("_blocks", "_other")
    )


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, from rows sorted by them, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        change[0] = last is not None and tuple(c[0] for c in columns) != last
        starts = np.flatnonzero(change)
        begin = 0
        for at in starts:
            if at > begin:
                held.append(batch.slice(begin, at - begin))
            if held:
                yield pa.Table.from_batches(held)
            held, begin = [], at
        held.append(batch.slice(begin))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


class Groups:
    """Union of positions 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True



STRETCH_BITS = 16
_HITS_HELD = 1 << 19


def frequent_cells(df: DataFrame, hits: Callable[[pa.RecordBatch], np.ndarray], width: int, least: int) -> np.ndarray:
    """Bits that say which of the cells 0..width-1 are hit ``least`` times or more (255 at most) by all rows.

    ``hits`` gives the cells of a batch. Tasks hand over counts of the cells they hit, stretch by
    stretch, and a second stage adds up the stretches, each in one task; so no task holds all
    cells, and the driver gets ``width / 8`` bytes. ``width`` is a multiple of 8.
    """
    mask = (1 << STRETCH_BITS) - 1

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        cells, n = np.unique(np.concatenate(held), return_counts=True)
        stretch = cells >> STRETCH_BITS
        begins = np.flatnonzero(np.r_[True, stretch[1:] != stretch[:-1]][: len(cells)])
        ends = np.r_[begins, len(cells)].astype(np.int32)

        def binary(values: np.ndarray) -> pa.Array:
            offsets = pa.py_buffer((ends * values.itemsize).astype(np.int32).tobytes())
            return pa.Array.from_buffers(pa.binary(), len(begins), [None, offsets, pa.py_buffer(values.tobytes())])

        return pa.RecordBatch.from_arrays(
            [pa.array(stretch[begins]), binary((cells & mask).astype(np.uint16)), binary(np.minimum(n, least).astype(np.uint8))],
            ["stretch", "cells", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(hits(batch))
            size += len(held[-1])
            if size > _HITS_HELD:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for stretch, cells, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                total = sums.setdefault(stretch, np.zeros(mask + 1, np.uint16))
                at = np.frombuffer(cells, np.uint16)
                total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), least)
        for stretch, total in sums.items():
            bits = np.packbits(total >= least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_pydict({"stretch": [stretch], "bits": [bits]})

    found = df.mapInArrow(count, "stretch long, cells binary, counts binary").repartition("stretch")
    out = np.zeros(width // 8, np.uint8)
    for row in found.mapInArrow(merge, "stretch long, bits binary").toLocalIterator():
        part = out[row.stretch << STRETCH_BITS >> 3 :][: 1 << STRETCH_BITS >> 3]
        part[:] = np.frombuffer(row.bits, np.uint8)[: len(part)]
    return out


def has_bit(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)


def shared_array(df: DataFrame, array: np.ndarray) -> Callable[[], np.ndarray]:
    """The array, sent once to every executor; tasks call the result to read it."""
    kind, sent = array.dtype, df.sparkSession.sparkContext.broadcast(array.tobytes())
    return lambda: np.frombuffer(sent.value, kind)


def width_for(n: int, least: int, most: int) -> int:
    """The least power of two that holds ``n``, between ``least`` and ``most``."""
    return min(max(least, 1 << max(n - 1, 0).bit_length()), most)
