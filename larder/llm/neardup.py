"""Near-duplicate groups with HyperMinHash.

1. Each text becomes its set of word shingles. Equal sets are one class, so exact copies are
   counted once.
2. A class keeps one register per bucket of its hash space: the number of leading zeros of
   the smallest hash and the bits that follow. Bands of registers are bucketed.
3. Inside a bucket, registers are compared and the Jaccard estimate, corrected for registers
   that agree by chance, must come within several standard errors of the threshold. The
   first bands are done first; later ones only where they still hold different groups.
4. Groups linked by estimates are verified on full sets, and only confirmed links count.

Members of large buckets and groups are dealt to cells of bounded size, and a task reports
the links that join something new, never all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Groups, cells, components, mix, runs, short_batches, slices, stored

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# 48 bands of 6 registers miss a pair at similarity 0.8 with probability 5e-7.
BANDS, ROWS = 48, 6
REGISTERS = BANDS * ROWS
FIRST_BANDS = 8
MANTISSA_BITS = 8
EMPTY = 0xFFFF
MARGIN = 5.5  # standard errors below the threshold that an estimate may lie
BUCKET_BLOCK = 1000
GROUP_BLOCK = 500
_WORDS_KEPT = 100_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    Words are runs without ASCII white space, A-Z lower-cased. A text with fewer words than
    a shingle has one shingle of them all; without words the set is empty.
    """

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > _WORDS_KEPT:
            known.clear()
        codes = [known.get(w) for w in words]
        if None in codes:
            for i, c in enumerate(codes):
                if c is None:
                    codes[i] = known[words[i]] = xxhash.xxh3_64_intdigest(words[i])
        hashed = np.array(codes, dtype=np.uint64)
        wide = min(self.words, len(hashed))
        total = hashed[: len(hashed) - wide + 1] + np.uint64(wide)
        for j in range(1, wide):
            total = mix(total * _STEP) + hashed[j : len(hashed) - wide + 1 + j]
        return np.unique(mix(total * _STEP))


_EDGES = np.array([-(-(b << 64) // REGISTERS) for b in range(REGISTERS)], dtype=np.uint64)
_WIDTH = 2.0**64 / REGISTERS


def registers(hashes: np.ndarray) -> np.ndarray:
    """Per bucket of the hash space: leading zeros and mantissa of the smallest hash."""
    at = np.searchsorted(hashes, _EDGES)
    upto = np.append(at[1:], len(hashes))
    there = at < upto
    rest = (hashes[at[there]] - _EDGES[there]).astype(np.float64) / _WIDTH
    share, exponent = np.frexp(np.maximum(rest, 2.0**-60))
    steps = 1 << MANTISSA_BITS
    out = np.full(REGISTERS, EMPTY, dtype=np.uint16)
    out[there] = -np.minimum(exponent, 0) * steps + ((2 * share - 1) * steps).astype(int)
    return out


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of two unrelated sets of n and m elements agree.

    The smallest of r elements per bucket is about exponential with rate r; a register
    value is a cell whose width halves with every leading zero.
    """
    a, b = np.asarray(n, float) / REGISTERS, np.asarray(m, float) / REGISTERS
    both = a + b
    total = np.zeros(np.broadcast(a, b).shape)
    for zeros in range(48):
        low, high = 2.0 ** -(zeros + 1), 2.0**-zeros
        total += low / (1 << MANTISSA_BITS) * (np.exp(-both * low) - np.exp(-both * high))
    return np.minimum(total * a * b / both / -np.expm1(-both), 0.5)


def similar(one: np.ndarray, n: int, others: np.ndarray, ns: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the corrected estimate against each row of ``others`` may reach the threshold."""
    used = ((one != EMPTY) | (others != EMPTY)).sum(axis=1)
    agree = ((one == others) & (one != EMPTY)).sum(axis=1)
    raw = agree / np.maximum(used, 1)
    least = threshold - MARGIN * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    ok = (used > 0) & (raw >= least)
    if ok.any():
        by_chance = chance(n, ns[ok])
        ok[ok] = (raw[ok] - by_chance) / (1 - by_chance) >= least[ok]
    return ok


def signatures(df: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Rows (id, n, class, regs): set size, 16-byte digest of the set, registers."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("class", pa.binary()), ("regs", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for part in slices(batches):
            rows = []
            for t in part.column("text").to_pylist():
                s = shingles(t)
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                rows.append((len(s), digest, registers(s).astype("<u2").tobytes()))
            n, digests, regs = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(regs, pa.binary())],
                schema=schema,
            )

    given = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return short_batches(given).mapInArrow(run, "id long, n long, class binary, regs binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, REGISTERS)


def bands(classes: DataFrame, first: int, end: int) -> DataFrame:
    """Rows (band, id, root) for the bands from ``first`` to ``end`` that hold a register."""
    schema = pa.schema([("band", pa.int64()), ("id", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            regs = _matrix(part.column("regs"))
            ids, roots = part.column("id").to_numpy(), part.column("root").to_numpy()
            for band in range(first, end):
                own = regs[:, band * ROWS : (band + 1) * ROWS]
                there = (own != EMPTY).any(axis=1)
                code = np.full(len(own), band + 1, dtype=np.uint64)
                for j in range(ROWS):
                    code = mix(code * _STEP + own[:, j].astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code[there].view(np.int64)), pa.array(ids[there]), pa.array(roots[there])], schema=schema
                )

    return classes.select("id", "root", "regs").mapInArrow(run, "band long, id long, root long")


def _bucket_links(members: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) inside the cells of buckets, by estimate, between different roots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ("band", "cell_i", "cell_j")):
            ids, roots, part = (cell.column(c).to_numpy() for c in ("id", "root", "part"))
            n, regs = cell.column("n").to_numpy(), _matrix(cell.column("regs"))
            crossed = cell.column("cell_i")[0] != cell.column("cell_j")[0]
            names, start = np.unique(roots, return_inverse=True)
            groups, a, b = Groups(len(names)), [], []
            now = start.copy()
            for i in range(len(ids) - 1):
                later = np.flatnonzero(now[i + 1 :] != now[i]) + i + 1
                if crossed:
                    later = later[part[later] != part[i]]
                if not len(later):
                    continue
                close = later[similar(regs[i], int(n[i]), regs[later], n[later], threshold)]
                for j in close:
                    if groups.join(int(start[i]), int(start[j])):
                        a.append(ids[i])
                        b.append(ids[j])
                if len(close):
                    now = np.array([groups.root(k) for k in range(len(names))])[start]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    keys = ["band", "cell_i", "cell_j"]
    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _estimated(classes: DataFrame, first: int, end: int, threshold: float) -> DataFrame:
    """Links by estimate from some bands, between classes with different roots."""
    rows = bands(classes, first, end)
    sizes = rows.groupBy("band").agg(
        F.count(F.lit(1)).alias("size"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    mixed = sizes.filter("low < high").select("band", "size")
    members = rows.join(mixed, "band").join(classes.select("id", "n", "regs"), "id")
    dealt = cells(members, "band", "id", F.col("size"), BUCKET_BLOCK).drop("size")
    return _bucket_links(dealt, threshold)


def _set_links(members: DataFrame, words: int, threshold: float) -> DataFrame:
    """Links (a, b) confirmed on full shingle sets inside the cells of groups."""
    percent = round(threshold * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for cell in runs(batches, ("root", "cell_i", "cell_j")):
            ids, part = cell.column("id").to_numpy(), cell.column("part").to_numpy()
            sets = [shingles(t.as_py()) for t in cell.column("text")]
            crossed = cell.column("cell_i")[0] != cell.column("cell_j")[0]
            links = list(_linked(sets, part if crossed else None, percent))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[list(a)], pa.int64()), pa.array(ids[list(b)], pa.int64())], ["a", "b"]
                )

    keys = ["root", "cell_i", "cell_j"]
    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _linked(sets: list[np.ndarray], part: np.ndarray | None, percent: int) -> Iterator[tuple[int, int]]:
    """Links that join sets not joined before, so that all similar ones end up connected."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(np.concatenate(sets), kind="stable")
    hashes, owner = np.concatenate(sets)[order], owner[order]
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    distinct, ends = hashes[starts], np.append(starts[1:], len(hashes))
    groups = Groups(len(sets))
    for i in range(len(sets) - 1):
        at = np.searchsorted(distinct, sets[i])
        low, n = starts[at], ends[at] - starts[at]
        shift = np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n)
        shared = np.bincount(owner[np.arange(n.sum()) + shift], minlength=len(sets))
        close = 100 * shared >= percent * (sizes + sizes[i] - shared)
        close[: i + 1] = False
        if part is not None:
            close &= part != part[i]
        for j in np.flatnonzero(close):
            if groups.join(i, int(j)):
                yield i, int(j)


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, threshold: float = THRESHOLD
) -> DataFrame:
    """Rows (key, n_shingles, component_id, kept), one per row of ``df``.

    component_id is the smallest key reachable over links of similar texts. Texts without
    words (null, empty, blank) are linked with nothing. Keys are integers; rows with one key
    count as one document and stay repeated. A null key has a null component and is kept.
    Other columns are ignored.
    """
    signed = stored(signatures(df, key, text, words), "signatures")
    classes = stored(
        signed.filter("n > 0 AND id IS NOT NULL").groupBy("class", "n", "regs").agg(F.min("id").alias("id")), "classes"
    )
    alone = classes.withColumn("root", F.col("id"))
    links = stored(_estimated(alone, 0, FIRST_BANDS, threshold), "links")
    roots = components(links)
    rooted = classes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    later = stored(_estimated(stored(rooted, "rooted"), FIRST_BANDS, BANDS, threshold), "links")
    groups = components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(later))
    named = groups.unionByName(groups.select(F.col("root").alias("id"), "root").distinct())
    sizes = named.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    # One plan at every size: the named side grows with the data, so it is never broadcast.
    members = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).join(
        named.join(sizes, "root").hint("merge"), "id"
    )
    dealt = cells(members, "root", "id", F.col("size"), GROUP_BLOCK).drop("size")
    confirmed = components(stored(_set_links(dealt, words, threshold), "links"))
    by_class = classes.select("class", F.col("id").alias("_rep")).join(
        confirmed.withColumnRenamed("id", "_rep"), "_rep", "left"
    )
    found = signed.select("id", "n", "class").join(
        by_class.select("class", F.coalesce("root", "_rep").alias("root")), "class", "left"
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return found.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
