"""Packing of token sequences: length patterns fitted by non-negative least squares.

Only the histogram of lengths (at most ``capacity`` rows) is planned with. Patterns of up to
three lengths that fill a sequence exactly get repeat counts by non-negative least squares;
counts are rounded down to what is there, and what remains is packed best-fit. Rows then
look up their place by their number within their length, so nothing is gathered.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.grouping import numbered_within
from larder.llm.common import short_batches, slices, stored

TOKENIZER = "word_bpe_49k.json"
MOST_PATTERNS = 16_384
ROUNDS = 100
RANK_BLOCK = 1024
_PARTS = 64
_WORDS_KEPT = 1_000_000
_MARKS = ".,;:!?%&#$*|"
# Letters below this one are composed already and have one plain lower-case letter each.
_COMPOSED = "\u0130"
# Byte-level vocabularies write a byte that cannot be printed as the next letter from 256 on.
_UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(_UNPRINTED)}


def patterns(lengths: np.ndarray, capacity: int, most: int = MOST_PATTERNS) -> np.ndarray:
    """Rows of up to three lengths, longest first, that fill ``capacity``; 0 is an empty place.

    All single lengths and pairs are listed; triples are thinned evenly down to ``most``.
    """
    there = np.zeros(capacity + 1, dtype=bool)
    there[lengths] = True
    there[0] = True
    first = np.flatnonzero(there[1:]) + 1
    two = capacity - first
    ok = (two >= 0) & (two <= first)
    pairs = np.stack([first[ok], two[ok], np.zeros(ok.sum(), int)], axis=1)
    pairs = pairs[there[pairs[:, 1]]]
    a, b = np.meshgrid(first, first, indexing="ij")
    c = capacity - a - b
    ok = (b <= a) & (c >= 1) & (c <= b)
    ok[ok] = there[c[ok]]
    triples = np.stack([a[ok], b[ok], c[ok]], axis=1)
    keep = max(1, -(-len(triples) // max(1, most - len(pairs))))
    return np.concatenate([pairs, triples[(triples[:, 0] * 31 + triples[:, 1] * 17) % keep == 0]])


def fit(rows: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative repeat counts whose lengths come closest to ``counts`` (multiplicative steps)."""
    if not len(rows):
        return np.zeros(0)
    size = len(counts)

    def lengths_of(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(rows[:, j], weights=x, minlength=size) for j in range(3))
        total[0] = 0
        return total

    def against(v: np.ndarray) -> np.ndarray:
        return sum(v[rows[:, j]] for j in range(3))

    target = counts.astype(float)
    target[0] = 0
    wanted = against(target)
    x = np.full(len(rows), target.sum() / (2.0 * len(rows)) + 1e-9)
    for _ in range(rounds):
        x *= wanted / np.maximum(against(lengths_of(x)), 1e-12)
    return x


def _best_fit(left: dict[int, int], capacity: int) -> Counter:
    """Remaining lengths, longest first, into the tightest open space; equal cases move together."""
    open_: dict[int, Counter] = {}
    spaces: list[int] = []

    def put(space: int, row: tuple[int, ...], n: int) -> None:
        if space not in open_:
            open_[space] = Counter()
            bisect.insort(spaces, space)
        open_[space][row] += n

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            i = bisect.bisect_left(spaces, length)
            if i == len(spaces):
                each = min(capacity // length, n)
                bins = n // each
                put(capacity - each * length, (length,) * each, bins)
                n -= bins * each
                continue
            space = spaces[i]
            row, m = next(iter(open_[space].items()))
            took = min(m, n)
            open_[space][row] -= took
            if not open_[space][row]:
                del open_[space][row]
            if not open_[space]:
                del open_[space]
                spaces.pop(i)
            put(space - length, (*row, length), took)
            n -= took
    done: Counter = Counter()
    for rows in open_.values():
        done.update(rows)
    return done


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how many sequences follow each; uses every length exactly as often as it occurs."""
    done: Counter = Counter()
    left = {k: int(v) for k, v in histogram.items() if v}
    if left.get(capacity):
        done[(capacity,)] = left.pop(capacity)
    if left:
        rows = patterns(np.array(sorted(left)), capacity)
        counts = np.zeros(capacity + 1, dtype=np.int64)
        for k, v in left.items():
            counts[k] = v
        x = fit(rows, counts)
        have = counts.tolist()
        for i in np.argsort(-x, kind="stable"):
            row = tuple(int(v) for v in rows[i] if v)
            need = Counter(row)
            n = min(max(1, int(x[i])), *[have[v] // m for v, m in need.items()])
            if n > 0:
                done[row] += n
                for v, m in need.items():
                    have[v] -= n * m
        done.update(_best_fit({v: n for v, n in enumerate(have) if v and n}, capacity))
    return sorted(done.items(), reverse=True)


def places(rows: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first, end, sequence, offset): rank r of a length lies in sequence + r - first."""
    used: Counter = Counter()
    out, sequence = [], 0
    for row, n in rows:
        offset = 0
        for length in row:
            out.append((length, used[length], used[length] + n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return out


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Tokens(dict):
    """Token ids as little-endian bytes, by word; the ids of recent words are kept.

    The vocabulary drops white space and never joins across it, so a text is the sum of its
    words. A word of letters that no normalization touches but lower-casing, with marks behind
    them, is the sum of both: each is one piece for the model. Any other word is encoded whole.
    """

    def __init__(self, tokenizer_path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            piece = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_LETTERS)
            found = self.parts[part] = _packed([token.id for token in self.tokenizer.model.tokenize(piece)])
        return found

    def __missing__(self, word: str) -> bytes:
        body = word.rstrip(_MARKS)
        if body.isalpha() and max(body) < _COMPOSED:
            found = self._part(body.lower())
            if len(body) < len(word):
                found += self._part(word[len(body) :])
        else:  # may hold a special token or a letter that changes, which only the whole encoding knows
            found = _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = found
        return found

    def forget(self) -> None:
        self.clear()
        self.parts.clear()

    def __call__(self, text: str) -> bytes:
        if len(self) > _WORDS_KEPT:
            self.forget()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_TOKENS: dict[str, _Tokens] = {}


def _tokens(path: str) -> _Tokens:
    """One per Python worker; the words of earlier tasks are let go."""
    if path not in _TOKENS:
        _TOKENS[path] = _Tokens(path)
    _TOKENS[path].forget()
    return _TOKENS[path]


def pieces(
    df: DataFrame, key: str, text: str, capacity: int, end_id: int, with_ids: bool = True, tokenizer: str = TOKENIZER
) -> DataFrame:
    """Token pieces: the key, piece, start, length, ids_crc32 and, if wanted, ids.

    A document is its ids and then ``end_id``; longer ones are cut every ``capacity`` ids.
    Null texts count as empty. The tokenizer file is read on each executor by its public name.
    """
    id_type = df.schema[key].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    given = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    fields = [("key", to_arrow_type(id_type)), ("piece", pa.int32()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encode = _tokens(public_tokenizers.path(tokenizer))
        end = np.array([end_id], dtype="<u4").tobytes()
        for part in slices(batches):
            rows = []
            keys = part.column("key").to_pylist()
            for k, t in zip(keys, part.column("text").to_pylist()):
                data = encode(t or "") + end
                for i, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[at : at + 4 * capacity]
                    row = [k, i, at // 4, len(own) // 4, zlib.crc32(own)]
                    rows.append(row + [np.frombuffer(own, dtype="<u4").astype(np.int32)] * with_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=t) for c, (_, t) in zip(zip(*rows), fields)], schema=schema
            )
        encode.forget()

    ddl = f"key {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return short_batches(given).mapInArrow(run, ddl).withColumnRenamed("key", key)


def pack(
    df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0,
    with_ids: bool = True, tokenizer: str = TOKENIZER,
) -> DataFrame:
    """All pieces with sequence_id and offset.

    Repeated rows are packed one by one; a null key stays null; no rows, no pieces. Extra
    columns are ignored. Pieces of one length are numbered by (key, piece, crc), split over
    several tasks.
    """
    spark = df.sparkSession
    cut = stored(pieces(df, key, text, capacity, end_id, with_ids, tokenizer), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").agg(F.count(F.lit(1))).collect()}
    table = spark.createDataFrame(
        places(plan(histogram, capacity)), "length long, _first long, _end long, _sequence long, offset long"
    ).withColumn("_block", F.explode(F.expr(f"sequence(_first div {RANK_BLOCK}, (_end - 1) div {RANK_BLOCK})")))
    part = F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(_PARTS)).cast("int")
    ranked = numbered_within(cut.withColumn("_part", part), "length", "_part", [key, "piece", "ids_crc32"], "_rank")
    rank = F.col("_rank") - 1
    found = ranked.withColumn("_block", F.floor(rank / RANK_BLOCK)).join(table, ["length", "_block"])
    return found.filter((rank >= F.col("_first")) & (rank < F.col("_end"))).select(
        *cut.columns, (F.col("_sequence") + rank - F.col("_first")).alias("sequence_id"), "offset"
    )
