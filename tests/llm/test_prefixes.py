from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from larder.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, place int, _block string"


def brute(turns):
    """Nodes as tuples, from the definition."""
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        childless = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in below)]
        ends = sorted(c for c in convs if len(full[c]) == len(path))
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            sum(len(p) == len(path) + 1 for p in below), len(childless),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, turns, **more):
    frame = spark.createDataFrame([(*t, 7, "x") for t in turns], SCHEMA)
    nodes = prefixes.trie(prefixes.digested(prefixes.rebuilt(prefixes.numbered_turns(frame))), **more)
    return sorted((tuple(r) for r in nodes.collect()), key=str)


def conversations(seed, n, words):
    rng = random.Random(seed)
    turns = []
    for conv in rng.sample(range(0, 260), n):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9])):
            turns.append((conv, rng.choice([turn, turn, turn, 3, None]), rng.choice(["user", "user", "bot", None]), rng.choice(words)))
    return turns


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_brute_force(spark, seed):
    turns = conversations(seed, 60, ["a", "bb", "", None, "é" * 5])
    assert found(spark, turns) == brute(turns)


def test_trie_equals_brute_force_with_small_blocks_sketch_and_broadcast(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "BLOCK_BITS", 1)
    monkeypatch.setattr(prefixes, "IDS_A_CHUNK_BITS", 1)
    monkeypatch.setattr(prefixes, "HOT_SHARE", 4)
    monkeypatch.setattr(prefixes, "LEAST_CELLS", 16)
    turns = conversations(9, 60, ["a", "bb", "c", "d"])
    assert found(spark, turns, most_cells=64) == brute(turns)


def test_copies_long_conversations_nulls_and_empty_table(spark):
    copies = [(c, t, "user", "same" * (t + 1)) for c in range(1000, 1040) for t in range(3)]
    long = [(2001, t, "user", str(t)) for t in range(300)] + [(2002, t, "user", str(t)) for t in range(250)]
    nobody = [(None, 0, "user", "x"), (None, None, None, None)]
    turnless = [(3001 + i, 0, "user", "x") for i in range(40)]  # many of them lose their only turn
    repeated = [(4005, 0, "a", "b")] * 3
    for turns in (copies, nobody + turnless + repeated):
        assert found(spark, turns) == brute(turns)
    nodes = {(r[0], r[1]): r for r in found(spark, long)}
    h1, h2 = (zlib.crc32(str(c).encode()) % 6 for c in (2001, 2002))
    assert len(nodes) == (300 - h1) + (250 - h2) + 1 - (min(300 - h1, 250 - h2) if h1 == h2 else 0)
    assert found(spark, nobody) == []


def test_screening_never_calls_a_shared_prefix_alone(spark):
    turns = conversations(4, 80, ["a", "b"])
    frame = spark.createDataFrame([(*t, 7, "x") for t in turns], SCHEMA)
    digests = prefixes.digested(prefixes.rebuilt(prefixes.numbered_turns(frame)))
    rows = prefixes.screened(digests, most_cells=1 << 12).collect()
    count = defaultdict(int)
    for r in rows:
        count[r.key_one, r.key_two] += 1
    alone = [r for r in rows if r.alone_from is not None and r.depth >= r.alone_from]
    assert alone and all(count[r.key_one, r.key_two] == 1 for r in alone)
