from __future__ import annotations

import itertools
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.llm import decontam, pii

DOCS = "doc_id long, text string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


@settings(max_examples=600, deadline=None)
@given(st.text("1290.-+@ ()ab_%é😀", max_size=60) | st.text("0123456789 -", min_size=10, max_size=40) | st.text("12.", max_size=40))
def test_base_spans_like_the_plain_patterns(text):
    assert [(s["kind"], s["start"], s["end"]) for s in pii.find(text) if s["base"]] == plain(text)


def test_added_kinds_need_checksum_or_context():
    kinds = lambda t: [s["kind"] for s in pii.find(t)]
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 now") == ["iban"]
    assert kinds("pay to GB82 WEST 1234 5698 7654 33 now") == []
    assert kinds("tel 0301 234567") == ["national"] and kinds("item 0301 234567") == []


def test_scores_follow_context():
    score = lambda t: pii.find(t)[0]["score"]
    assert score("call +49 301 2345678") > score("x +49 301 2345678") > score("order +49 301 2345678")


def test_long_hostile_texts_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "1 " * 150_000):
        pii.find(text)


def test_rows_and_columns_stay(rows, spark):
    df = rows(DOCS, (1, "a@b.c x"), (1, "a@b.c x"), (None, None), (2, "")).withColumns(
        {"pii": F.lit(1), "n_chars": F.lit(5), "spans": F.lit("s")})
    out = pii.find_spans(df)
    assert out.count() == 4 and sorted(out.columns) == ["doc_id", "n_chars", "pii", "spans", "text"]
    masked = pii.mask(df)
    assert masked.columns == df.columns
    assert sorted((r.text or "", r.n_chars or 0) for r in masked.collect()) == [("", 0), ("", 0), ("<email> x", 9), ("<email> x", 9)]
    assert pii.find_spans(spark.createDataFrame([], DOCS)).count() == 0


ITEMS = "item_id long, text string"


def brute(docs, items):
    found = set()
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    for d, text in docs:
        a = words(text)
        for i, other in items:
            b = words(other)
            for start in range(-len(b), len(a)):
                eq = [int(0 <= start + j < len(a) and a[start + j] == b[j]) for j in range(len(b))]
                seeds = any(
                    all(eq[p + k] for k, c in enumerate(mask) if c == "1")
                    for mask in decontam.MASKS for p in range(len(b) - len(mask) + 1)
                )
                best = max((sum(eq[p : p + decontam.WINDOW]) for p in range(max(1, len(eq) - decontam.WINDOW + 1))), default=0)
                if seeds and best >= decontam.LEAST_EQUAL:
                    found.add((d, i))
    return found


def test_substitutions_are_tolerated_like_brute_force(rows):
    rng = random.Random(4)
    text = lambda n: " ".join(f"v{rng.randrange(300)}" for _ in range(n))
    items = [(i, text(rng.randrange(8, 45))) for i in range(12)]
    docs = []
    for d in range(60):
        own = text(rng.randrange(0, 120)).split()
        if d % 2:
            part = rng.choice(items)[1].upper().split()
            for _ in range(rng.randrange(4)):
                part[rng.randrange(len(part))] = "changed"
            own[len(own) // 2 : len(own) // 2] = [w + "," for w in part[rng.randrange(6) :]]
        docs.append((d, " ".join(own)))
    got = decontam.overlaps(rows(DOCS, *docs), rows(ITEMS, *items))
    want = brute(docs, items)
    assert {(r.doc, r.item) for r in got.collect()} == want and len(want) > 15


def test_every_sixth_word_replaced_is_still_found(rows):
    words = [f"u{i}" for i in range(40)]
    changed = [w if i % 6 else "x" for i, w in enumerate(words)]
    got = decontam.contaminated(rows(DOCS, (1, " ".join(changed)), (2, "clean text " * 20)), rows(ITEMS, (9, " ".join(words))))
    assert [(r.doc_id, r.item_ids) for r in got.collect()] == [(1, [9])]


def test_nulls_repeats_clashing_columns_and_empty(rows, spark):
    passage = " ".join(f"k{i}" for i in range(20))
    df = rows(DOCS, (1, passage), (1, passage), (2, None), (3, ""), (None, passage), (4, "short")).withColumns(
        {"doc": F.lit(1), "item": F.lit(1), "n_equal": F.lit("x")})
    items = rows(ITEMS, (1, passage), (1, passage), (2, None), (None, passage)).withColumn("start", F.lit(1))
    got = decontam.contaminated(df, items).collect()
    assert [(r.doc_id, r.item_ids, r.n_equal) for r in got] == [(1, [1], 20)]
    clean = decontam.clean(df, items)
    assert clean.columns == df.columns
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [0, 2, 3, 4]
    assert decontam.contaminated(spark.createDataFrame([], DOCS), items).count() == 0
    assert decontam.clean(df, spark.createDataFrame([], ITEMS)).count() == 6


def by_rule(docs, items):
    """Pairs with 10 of 13 equal words at some alignment, whatever the seeds."""
    found = set()
    for d, a in docs:
        for i, b in items:
            for start in range(-len(b), len(a)):
                eq = [int(0 <= start + j < len(a) and a[start + j] == b[j]) for j in range(len(b))]
                if max(sum(eq[p : p + 13]) for p in range(max(1, len(eq) - 12))) >= 10:
                    found.add((d, i))
    return found


def test_every_overlap_by_the_rule_is_found(rows):
    rng = random.Random(8)
    items = [(n, [f"w{n}x{j}" for j in range(n)]) for n in (10, 11, 12, 13, 15, 16, 60)]
    docs = []
    for n, words in items:
        for k in range(5):
            for _ in range(12):
                gone = rng.sample(range(n), k)
                docs.append((len(docs), ["a", "b", *("x" if j in gone else w for j, w in enumerate(words)), "c"]))
    docs.append((len(docs), ["x" if j % 4 == 3 else w for j, w in enumerate(items[-1][1])]))
    joined = lambda pairs: [(k, " ".join(words)) for k, words in pairs]
    got = decontam.overlaps(rows(DOCS, *joined(docs)), rows(ITEMS, *joined(items)))
    want = by_rule(docs, items)
    assert {(r.doc, r.item) for r in got.collect()} == want and (len(docs) - 1, 60) in want


def test_masks_leave_no_gap():
    for gone in itertools.combinations(range(13), 3):
        assert any(
            all(p + k not in gone for k, c in enumerate(mask) if c == "1")
            for mask in decontam.MASKS for p in range(13 - len(mask) + 1)
        )


def test_short_and_unspaced_items_are_found(rows):
    chinese = "".join(chr(0x4E00 + 37 * i) for i in range(40))
    thai = "".join(chr(0x0E01 + i % 40) for i in range(15))
    edited = "".join("書" if i % 7 == 3 else c for i, c in enumerate(chinese))
    items = rows(ITEMS, (1, "What is the capital of Peru?"), (2, "Photosynthesis"), (3, chinese), (4, thai), (5, "?!"),
                 (6, "one two three four five six seven eight nine ten"))
    df = rows(DOCS, (1, "Asked: WHAT is the capital, of Peru"), (2, "photosynthesis"), (3, "前" + chinese + "後"), (4, "x" + thai),
              (5, "What is the capital of Chile?"), (6, "photosynthetic"), (7, edited), (8, chinese[:12] + "x" + chinese[30:]),
              (9, thai[:14]), (10, "one two three four five six seven eight nine ten"), (11, "?!"))
    got = {r.doc_id: (r.item_ids, r.n_equal) for r in decontam.contaminated(df, items).collect()}
    assert got == {1: ([1], 6), 2: ([2], 1), 3: ([3], 40), 4: ([4], 15), 7: ([3], 34), 10: ([6], 10)}
    assert {r.doc_id for r in decontam.clean(df, items).collect()} == {5, 6, 8, 9, 11}
