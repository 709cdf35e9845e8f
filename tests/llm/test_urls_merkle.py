from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.llm import merkle, urls
from larder.llm.queries import RULES

URLS = "page_id long, url string"


def judged(df):
    return urls.judge(df, RULES).select("page_id", "judged.*").collect()


def test_rules_and_parts(rows):
    cases = [
        ("https://A.Example.com/en/1?x", "a.example.com", "/en/1", "example.com/en/"),
        ("http://www.example.com/en/1#t", "www.example.com", "/en/1", "www.example.com/en/"),
        ("x://m.www.example.com/en/", "m.www.example.com", "/en/", "www.example.com/en/"),
        ("http://example.com", "example.com", "", None),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/"),
        ("http://a.net/es/1", "a.net", "/es/1", "net/es/"),
        ("http://a.net/est/1", "a.net", "/est/1", None),
        ("no scheme.com/en/", "", "", None),
        ("http://h/p://q/en/", "h", "/p://q/en/", None),
        (None, "", "", None),
        ("", "", "", None),
    ]
    got = {r.page_id: r for r in judged(rows(URLS, *[(i, c[0]) for i, c in enumerate(cases)]))}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(cases))] == [c[1:] for c in cases]
    verdict = {rule: v for v, rule in RULES}
    assert all(r.verdict in ("allow", "block") for r in got.values())
    assert all(r.verdict == verdict[r.rule] for r in got.values() if r.rule)


def test_model_separates(rows):
    good = [(i, f"http://news{i}.example.com/about/{i}") for i in range(60)]
    bad = [(100 + i, f"http://spam{i}.example.net/es/win{i}") for i in range(60)]
    asked = [(300, "http://news7.example.org/about/9"), (301, "http://spam9.example.org/es/win3")]
    got = {r.page_id: r for r in judged(rows(URLS, *good, *bad, *asked))}
    assert got[300].verdict == "allow" and got[301].verdict == "block" and got[300].rule is None


def test_repeats_clashing_columns_long_and_empty(spark, rows):
    long = "http://a.org/" + "x" * 20_000
    df = rows(URLS, (1, long), (1, long), (None, "http://b.com/")).withColumns(
        {"judged": F.lit(1), "_n": F.lit(2), "host": F.lit("h")})
    out = urls.judge(df, RULES)
    assert sorted(out.columns) == ["_n", "host", "judged", "page_id", "url"] and out.count() == 3
    assert judged(spark.createDataFrame([], URLS)) == []


def by_hand(examples, asked):
    """Mean log ratios of models of order 0 to 5, each smoothed with the next shorter one."""
    cut = lambda u: [(["\x02"] * 5 + list(u.lower()) + ["\x03"])[i : i + 6] for i in range(len(u) + 1)]
    symbols = len({g[-1] for u in [*asked, *[u for u, _ in examples]] for g in cut(u)})
    grams, around = Counter(), Counter()
    for u, verdict in examples:
        for g in cut(u):
            for k in range(6):
                grams[verdict, "".join(g[5 - k :])] += 1
                around[verdict, k, "".join(g[5 - k : 5])] += 1

    def share(verdict, g):
        p = 1 / symbols
        for k in range(6):
            p = (grams[verdict, "".join(g[5 - k :])] + 2 * p) / (around[verdict, k, "".join(g[5 - k : 5])] + 2)
        return p

    return {u: sum(math.log(share("allow", g) / share("block", g)) for g in cut(u)) / (len(u) + 1) for u in asked}


def test_long_contexts_and_all_characters_count(rows, monkeypatch):
    monkeypatch.setattr(urls, "COMMON", 200)
    good = [f"http://n{i}.example.com/one-path/ü{i}" for i in range(30)]
    bad = [f"http://n{i}.example.net/es/two-path/ñ{i}" for i in range(30)]
    asked = ["http://q.org/ü", "http://q.org/ñ", "http://q.org/~é+", "http://q.org/one-p", "http://q.org/two-p"]
    got = {r.page_id: r.score for r in judged(rows(URLS, *enumerate([*asked, *good, *bad])))}
    examples = [(u, v) for us, v in ((good, "allow"), (bad, "block")) for u in us if zlib.crc32(u.encode()) % 5]
    want = by_hand(examples, [*asked, *good, *bad])
    assert [got[i] for i in range(65)] == pytest.approx([want[u] for u in [*asked, *good, *bad]], abs=2e-6)
    assert got[0] > got[1] and got[3] > got[4]


DOCS = "doc_id long, text string"


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        q, nxt = len(t) // 4, texts[(i + 1) % len(texts)]
        out.append(t[: len(t) - q] + nxt[:q])
    return out


@pytest.mark.parametrize("partitions", [1, 3])
def test_edits_follow_the_order_of_ids(rows, partitions):
    texts = [f"Text {i}. " + "é😀 word, " * (i * 7 % 50) + "\nline." * (i % 3) for i in range(60)] + [""] * 3
    df = rows(DOCS, *[(i * 3 - 40, t) for i, t in enumerate(texts)]).repartition(partitions)
    got = {r.doc_id: r for r in merkle.compare_with_next(df).collect()}
    want = edited(texts)
    for i, t in enumerate(texts):
        r = got[i * 3 - 40]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(want[i].encode()).hexdigest()
        assert (r.fingerprint == r.edited_fingerprint) == (t == want[i])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_pieces_cover_the_text(rows):
    texts = ["", "a", "...\n\n", "x" * 500, "One. Two! Three?\nFour " * 30, "é😀" * 100]
    out = rows(DOCS, *enumerate(texts)).select("text", merkle.paragraphs(F.col("text")).alias("p")).collect()
    assert all("".join(r.p) == r.text for r in out)


def test_sections_locate_an_edit(rows):
    base = "".join(f"Sentence number {i} is here. " for i in range(100))
    changed = base.replace("number 90 ", "numbre 90 ")
    df = merkle.with_fingerprint(merkle.with_fingerprint(
        rows("a string, b string", (base, changed), (base, base)), "a", "fa"), "b", "fb")
    got = df.select(merkle.edited_sections(F.col("fa"), F.col("fb")).alias("s"),
                    merkle.likeness(F.col("fa"), F.col("fb")).alias("n")).collect()
    assert len(got[0].s) == 1 and got[0].s[0] >= 5 and 0.9 < got[0].n < 1
    assert got[1].s == [] and got[1].n == 1.0


def test_null_single_repeated_and_empty(rows, spark):
    one = merkle.compare_with_next(rows(DOCS, (1, "abcdefgh"))).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    df = rows(DOCS, (1, "same"), (1, "same"), (2, None), (None, "lost text")).withColumns(
        {"fingerprint": F.lit("x"), "near_next": F.lit(0)})
    got = merkle.compare_with_next(df).collect()
    assert len(got) == 4
    lost = [r for r in got if r.doc_id is None][0]
    assert lost.near_next is None and lost.edited_sha256 == hashlib.sha256(b"lost te").hexdigest()
    assert merkle.compare_with_next(spark.createDataFrame([], DOCS)).count() == 0
