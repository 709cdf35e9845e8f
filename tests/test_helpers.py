import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.functions.grouping import exact_quantiles, numbered_within
from larder.functions.quantities import fixed_text, half_even, numbered, padded, plain_number_text


@pytest.mark.parametrize("digits", [2, 3])
def test_fixed_text_rounds_like_python(rows, digits):
    rng = random.Random(1)
    values = [0.3125, 0.0005, 675.075, 1.005, 2.675, 0.125, 0.375, 500.0, 1234567.125, 0.0]
    values += [rng.randint(0, 10**7) / 1000 for _ in range(3000)]
    values += [rng.random() * 1000 for _ in range(2000)]
    values += [rng.randint(1, 200) * (900 + rng.randint(0, 999) / 10) / 100 for _ in range(3000)]
    frame = rows("v double", *[(v,) for v in values])
    for r in frame.select("v", fixed_text(F.col("v"), digits).alias("t")).collect():
        assert r.t == f"{r.v:.{digits}f}"


def test_plain_number_text_is_python_text(rows):
    rng = random.Random(2)
    values = [2.5, 1.0, 9.001, 0.0, 1.8, 1e6, 123456.789] + [
        (900 + rng.randint(0, 1999) / 10) / 100 for _ in range(3000)
    ]
    frame = rows("v double", *[(v,) for v in values])
    for r in frame.select("v", plain_number_text(F.col("v")).alias("t")).collect():
        assert r.t == repr(r.v)
    assert frame.limit(1).select(plain_number_text(F.lit(12345678.5))).first()[0] == "12345678.5"


def test_text_padding_never_cuts(rows):
    got = rows("a string, n int", ("x" * 17, 123456)).select(
        padded(F.col("a"), 15), numbered(F.col("n"), 5), padded(F.lit("ab"), 4), numbered(F.lit(7), 5)
    ).first()
    assert tuple(got) == ("x" * 17, "123456", "ab  ", "00007")


def test_half_even(rows):
    got = rows("v double", (0.5,), (1.5,), (2.5,), (2.500001,)).select(half_even(F.col("v"))).collect()
    assert [r[0] for r in got] == [0.0, 2.0, 2.0, 3.0]


def test_exact_quantiles_on_a_hot_group(rows):
    rng = random.Random(5)
    groups = {
        "hot": [rng.gauss(0, 300) for _ in range(4000)] + [7.25] * 2000,
        "small": [1.0, 2.0, 4.0, 9.5],
        "one": [3.5],
        "flat": [2.0] * 50,
        "tiny": [rng.random() / 100 for _ in range(500)],
    }
    frame = rows("g string, v double", *[(g, v) for g, vs in groups.items() for v in vs], ("small", None))
    shares = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    for buckets in (1, 7, 1024):
        for r in exact_quantiles(frame, ["g"], "v", shares, buckets).collect():
            for name, share in shares.items():
                assert r[name] == pytest.approx(np.quantile(groups[r.g], share), abs=1e-9)


def test_numbering_of_a_hot_group(rows):
    rng = random.Random(4)
    data = [("hot", f"k{rng.randint(0, 40):02d}", i) for i in range(700)]
    data += [(f"g{i % 9}", f"k{i % 5}", i) for i in range(300)]
    frame = rows("g string, k string, i int", *data)
    got = numbered_within(frame, "g", "k", ["i"], "n").collect()
    want = {}
    for group in {d[0] for d in data}:
        for n, d in enumerate(sorted(d for d in data if d[0] == group), start=1):
            want[d] = n
    assert {(r.g, r.k, r.i): r.n for r in got} == want
