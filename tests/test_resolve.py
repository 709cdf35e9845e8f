from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.operators import resolve, silver
from larder.operators.resolve import MISSING, fit_weights

SCHEMA = (
    "unified_sku_id string, sap_material_number string, ean_barcode string, material_description string, material_type string, "
    "material_group string, base_uom string, shelf_life_days int, match_confidence double"
)
WORDS = "melk halfvol vol biologisch brood volkoren wit tarwe kaas jong oud belegen appel rood groen elstar yoghurt griekse".split()


def grams(text):
    plain = re.sub(r"[^\w]+|_", " ", (text or "").lower()).strip()
    padded = f" {plain} "
    return {padded[i : i + 3] for i in range(max(len(padded) - 2, 1))} if plain else set()


def catalogue(seed, n_known, n_open):
    """Open records are misspelt copies of known ones, or nothing that is known."""
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n_known):
        text = " ".join(rng.sample(WORDS, 4)) + f" {i}"
        rows.append((f"E{i}", f"K{i}", f"E{i}", text, "FERT", rng.choice("AB"), rng.choice(["KG", "EA"]), rng.choice([3, 7, None]), 1.0))
    for i in range(n_open):
        own = f"MATNR-O{i}"
        if i % 2:
            k = rng.randrange(n_known)
            text = rows[k][3].upper().replace("VOL", "V0L", 1) + rng.choice(["", " !", " xl"])
            rows.append((own, f"O{i}", None, text, *rows[k][4:8], 0.0))
            truth[f"O{i}"] = f"K{k}"
        else:
            text = rng.choice([None, "", "  ..", "zzz qqq", f"schroef {i}"])
            rows.append((own, f"O{i}", None, text, "FERT", rng.choice("AB"), rng.choice(["KG", "EA"]), 5, 0.0))
    return rows, truth


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_equal_brute_force(spark, seed):
    rows, _ = catalogue(seed, 40, 60)
    frame = spark.createDataFrame(rows, SCHEMA)
    records = frame.select(F.col("sap_material_number").alias("id"), "ean_barcode", resolve.grams(F.col("material_description")).alias("grams"))
    assert {r.id: set(r.grams) for r in records.collect()} == {r[1]: grams(r[3]) for r in rows}
    found = resolve.candidate_pairs(records.filter("ean_barcode IS NULL"), records.filter("ean_barcode IS NOT NULL"))
    want = {}
    for a in rows:
        for b in rows:
            if a[2] is None and b[2] is not None and grams(a[3]):
                share = len(grams(a[3]) & grams(b[3])) / len(grams(a[3]) | grams(b[3]))
                if share >= 0.5:
                    want[a[1], b[1]] = pytest.approx(share)
    assert {(r.left_id, r.right_id): r.similarity for r in found.collect()} == want and want


def test_planted_identities_are_found_and_strangers_left_alone(spark):
    rows, truth = catalogue(3, 150, 120)
    registry = spark.createDataFrame(rows, SCHEMA)
    found = {r.sap_material_number: r for r in resolve.sku_resolution(registry).collect()}
    assert len(found) == len(rows)
    for r in found.values():
        if r.ean_barcode:
            assert (r.match_confidence, r.unified_sku_id, r.resolved_to) == (1.0, r.ean_barcode, None)
        elif r.resolved_to:
            assert 0.5 <= r.match_confidence < 1.0 and r.unified_sku_id == "E" + r.resolved_to[1:]
        else:
            assert r.match_confidence == 0.0 and r.unified_sku_id == f"MATNR-{r.sap_material_number}"
    hits = sum(found[o].resolved_to == k for o, k in truth.items())
    strangers = [o for o in found if o.startswith("O") and o not in truth]
    assert hits >= 0.9 * len(truth)
    assert not any(found[o].resolved_to for o in strangers)
    sure = silver.confidence_filter(resolve.sku_resolution(registry))
    assert sure.count() == 150 == sure.filter("ean_barcode IS NOT NULL").count()


def test_weights_recover_the_shares_they_were_drawn_from():
    rng = random.Random(7)
    counts = Counter()
    for _ in range(20_000):
        match = rng.random() < 0.2
        level = rng.choices(range(4), [1, 2, 3, 14] if match else [12, 5, 2, 1])[0]
        fields = [MISSING if rng.random() < 0.1 else int(rng.random() < (0.95 if match else 0.3)) for _ in range(2)]
        counts[(level, *fields)] += 1
    weights = fit_weights(counts, [4, 3, 3])
    assert weights.share == pytest.approx(0.2, abs=0.03)
    assert weights.matches[0][3] == pytest.approx(0.7, abs=0.05) and weights.others[0][0] == pytest.approx(0.6, abs=0.05)
    assert weights.matches[1][1] == pytest.approx(0.855, abs=0.04) and weights.others[1][1] == pytest.approx(0.27, abs=0.04)
    assert weights.probability((3, 1, 1)) > 0.95 > 0.05 > weights.probability((0, 0, 0))
    assert 0 < fit_weights({}, [4, 3, 3]).probability((3, 1, 1)) < 1


def test_empty_registry_and_one_without_gaps(spark):
    registry = spark.createDataFrame(catalogue(5, 5, 0)[0], SCHEMA)
    assert resolve.sku_resolution(registry.limit(0)).count() == 0
    assert [r.match_confidence for r in resolve.sku_resolution(registry).collect()] == [1.0] * 5


def test_copies_are_compared_as_one_class_and_lose_no_pair(spark, tmp_path):
    rows, _ = catalogue(3, 12, 14)
    copies = [(f"{r[0]}-{k}", f"{r[1]}-{k}", r[2] and f"{r[2]}-{k}", *r[3:]) for r in rows for k in range(5)]
    spark.createDataFrame(copies, SCHEMA).write.parquet(f"{tmp_path}/registry")
    frame = spark.read.parquet(f"{tmp_path}/registry")
    records = frame.select(
        F.col("sap_material_number").alias("id"), "ean_barcode", resolve.grams(F.col("material_description")).alias("grams"), *resolve.FIELDS
    )
    unknown, known = records.filter("ean_barcode IS NULL"), records.filter("ean_barcode IS NOT NULL")
    plain = resolve.compared(resolve.candidate_pairs(unknown, known), records)
    assert "Broadcast" not in plain._jdf.queryExecution().executedPlan().toString()
    left, right = resolve.record_classes(unknown), resolve.record_classes(known)
    classes = resolve.compared(resolve.candidate_pairs(left, right), left.unionByName(right))
    pairs = resolve.expanded(classes, resolve.members(unknown, left), resolve.members(known, right), cell=2)
    want = Counter(map(tuple, plain.collect()))
    assert Counter(map(tuple, pairs.select(*plain.columns).collect())) == want and max(want.values()) == 1
    assert 0 < classes.count() * 5 <= len(want)
