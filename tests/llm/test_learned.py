from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from larder.llm import langid, queries, toxicity

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


def test_held_out_languages(spark):
    got = queries.op10_language_id(spark, DATA).toPandas().set_index("doc_id")
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{DATA}/documents.parquet'").fetchall())
    held = got[got.held_out]
    assert len(got) == len(truth) and (held.lang_pred == [truth[i] for i in held.index]).mean() > 0.98
    assert got.score.between(0, 1).all()


def _model(rows):
    return langid.fit(rows("text string, lang string", ("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"),
                           ("der hund ist im haus", "de"), (None, "de"), ("lost", None)))


def test_words_first_then_ngrams(rows):
    model = _model(rows)
    assert model.langs == ["de", "en", "fr"]
    scorer = langid.Scorer(model)
    assert scorer("hund")["lang"] == "de"  # a known word
    assert scorer("chats")["lang"] == "fr"  # unseen: n-grams of chat
    assert "chats" not in model.words
    # by hand: a known word adds its log frequencies, which rank de first
    logs = model.words["hund"]
    assert logs.index(max(logs)) == 0


def test_unseen_word_takes_the_longest_known_ngrams(rows):
    model = _model(rows)
    word = "<chatz>"
    total = [0.0] * 3
    n = 0
    for i in range(len(word)):
        for k in (4, 3, 2, 1):
            if word[i : i + k] in model.grams and i + k <= len(word):
                total = [a + b for a, b in zip(total, model.grams[word[i : i + k]])]
                n += 1
                break
    assert model.unseen("chatz") == pytest.approx([langid.UNSEEN_WEIGHT * t / n for t in total])


def test_forgotten_words_change_no_score(rows, monkeypatch):
    model = _model(rows)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["cat", "hund", "chat"]) + rng.choice("abcdef") * rng.randrange(9) for _ in range(60)) for _ in range(40)]
    want = [langid.Scorer(model)(t) for t in texts]
    monkeypatch.setattr(langid, "_CACHE", 5)
    monkeypatch.setattr(langid, "_AT_ONCE", 7)
    small = langid.Scorer(model)
    assert [small(t)["lang"] for t in texts] == [w["lang"] for w in want]
    assert [small(t)["score"] for t in texts] == pytest.approx([w["score"] for w in want], abs=1e-4)


def test_language_edge_cases(rows, spark):
    model = _model(rows)
    df = rows(DOCS, (1, None), (2, ""), (3, "123 !? _"), (4, "the the"), (4, "the the"), (None, "x" * 200_000)).withColumns(
        {"language": F.lit("old"), "lang": F.lit("zz"), "score": F.lit(7)})
    out = langid.identify(df, model)
    assert sorted(out.columns) == ["doc_id", "lang", "language", "score", "text"]
    got = sorted((r.doc_id or 0, r.language.lang, r.language.score <= 1) for r in out.collect())
    assert [g[:2] for g in got[1:]] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")] and all(g[2] for g in got)
    assert langid.Scorer(model)("Ωψ")["score"] == 0.0
    empty = spark.createDataFrame([], "text string, lang string")
    assert {r.language.lang for r in langid.identify(df, langid.fit(empty)).collect()} == {"und"}
    assert langid.identify(spark.createDataFrame([], DOCS), model).count() == 0


def test_most_frequent_words_are_bounded(rows, spark, monkeypatch):
    counts = spark.createDataFrame([("en", f"w{i}", i // 2) for i in range(100)], "lang string, word string, n long")
    kept = langid._most_frequent(counts, "word", 11).collect()
    assert len(kept) == 10 and min(r.n for r in kept) == 45


def test_held_out_toxicity(spark):
    got = queries.op7_toxicity(spark, DATA).toPandas().set_index("doc_id")
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{DATA}/labels.parquet'").fetchall())
    held = [(int(got.predicted[i]), t) for i, t in truth.items() if got.held_out[i]]
    assert sum(p == t for p, t in held) / len(held) > 0.93
    assert sum(p for p, t in held if t) / sum(t for _, t in held) > 0.7
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()


def _labelled(rng):
    out = []
    for i in range(300):
        words = [rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(30)]
        if i % 5 == 0:
            words[rng.randrange(30)] = "you"
            words[rng.randrange(30)] = rng.choice(["grumbling", "grumblers"])
        out.append((i, " ".join(words), int(i % 5 == 0)))
    return out


def test_lexicon_holds_words_and_beginnings(rows):
    lexicon = toxicity.learn_lexicon(rows("key long, text string, label int", *_labelled(random.Random(1))))
    assert {"grum*", "grumb*", "grumbl*"} <= set(lexicon) and "alpha" not in lexicon


def test_features_by_hand():
    f = toxicity.Features({"idiot": 4.0, "fool*": 2.0})
    got = f("You IDIOT! fools, 1d1ot")
    assert got[0] == 2 / 4 and got[1] == 6 / 4 and got[2] == 4.0 and got[7] == 2 / 4 and got[8] == 1 / 4
    assert got[10] == 1 / 4 and got[11] == 1 / 23 and got[14] == 1 / 4
    assert f("") == f(None) == f("?!") == [0.0] * toxicity.FEATURES


def test_toxicity_edge_cases(rows, spark):
    model = toxicity.fit(rows("key long, text string, label int", *_labelled(random.Random(2)), (900, "x", None), (901, None, 0)))
    df = rows(DOCS, (1, None), (2, ""), (3, "you grumbling you"), (3, "you grumbling you"), (None, "a " * 100_000)).withColumns(
        {"toxicity": F.lit("old"), "features": F.lit(1), "raw": F.lit(2), "label": F.lit(1)})
    out = toxicity.score(df, model)
    got = out.collect()
    assert len(got) == 5 and sorted(out.columns) == ["doc_id", "features", "label", "raw", "text", "toxicity"]
    by = {r.doc_id: r.toxicity for r in got}
    assert by[3] > 0.7 > by[1] == by[2] and all(0 <= r.toxicity <= 1 for r in got)
    one_kind = toxicity.fit(rows("key long, text string, label int", (1, "a", 0), (2, "b", 0)))
    assert {r.toxicity for r in toxicity.score(df, one_kind).collect()} == {0.0}
    assert toxicity.score(spark.createDataFrame([], DOCS), model).count() == 0


def test_sample_is_bounded(spark):
    labels = spark.range(5000).withColumnRenamed("id", "doc_id")
    assert toxicity.sample(labels, "doc_id", 5000).count() == 5000
    assert 800 < toxicity.sample(labels, "doc_id", 1000).count() <= 1000


def test_lexicon_has_no_cap_and_joined_words_count_by_their_pieces(rows):
    data = []
    for i in range(700):  # 700 words that only toxic texts hold, five times each
        data += [(i * 10 + j, f"word{i:03d}{'x' * 50} plain", 1) for j in range(5)]
    data += [(100_000 + i, "plain text", 0) for i in range(3500)]
    lexicon = toxicity.learn_lexicon(rows("key long, text string, label int", *data))
    assert all(f"word{i:03d}{'x' * 50}" in lexicon for i in range(700))
    f = toxicity.Features({"idiot": 4.0})
    chain = "-".join(["please"] * 30 + ["idiot"])
    assert f.weight(chain) == 4.0 == f.weight("idiot") and f.weight("please-stop") == 0.0


def test_of_contradicting_labels_the_toxic_one_holds(spark, tmp_path):
    docs = [(i, ("you idiot " if i % 2 else "kind words ") * 5, "en", "s", 50) for i in range(300)]
    labels = [(i, 1, i % 2) for i in range(300)] + [(i, 1, 0) for i in range(1, 300, 2)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(5).write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in queries.op7_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == 300 and all(r.predicted == r.doc_id % 2 for r in got.values())
