from itertools import product

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from trilode.llm import langid
from trilode.llm.common import crc_mod

PIECES = ["a", "ab", "b", "ba", "▁", "▁a", "c"]


def toy():
    return langid.fit_model([("x", "abab", 5), ("x", "aab", 2), ("y", "bcb", 4)], PIECES)


def plain(model, word, lang):
    """The sum over every segmentation, one by one."""
    text, total = "▁" + word, 0.0
    for cuts in product([0, 1], repeat=len(text) - 1):
        parts, start = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(text[start:i])
                start = i
        parts.append(text[start:])
        p = 1.0
        for part in parts:
            if part in PIECES:
                p *= np.exp(model.logp[PIECES.index(part), lang])
            elif len(part) == 1:
                p *= np.exp(model.logp[-1, lang])
            else:
                p = 0.0
        total += p
    return np.log(total)


@pytest.mark.parametrize("word", ["a", "ab", "abba", "zab", "cab", "z"])
def test_forward_sums_all_segmentations(word):
    model = toy()
    got = model.word_scores([word, "b"])
    for lang in range(3):
        assert got[0, lang] == pytest.approx(plain(model, word, lang))


def test_probabilities_and_learning():
    model = toy()
    assert np.exp(model.logp).sum(axis=0) == pytest.approx([1, 1, 1])
    scorer = langid.Scorer(model)
    assert scorer.one("abab aab")[0] == "x" and scorer.one("bcb")[0] == "y"
    assert scorer.batch(["", None, "12 !?", "ab " * 5]) == [
        ("und", 0.0), ("und", 0.0), ("und", 0.0), scorer.one("ab " * 5)]


def test_each_round_of_fitting_is_likelier():
    counts = [("x", "abab", 5), ("x", "aab", 2), ("x", "cabba", 3)]
    likelihood = []
    for rounds in range(1, 6):
        model = langid.fit_model(counts, PIECES, rounds)
        scores = model.word_scores([w for _, w, _ in counts])[:, 0]
        likelihood.append(sum(n * s for (_, _, n), s in zip(counts, scores)))
    assert all(b > a - 0.3 for a, b in zip(likelihood, likelihood[1:]))  # smoothing gives a little


def test_long_words_and_cache(monkeypatch):
    monkeypatch.setattr(langid, "CACHE_WORDS", 3)
    scorer = langid.Scorer(toy())
    texts = ["ab" * 500, "ab ba aab abab bb", "cab bca", "ab ba aab abab bb"]
    first = [langid.Scorer(toy()).one(t) for t in texts]
    assert scorer.batch(texts) == first and all(np.isfinite(s) for _, s in first)


def test_held_out_accuracy(docs):
    model = langid.fit(docs, crc_mod("doc_id", 4) != 2)
    rows = langid.predict(docs, model).where(crc_mod("doc_id", 4) == 2).collect()
    assert len(rows) > 20
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.lang_score <= 1 for r in rows)


def test_odd_rows(odd, none):
    model = toy()
    rows = langid.predict(odd.withColumn("lang_pred", F.lit("old")), model).collect()
    assert len(rows) == odd.count() and rows[0].asDict().keys() == {
        *odd.columns, "lang_pred", "lang_score"}
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert langid.predict(none, model).count() == 0
    empty = langid.fit(none, F.lit(True))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}


def test_other_scripts_score_low(docs):
    scorer = langid.Scorer(langid.fit(docs, F.lit(True)))
    assert scorer.one("Это русский текст")[1] < 0.01 and scorer.one("你好世界这是")[1] < 0.01


def test_rare_languages_are_learned(spark):
    """Two Greek texts and one of junk beside 6000 of two frequent languages, one with long texts."""
    words = "concat_ws(' ', transform(sequence(1, {n}), i -> translate(conv(hash(id, i) + 5000000000, 10, 20), '0123456789', '{to}')))"
    many = spark.range(6000).selectExpr(
        "id AS doc_id",
        f"CASE WHEN id % 2 = 0 THEN {words.format(n=60, to='klmnopqrst')} "
        f"ELSE {words.format(n=3, to='uvwxyzäöüß')} END AS text",
        "CASE WHEN id % 2 = 0 THEN 'long' ELSE 'short' END AS lang")
    greek = spark.createDataFrame(
        [(6000, "το σπίτι είναι μεγάλο", "el"), (6001, "το μεγάλο σπίτι", "el"),
         (6002, "12 !?", "junk"), (6003, "το σπίτι", None)],
        "doc_id bigint, text string, lang string")
    docs = many.unionByName(greek)
    model = langid.fit(docs, F.lit(True))
    assert model.langs == ("el", "long", "short")
    kept = corpus_pipeline.known_language(spark, docs, "").where("doc_id >= 6000").collect()
    assert {(r.doc_id, r.lang) for r in kept} == {(6000, "el"), (6001, "el"), (6003, "el")}


def test_languages_have_words_of_their_own(spark, monkeypatch):
    """The frequent words of one language do not fill the list; copies do not lower the share drawn."""
    monkeypatch.setattr(langid, "TRAIN_WORDS", 2)
    monkeypatch.setattr(langid, "TRAIN_DOCS", 50)
    rows = [("ab ab ba ba aab aab", "x")] * 3000 + [("bb c", "y")] * 3000 + [("cab", "z")]
    rows += [(f"a{'b' * (i % 7)} c{'a' * (i // 7)}", "y") for i in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert langid.fit(docs, F.lit(True), pieces=PIECES).langs == ("x", "y", "z")
    seen = []
    monkeypatch.setattr(langid, "fit_model", lambda counts, pieces: seen.extend(counts))
    langid.fit(docs, F.lit(True), pieces=PIECES)
    assert sorted(lang for lang, _, _ in seen) == ["x", "x", "y", "y", "z"]
    monkeypatch.setattr(langid, "TRAIN_WORDS", 1000)
    seen.clear()
    langid.fit(docs, F.lit(True), pieces=PIECES)
    assert sum(n for lang, _, n in seen if lang == "y") == 82  # all 41 distinct texts, once each


@pytest.mark.parametrize("text", ["\u00bd", "\u2163 \u00b2", "12 _ \u00b9\u00bd", "\U0001f600", ""])
def test_number_signs_are_no_letters(spark, docs, text):
    model = langid.fit(docs, F.lit(True))
    df = spark.createDataFrame([(text,)], "text string")
    assert [tuple(r) for r in langid.predict(df, model).collect()] == [(text, langid.UND, 0.0)]


def test_words_are_runs_of_letters():
    text = "Ab\u00bdcD \u2163x 3y_z \u00e9\u0301"
    wanted = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    assert list(langid.words_in(text)) == wanted
