from itertools import combinations
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightledger.llm import langid
from brightledger.llm.queries import QUERIES

from .cases import documents, none

ALPHA, BETA, GAMMA = "kalo mira teno sula pera", "wux zyq vrox qix wyz", "ñandé ünor çav éti øre"


def labelled(spark):
    rows = [(n, " ".join([t] * 8), name) for n, (name, t) in enumerate(zip("abc", (ALPHA, BETA, GAMMA)))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_mixture_of_two_languages(spark):
    model = langid.learn(labelled(spark), F.col("text"), F.col("lang"))
    assert model.languages == ("a", "b", "c")
    both = model.mixture(langid.trigram_counts((ALPHA + " ") * 30 + (BETA + " ") * 10))
    assert both[0] == ["a", "b"] and abs(both[1][0] - 0.76) < 0.12
    assert model.mixture(langid.trigram_counts(GAMMA))[0] == ["c"]


def test_chosen_set_has_the_best_penalised_likelihood(spark):
    model = langid.learn(labelled(spark), F.col("text"), F.col("lang"))
    for text in (ALPHA, BETA + " " + GAMMA, " ".join([ALPHA, BETA, GAMMA] * 5), "1 x"):
        counts = langid.trigram_counts(text)
        seen = np.flatnonzero(counts)
        weights = counts[seen] / langid.OVERLAP
        charge = langid.PENALTY * np.log(max(2.0, weights.sum()))

        def value(languages):
            at = [model.languages.index(n) for n in languages]
            return langid.expectation_maximisation(model.likelihoods(seen)[at], weights)[1] - charge * len(at)

        chosen = model.mixture(counts)[0]
        subsets = [["a"], ["b"], ["c"], ["a", "b"], ["a", "c"], ["b", "c"], ["a", "b", "c"]]
        assert value(chosen) >= max(map(value, subsets)) - 0.05


def test_expectation_maximisation_never_lowers_the_likelihood():
    draw = np.random.default_rng(3)
    given, weights = draw.random((4, 50)), draw.integers(1, 5, 50).astype(float)
    start = np.log(np.full(4, 0.25) @ given) @ weights
    shares, fit = langid.expectation_maximisation(given, weights)
    assert fit >= start and abs(shares.sum() - 1) < 1e-9


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 100_000])
def test_slices_count_like_one_text(monkeypatch, size):
    texts = ["Ünïcode words, and  more -- of them ΣΑΣ " * 40, "", " ", "--", "a", "ab", " a -- b ", "x" * 128, "é" * 64 + "\n" * 70 + "漢字"]
    whole = [langid.trigram_counts(text) for text in texts]
    monkeypatch.setattr(langid, "SLICE", size)
    for text, counts in zip(texts, whole):
        assert (langid.trigram_counts(text) == counts).all(), text


def test_awkward_texts(spark):
    df = documents(spark, [(70, "12 34 --", "aa", "s", 1)]).withColumn("Language", F.lit("clash"))
    rows = langid.identify(df, langid.learn_from_folds(df)).collect()
    assert len(rows) == df.count() and "Language" not in rows[0].asDict()
    for r in rows:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["language"]["pred"] == "und") == (not letters)
        assert 0 <= r["language"]["score"] <= 1 and (r["language"]["score"] > 0) == letters


def test_nothing_learned_and_empty_tables(spark):
    model = langid.learn(none(spark), F.col("text"), F.col("lang"))
    assert {r["language"]["pred"] for r in langid.identify(documents(spark), model).collect()} == {"und"}
    assert langid.identify(none(spark), model).count() == 0


def test_any_number_of_labels(spark):
    letters = "abcdefghijklmnopqrst"
    words = {f"l{n:03d}": f"{letters[n % 20]}{letters[n // 20]}q{letters[(7 * n) % 20]}z " * 30 for n in range(150)}
    df = spark.createDataFrame([(n, t, name) for n, (name, t) in enumerate(words.items())], "doc_id long, text string, lang string")
    model = langid.learn(df.coalesce(1), F.col("text"), F.col("lang"))
    assert len(model.languages) == 150
    found = {r["lang"]: r["language"]["pred"] for r in langid.identify(df, model).collect()}
    assert all(name == pred for name, pred in found.items())


def test_model_is_that_of_whole_tables(spark):
    df = labelled(spark)
    model = langid.learn(df, F.col("text"), F.col("lang"))
    table = np.stack([langid.trigram_counts(r["text"]) + langid.SMOOTHING for r in df.orderBy("lang").collect()])
    seen = np.arange(1 << langid.HASH_BITS)
    assert np.allclose(model.likelihoods(seen), table / table.sum(axis=1, keepdims=True), rtol=1e-12)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op7_language_mixture"](spark, folder).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and len(held) > 200
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98


def test_query_against_a_plain_version(spark, sf_dir):
    """Every prediction from models and mixtures of plain counters, all sets tried."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    kept = [r for r in rows if crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["text"] is not None and r["lang"] is not None]
    names = sorted({r["lang"] for r in kept})
    tables = {n: sum(langid.trigram_counts(r["text"]) for r in kept if r["lang"] == n) + langid.SMOOTHING for n in names}
    table = np.stack([tables[n] / tables[n].sum() for n in names])

    def plain(text):
        counts = langid.trigram_counts(text)
        seen = np.flatnonzero(counts)
        weights = counts[seen] / langid.OVERLAP
        charge = langid.PENALTY * np.log(max(2.0, weights.sum()))
        fits = {}
        for size in range(1, len(names) + 1):
            for some in combinations(range(len(names)), size):
                shares, fit = langid.expectation_maximisation(table[list(some)][:, seen], weights)
                fits[some] = (fit - charge * size, [names[i] for i in np.array(some)[np.argsort(-shares, kind="stable")]], shares.max())
        return max(fits.values(), key=lambda f: f[0])

    found = {r["doc_id"]: r for r in QUERIES["op7_language_mixture"](spark, sf_dir).collect()}
    for r in rows:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (found[r["doc_id"]]["lang_pred"], found[r["doc_id"]]["score"]) == ("und", 0.0)
            continue
        _, languages, share = plain(r["text"])
        assert found[r["doc_id"]]["languages"] == languages and abs(found[r["doc_id"]]["score"] - share) < 0.01, r["doc_id"]
