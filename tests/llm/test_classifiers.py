import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import common, language, toxicity

LANGUAGES = {
    "en": ["the", "and", "of", "house", "river", "with", "under", "morning", "which", "something"],
    "de": ["der", "und", "nicht", "schön", "haus", "fluß", "über", "morgen", "welche", "etwas"],
    "fr": ["le", "et", "dans", "maison", "rivière", "avec", "sous", "matin", "laquelle", "quelque"],
}


def texts(n: int, seed: int):
    """(id, text, lang, toxic): toxic texts hold an insult, or one of its inflected forms."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = list(LANGUAGES)[i % 3]
        words = rng.choice(LANGUAGES[lang], rng.integers(5, 60)).tolist()
        toxic = int(rng.random() < 0.25)
        if toxic:
            words.insert(rng.integers(0, len(words)), rng.choice(["dolt", "dolt!", "Grumble" + rng.choice(["ing", "ed", "y", "some"])]))
        rows.append((i, " ".join(words), lang, toxic))
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(texts(600, 1), "doc_id long, text string, lang string, toxic int")


@pytest.fixture(scope="module")
def toxic_model(corpus):
    return toxicity.fit(corpus, corpus.select("doc_id", "toxic").filter("doc_id % 4 <> 2"), sample_per_class=400)


def test_toxicity_on_rows_held_out(corpus, toxic_model):
    rows = toxicity.score(corpus, toxic_model).join(corpus.select("doc_id", "toxic"), "doc_id").filter("doc_id % 4 = 2").collect()
    right = sum((r["score"] >= toxicity.CUT) == bool(r["toxic"]) for r in rows)
    assert right / len(rows) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def test_pooling_is_the_greatest_response_of_all_places(toxic_model):
    words = [toxicity.hashed(t) for t in ("the dolt and the river", "", "one")]
    pooled = toxicity.Scorer(toxic_model).pooled(words)
    empty = np.full((1, toxicity.PARTS), toxicity.BUCKETS)
    for row, text in zip(pooled, words):
        vectors = toxic_model.embedding[np.concatenate([text, empty])].sum(axis=1)
        wanted = []
        for width, kernel in toxic_model.filters.items():
            padded = np.concatenate([vectors, np.zeros((width, toxicity.DIMENSIONS))])
            wanted.append(np.max([sum(padded[p + j] @ kernel[j] for j in range(width)) for p in range(len(vectors))], axis=0))
        assert np.allclose(row, np.concatenate(wanted), atol=1e-4)


def test_blocks_do_not_change_a_score(toxic_model, monkeypatch):
    many = [toxicity.hashed(" ".join(r[1] for r in texts(30, 9)) + " dolt"), toxicity.hashed("the river"), toxicity.hashed("")]
    whole = toxicity.Scorer(toxic_model).logits(many)
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 50)
    assert np.allclose(toxicity.Scorer(toxic_model).logits(many), whole, atol=1e-4)


def test_hashing_in_blocks(monkeypatch):
    text = "Some words, and (more) WORDS\nagain and again é l'été " * 20
    whole = toxicity.hashed(text)
    monkeypatch.setattr(toxicity, "BYTES_AT_ONCE", 64)
    assert np.array_equal(toxicity.hashed(text), whole)
    assert len(toxicity.hashed("")) == 0 and len(toxicity.hashed(" ,. ")) == 0
    assert np.array_equal(toxicity.hashed("Dolt!"), toxicity.hashed("dolt"))


def test_thresholds_by_language(spark, corpus, toxic_model):
    model = toxicity.Model(**{**toxic_model.__dict__, "thresholds": {"de": 0.0}})
    kept = toxicity.kept(corpus, model)
    assert kept.columns == corpus.columns and kept.filter("lang = 'de'").count() == 0
    assert kept.filter("lang = 'en' and toxic = 0").count() >= 0.95 * corpus.filter("lang = 'en' and toxic = 0").count()


def test_rare_languages_have_thresholds(toxic_model):
    """None of them has 40 positives in a quarter of the sample."""
    assert set(toxic_model.thresholds) == set(LANGUAGES)


def test_thresholds_count_all_labelled_rows(corpus, toxic_model):
    marks = corpus.filter("doc_id % 4 <> 2").select("doc_id", "toxic")
    learned = list(range(0, 200, 4))
    counts = toxicity.binned(corpus.union(corpus.limit(50)), marks, toxic_model, learned)
    assert counts["n"].sum() == marks.count() and counts["n"][counts["fitted"]].sum() == len(learned)
    assert {(r["lang"], r["toxic"]): r["n"] for r in counts.groupby(["lang", "toxic"], as_index=False)["n"].sum().to_dict("records")} == {
        (r["lang"], r["toxic"]): r["count"] for r in corpus.filter("doc_id % 4 <> 2").groupBy("lang", "toxic").count().collect()
    }


def test_a_rare_language_is_drawn_to_the_common_threshold(toxic_model):
    def thresholds(positives):
        rows = [(False, "en", 0, 1, 4000), (False, "en", -64, 0, 8000), (False, "xx", 192, 1, positives), (False, "xx", 128, 0, 2 * positives), (True, "xx", 0, 1, 9)]
        model = toxicity.Model(**{**toxic_model.__dict__, "shift": 0.0, "thresholds": {}})
        toxicity.calibrate(model, pd.DataFrame(rows, columns=["fitted", "lang", "bin", "toxic", "n"]))
        return model.thresholds

    cuts = [thresholds(n) for n in (1, 10, 40, 1000)]
    assert all(abs(c["en"] - toxicity.CUT) < 0.01 for c in cuts)
    assert toxicity.CUT < cuts[0]["xx"] < 0.33 and cuts[0]["xx"] < cuts[1]["xx"] < cuts[2]["xx"] < cuts[3]["xx"] < 0.9


def test_best_cut():
    assert toxicity.best_cut(np.array([3.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 0])) == 1.5
    assert toxicity.best_cut(np.array([1.0, 1.0]), np.array([1, 0])) < 1


def test_no_labels_no_model(spark, documents, no_documents):
    assert toxicity.fit(documents, spark.createDataFrame([], "doc_id long, toxic int")) is None
    assert toxicity.fit(no_documents, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")) is None
    assert toxicity.fit(documents, spark.createDataFrame([(1, None), (None, 1), (3, 0)], "doc_id long, toxic int")) is None
    assert [r["score"] for r in toxicity.score(documents, None).collect()] == [0.0] * documents.count()
    assert toxicity.kept(documents, None) is documents
    assert toxicity.score(no_documents, None).count() == 0


def test_odd_texts_have_scores(documents, toxic_model):
    rows = toxicity.score(documents, toxic_model).collect()
    assert len(rows) == documents.count() and all(0 <= r["score"] <= 1 for r in rows)


@pytest.fixture(scope="module")
def language_model(corpus):
    return language.fit(corpus.filter("doc_id % 3 <> 1 or doc_id % 9 = 1"), sample_per_language=100)


def test_language_on_rows_held_out(corpus, language_model):
    rows = language.identify(corpus, language_model).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_kernel(a: str, b: str) -> float:
    sets = []
    for text in (a, b):
        marks = np.zeros(language.BUCKETS, bool)
        language.presence(text, marks)
        sets.append(set(np.flatnonzero(marks).tolist()))
    return len(sets[0] & sets[1]) / np.sqrt(max(len(sets[0]), 1) * len(sets[1]))


def test_presence_counts_distinct_ngrams():
    def n(text):
        marks = np.zeros(language.BUCKETS, bool)
        language.presence(text, marks)
        return int(marks.sum())

    assert n("ab") == n("AB") == n("ab, 12 ab!") - 1 == 8  # " ab ": 3 letters, 3 pairs, 2 triples; "b a" is new


def test_kernel_and_regression_against_the_definition():
    rows = texts(60, 4)
    model = language.train([r[1] for r in rows], [r[2] for r in rows])
    chosen = [t for name in sorted(LANGUAGES) for t in [r[1] for r in rows if r[2] == name][: language.LANDMARKS_PER_LANGUAGE]]
    kernel = model.kernel([rows[0][1], rows[1][1]])
    assert np.allclose(kernel, [[plain_kernel(rows[i][1], x) for x in chosen] for i in (0, 1)], atol=1e-6)


def test_presence_in_blocks(monkeypatch):
    text = " ".join(r[1] for r in texts(30, 2))
    whole, parts = np.zeros(language.BUCKETS, bool), np.zeros(language.BUCKETS, bool)
    language.presence(text, whole)
    monkeypatch.setattr(language, "CHARS_AT_ONCE", 17)
    language.presence(text, parts)
    assert np.array_equal(whole, parts)


def test_texts_without_letters_are_unknown(documents, no_documents, language_model):
    found = {r["doc_id"]: r for r in language.identify(documents, language_model).collect()}
    assert {i for i, r in found.items() if r["lang_pred"] == "und"} == {2, 3, 4, 14}
    assert all(found[i]["score"] == 0 for i in (2, 3, 4, 14))
    kept = language.kept(documents, language_model, 0.0)
    assert kept.columns == documents.columns and kept.filter(F.col("doc_id").isin(2, 3, 4, 14)).count() == 0
    assert kept.count() == documents.count() - 4
    assert language.identify(no_documents, language_model).count() == 0


def test_no_training_text_no_model(documents, no_documents):
    assert language.fit(no_documents) is None
    assert {r["lang_pred"] for r in language.identify(documents, None).collect()} == {"und"}


def test_queries_on_small_and_empty_tables(spark, folder):
    from lapsewise.llm.queries import op3_toxicity, op9_language

    for query, columns in ((op3_toxicity, {"doc_id", "held_out", "score", "predicted"}), (op9_language, {"doc_id", "held_out", "lang_pred", "score"})):
        assert set(query(spark, f"{folder}/full").columns) == columns
        assert query(spark, f"{folder}/full").count() == spark.read.parquet(f"{folder}/full/documents.parquet").count()
        assert query(spark, f"{folder}/empty").count() == 0


def test_a_scorer_holds_the_responses_of_one_width():
    rng = np.random.default_rng(5)
    filters = {w: rng.normal(0, 1, (w, toxicity.DIMENSIONS, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS}
    wide = len(filters) * toxicity.FILTERS
    embedding = rng.normal(0, 1, (toxicity.BUCKETS + 1, toxicity.DIMENSIONS)).astype(np.float32)
    scorer = toxicity.Scorer(toxicity.Model(embedding, filters, np.zeros(wide, np.float32), np.ones(wide, np.float32), 0.0))
    texts = [rng.integers(0, toxicity.BUCKETS, (500, toxicity.PARTS), dtype=np.int32) for _ in range(40)]
    tracemalloc.start()
    found = scorer.pooled(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 350 * 500 * 40
    vectors = np.concatenate([embedding[texts[7]].sum(axis=1), np.zeros((toxicity.GAP, toxicity.DIMENSIONS), np.float32) + embedding[-1] * toxicity.PARTS])
    for n, (w, f) in enumerate(filters.items()):
        greatest = np.max([np.einsum("jd,jdf->f", vectors[i : i + w], f) for i in range(501)], axis=0)
        assert np.allclose(found[7, n * toxicity.FILTERS : (n + 1) * toxicity.FILTERS], greatest, atol=1e-3)


def test_a_task_gives_back_what_arrow_holds_free(monkeypatch):
    seen = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: seen.append("released")))
    batches = common.released(lambda rows: (seen.append(row) or row for row in rows))(iter([1, 2]))
    assert (list(batches), seen) == ([1, 2], [1, 2, "released"])
