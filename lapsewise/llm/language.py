"""Language identification with string kernels.

A text is the set of its character n-grams of one to ``ORDER`` letters (the blended spectrum), hashed
into ``BUCKETS``; the kernel of two texts is the number of n-grams they share over the root of the
product of their sizes. Training texts meet a few landmark texts only (Nystroem): kernel values to
the landmarks, whitened by the landmarks' own kernel matrix, are the features of a ridge regression,
one language against the rest. As a score is linear in the kernel values, a block of texts is scored
by two matrix products: n-gram presence by landmarks, then kernel values by languages.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import map_texts, unpacked, with_found

ORDER, BUCKETS = 3, 1 << 15
#: Bounds of the training sample and of the landmarks, for each language.
SAMPLE_PER_LANGUAGE, LANDMARKS_PER_LANGUAGE = 400, 24
#: What a table may hold; its sample, and the model, grow with the languages.
MOST_LANGUAGES = 10_000
RIDGE = 1e-3
UNKNOWN = "und"
#: Texts whose presence matrix is built at a time, and characters hashed at a time.
TEXTS_AT_ONCE, CHARS_AT_ONCE = 64, 500_000
_LETTER = re.compile(r"[^\W\d_]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def presence(text: str, out: np.ndarray) -> None:
    """Marks in ``out`` (BUCKETS booleans) the n-grams of the letters of a text, words apart."""
    letters = " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    codes = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    for start in range(0, len(codes), CHARS_AT_ONCE):
        part = codes[start : start + CHARS_AT_ONCE + ORDER - 1]
        mixed = np.zeros(len(part), np.uint32)
        for order in range(1, ORDER + 1):
            mixed = (mixed[: len(part) - order + 1] + part[order - 1 :] + np.uint32(order)) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            out[mixed * np.uint32(0x85EBCA6B) >> shift] = True


def has_letters(text: str) -> bool:
    return _LETTER.search(text) is not None


@dataclass
class Model:
    languages: list[str]
    #: the buckets that any landmark has, and landmarks by those buckets
    columns: np.ndarray
    landmarks: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray

    def kernel(self, texts: list[str]) -> np.ndarray:
        marks = np.zeros((len(texts), BUCKETS), bool)
        for row, text in zip(marks, texts):
            presence(text, row)
        own = np.maximum(marks.sum(axis=1), 1)
        return (marks[:, self.columns].astype(np.float32) @ self.landmarks.T) / np.sqrt(own[:, None] * self.sizes)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        languages, scores = [], []
        for start in range(0, len(texts), TEXTS_AT_ONCE):
            part = texts[start : start + TEXTS_AT_ONCE]
            kernel = self.kernel(part)
            margin = np.c_[kernel, np.ones(len(part))] @ self.weights
            odds = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
            best = margin.argmax(axis=1)
            known = [has_letters(t) for t in part]
            languages += [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            scores.append(np.where(known, odds[np.arange(len(part)), best] / odds.sum(axis=1), 0.0))
        return languages, np.concatenate([np.zeros(0), *scores])


def train(texts: list[str], languages: list[str]) -> Model | None:
    """Landmarks are the first texts of each language, which come in the order of a draw; the rest of the method is exact."""
    texts, languages = [list(x) for x in zip(*[(t, lang) for t, lang in zip(texts, languages) if has_letters(t)])] or ([], [])
    if not texts:
        return None
    names = sorted(set(languages))
    chosen = [i for name in names for i in [i for i, lang in enumerate(languages) if lang == name][:LANDMARKS_PER_LANGUAGE]]
    marks = np.zeros((len(chosen), BUCKETS), bool)
    for row, i in zip(marks, chosen):
        presence(texts[i], row)
    columns = np.flatnonzero(marks.any(axis=0))
    landmarks = marks[:, columns].astype(np.float32)
    sizes = marks.sum(axis=1).astype(np.float64)
    among = (landmarks @ landmarks.T) / np.sqrt(np.outer(sizes, sizes))
    values, vectors = np.linalg.eigh(among)
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    model = Model(names, columns, landmarks, sizes, np.zeros((len(chosen) + 1, len(names))))
    kernel = np.concatenate([model.kernel(texts[s : s + TEXTS_AT_ONCE]) for s in range(0, len(texts), TEXTS_AT_ONCE)])
    features = np.c_[kernel @ whiten, np.ones(len(texts))]
    target = np.where(np.array(languages)[:, None] == np.array(names), 1.0, -1.0)
    counts = np.array([languages.count(name) for name in names])
    row_weight = 1 / counts[[names.index(lang) for lang in languages]]  # languages weigh the same
    weighted = features * row_weight[:, None]
    solved = np.linalg.solve(weighted.T @ features + RIDGE * np.eye(features.shape[1]), weighted.T @ target)
    model.weights = np.concatenate([whiten @ solved[:-1], solved[-1:]])
    return model


def sample(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """(draw, text, lang): about ``sample_per_language`` different documents of each language, drawn by a
    hash of id and text. Repeated rows are one document, so neither they nor a null or repeated id can
    make the sample larger. More than MOST_LANGUAGES languages are refused."""
    rows = docs.select(
        F.xxhash64(F.lit("language"), F.col("doc_id"), F.col("text").cast("string")).alias("draw"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).filter("text is not null and lang is not null")
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n"))
    n_languages = counts.count()
    if n_languages > MOST_LANGUAGES:
        raise ValueError(f"{n_languages} languages; at most {MOST_LANGUAGES} can be learned")
    share = F.pmod(F.col("draw"), F.lit(1_000_000)) / 1_000_000
    drawn = rows.join(F.broadcast(counts), "lang").filter(share < F.lit(float(sample_per_language)) / F.col("n"))
    return drawn.select("draw", "text", "lang").distinct()


def fit(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """A model from the text and lang of ``docs``; rows where either is null are not used.

    Only the drawn ``sample`` reaches the driver; None if there is no usable row.
    """
    found = sample(docs, sample_per_language).toPandas().sort_values(["draw", "text", "lang"])
    return train(found["text"].tolist(), found["lang"].tolist())


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score): ``und`` and 0 for a text that is null or has no letter, and for all
    texts if there is no model."""
    return map_texts(docs, _make(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, lang_pred string, score double")


def _make(shared):
    def make():
        def run(texts: list[str]) -> dict:
            if shared.value is None:
                return {"lang_pred": [UNKNOWN] * len(texts), "score": np.zeros(len(texts))}
            languages, scores = shared.value.predict(texts)
            return {"lang_pred": languages, "score": scores}

        return run

    return make


def kept(docs: DataFrame, model: Model | None, least_score: float) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least that score."""
    found = with_found(docs, _make(docs.sparkSession.sparkContext.broadcast(model)), "lang_pred string, score double")
    known = (F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= least_score)
    return found.filter(known).select(*unpacked(docs))
