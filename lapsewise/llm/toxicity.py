"""A convolutional text classifier for toxicity, trained in numpy.

Words are lower-cased and freed of ASCII punctuation. A word's embedding is the sum of three hashed
ones: of the word and of its first four and five bytes, so that inflected forms share what they learn.
One dimension of an embedding holds counted log odds, the others are learned. Filters of several widths slide over the words, each keeps its greatest response in the text (max
pooling), and a logistic layer weighs them. Training sees a bounded sample of labelled rows; scoring
reads whole texts in bounded blocks that overlap, so no filter misses a phrase.

The score is shifted so that 0.3 is the cut with the best F1 on all labelled rows outside the fit,
scored where they lie and counted by language, label and bin of the score. Each language with positives
among them gets a threshold of its own, by the same rule, drawn to the common one the rarer it is;
the language chooses a threshold only and is never an input of a score.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import arrow_schema, blocks, map_texts, released, unpacked, with_found

BUCKETS, DIMENSIONS, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
CUT = 0.3
#: Bound of the training sample: labelled rows of each class.
SAMPLE_PER_CLASS = 3000
#: Texts of the usual mix that are added to the counts behind a bucket's log odds.
PSEUDO_TEXTS = 5
#: Share of the sample that is held back from the fit, for tables that the sample exhausts.
HELD_BACK = 0.25
#: Positives at which a language's own cut and the common one weigh the same in its threshold.
PSEUDO_POSITIVES = 40
#: Bins of a logit's unit in the counts behind the thresholds, and the greatest logit told apart.
BINS, GREATEST = 64, 60
#: Words scored, and bytes hashed, at a time.
WORDS_AT_ONCE, BYTES_AT_ONCE = 50_000, 1 << 19
#: Leading bytes of a word that have embeddings of their own.
PREFIXES = (4, 5)
PARTS = 1 + len(PREFIXES)
#: Empty words after a text. Filters are read up to the first of them, so none reaches the next text.
GAP = max(WIDTHS)

_BASE = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.r_[np.uint64(1), np.full(BYTES_AT_ONCE, np.uint64(_BASE))])
_INVERSE = np.cumprod(np.r_[np.uint64(1), np.full(BYTES_AT_ONCE, np.uint64(pow(_BASE, -1, 1 << 64)))])
_GAP = np.zeros(256, bool)
_GAP[list((string.punctuation + string.whitespace).encode())] = True


def hashed(text: str) -> np.ndarray:
    """(words, PARTS): the buckets of every word of a whole text and of its prefixes."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    found, start = [np.zeros((0, PARTS), np.int32)], 0
    while start < len(raw):
        end = start + BYTES_AT_ONCE - 1
        if end < len(raw):  # cut at white space; a longer run of other bytes counts as several words
            end = max(raw.rfind(b" ", start, end), raw.rfind(b"\n", start, end), start) + 1
            end = end if end > start + 1 else start + BYTES_AT_ONCE - 1
        found.append(_hashed(np.frombuffer(raw[start:end], np.uint8)))
        start = end
    return np.concatenate(found)


def _hashed(raw: np.ndarray) -> np.ndarray:
    gap = np.r_[True, _GAP[raw], True]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    begin, end = edges[::2], edges[1::2]
    sums = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(raw)])]
    out = np.empty((len(begin), PARTS), np.int32)
    for part, stop in enumerate((end, *(np.minimum(end, begin + n) for n in PREFIXES))):
        value = (sums[stop] - sums[begin]) * _INVERSE[begin] + np.uint64(part)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        out[:, part] = (value >> np.uint64(40)) % np.uint64(BUCKETS)
    return out


@dataclass
class Model:
    #: (BUCKETS + 1, DIMENSIONS); the last row, of the empty word, is zero
    embedding: np.ndarray
    #: width -> (width, DIMENSIONS, FILTERS)
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    weight: np.ndarray
    intercept: float
    #: what is added to the logit so that CUT is the best cut
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)


class Scorer:
    """Logits of hashed texts by a model: the filters of a width at all places in one product, then sums of
    neighbouring rows, then the greatest row of each text."""

    def __init__(self, model: Model):
        self.model = model
        self.flat = [np.ascontiguousarray(f.transpose(1, 0, 2).reshape(DIMENSIONS, -1)) for f in model.filters.values()]

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, widths x FILTERS): the greatest responses of each text."""
        words, starts = laid_out(texts)
        vectors = self.model.embedding[words[:, 0]]
        for part in range(1, PARTS):
            vectors += self.model.embedding[words[:, part]]
        ends = np.r_[starts[1:], len(words)] - (GAP - 1)
        found = np.empty((len(texts), len(WIDTHS) * FILTERS), np.float32)
        for n, width in enumerate(self.model.filters):
            responses = vectors @ self.flat[n]
            response = responses[:, :FILTERS]
            for j in range(1, width):
                response[:-j] += responses[j:, j * FILTERS : (j + 1) * FILTERS]
            for row, (s, e) in enumerate(zip(starts.tolist(), ends.tolist())):
                found[row, n * FILTERS : (n + 1) * FILTERS] = response[s:e].max(axis=0)
            del response, responses  # before the next width's
        return found

    def _of(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.model.bias, 0) @ self.model.weight + self.model.intercept + self.model.shift

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        """One logit a text, in blocks of WORDS_AT_ONCE; a longer text is pooled over its own blocks."""
        out = np.zeros(len(texts))
        held, size, reach = [], 0, max(WIDTHS) - 1
        for i, text in enumerate(texts):
            if len(text) > WORDS_AT_ONCE:
                blocks = (text[s : s + WORDS_AT_ONCE + reach] for s in range(0, len(text), WORDS_AT_ONCE))
                out[i] = self._of(np.max([self.pooled([b]) for b in blocks], axis=0))[0]
                continue
            held.append(i)
            size += len(text)
            if size > WORDS_AT_ONCE:
                out[held] = self._of(self.pooled([texts[j] for j in held]))
                held, size = [], 0
        if held:
            out[held] = self._of(self.pooled([texts[j] for j in held]))
        return out


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed texts end to end, each followed by GAP empty words, and where each begins."""
    empty = np.full((GAP, PARTS), BUCKETS, np.int32)
    sizes = [len(t) + len(empty) for t in texts]
    return np.concatenate([x for t in texts for x in (t, empty)]), np.cumsum([0, *sizes[:-1]])


def log_odds(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Of each bucket: how much more likely a text that has it is toxic, shrunk towards no difference by
    PSEUDO_TEXTS texts of the usual mix."""
    counts = np.zeros((2, BUCKETS + 1))
    for text, label in zip(texts, labels):
        counts[int(label)][np.unique(text)] += 1
    usual = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    rate = (counts[1] + PSEUDO_TEXTS * usual) / (counts.sum(axis=0) + PSEUDO_TEXTS)
    odds = np.log(rate / (1 - rate)) - np.log(usual / (1 - usual))
    odds[BUCKETS] = 0
    return odds.astype(np.float32)


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = 5, batch: int = 64, rate: float = 0.005, seed: int = 7) -> Model:
    """Adam on the logistic loss, both classes weighing the same; only winning responses and the
    embeddings beneath them get a gradient.

    The first dimension of an embedding is not learned but counted: its log odds. While training, a
    text reads log odds counted on the other half of the texts, so that none sees its own label.
    """
    rng = np.random.default_rng(seed)
    rows, numbers = np.unique(laid_out(texts)[0], axis=0, return_inverse=True)
    numbered = np.split(numbers.ravel(), np.cumsum([len(t) + GAP for t in texts])[:-1])
    total, real = len(WIDTHS) * FILTERS, np.float32
    half = rng.permutation(len(texts)) % 2
    counted = [log_odds([t for t, h in zip(texts, half) if h != side], labels[half != side]) for side in (0, 1)]
    params = {
        "embedding": rng.normal(0, 0.05, (BUCKETS + 1, DIMENSIONS)).astype(real),
        **{w: rng.normal(0, (w * DIMENSIONS) ** -0.5, (w, DIMENSIONS, FILTERS)).astype(real) for w in WIDTHS},
        "bias": np.zeros(total, real),
        "weight": rng.normal(0, 0.3, total).astype(real),
        "intercept": np.zeros(1, real),
    }
    params["embedding"][BUCKETS] = 0
    for w in WIDTHS:  # a filter that hears the log odds of its first word, whatever the others say
        params[w][0, 0, 0] = 1.0
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    positives = max(int(labels.sum()), 1)
    class_weight = np.where(labels > 0, len(labels) / (2 * positives), len(labels) / (2 * max(len(labels) - positives, 1)))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        order = order[np.argsort(half[order], kind="stable")]
        cuts = [c for side in (0, 1) for c in np.array_split(order[half[order] == side], max(1, -(-int((half == side).sum()) // batch)))]
        for chosen in [cuts[i] for i in rng.permutation(len(cuts)) if len(cuts[i])]:
            words = np.concatenate([numbered[i] for i in chosen])
            starts = np.cumsum([0, *(len(numbered[i]) for i in chosen[:-1])])
            used, inside = np.unique(words, return_inverse=True)
            vectors = params["embedding"][rows[used]].sum(axis=1)
            vectors[:, 0] = counted[half[chosen[0]]][rows[used]].sum(axis=1)
            pooled, winners = [], []
            ends = np.r_[starts[1:], len(words)] - (GAP - 1)
            for w in WIDTHS:
                responses = (vectors @ params[w].transpose(1, 0, 2).reshape(DIMENSIONS, -1)).reshape(len(used), w, FILTERS)
                response = responses[inside, 0]
                for j in range(1, w):
                    response[:-j] += responses[inside[j:], j]
                best = np.stack([s + response[s:e].argmax(axis=0) for s, e in zip(starts, ends)])
                winners.append(best)
                pooled.append(np.take_along_axis(response, best, axis=0))
            pooled = np.concatenate(pooled, axis=1) + params["bias"]
            active = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ params["weight"] + params["intercept"], -60, 60)))
            error = ((p - labels[chosen]) * class_weight[chosen] / len(chosen)).astype(real)
            grads = {"weight": active.T @ error + real(1e-3) * params["weight"], "intercept": np.array([error.sum()])}
            back = error[:, None] * params["weight"] * (pooled > 0)
            grads["bias"] = back.sum(axis=0)
            won, pushed = [], []
            for n, w in enumerate(WIDTHS):
                part = back[:, n * FILTERS : (n + 1) * FILTERS]
                grads[w] = np.zeros_like(params[w])
                for j in range(w):
                    at = inside[np.minimum(winners[n] + j, len(words) - 1)]
                    grads[w][j] = np.einsum("bf,bfd->df", part, vectors[at])
                    won.append(at.ravel())
                    pushed.append((part[..., None] * params[w][j].T[None]).reshape(-1, DIMENSIONS))
            touched, place = np.unique(rows[used[np.concatenate(won)]], return_inverse=True)
            row_grad = np.zeros((len(touched), DIMENSIONS), real)
            np.add.at(row_grad, place.reshape(-1, PARTS), np.concatenate(pushed)[:, None, :])
            step += 1
            scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, grad, at in [*((k, g, slice(None)) for k, g in grads.items()), ("embedding", row_grad, touched)]:
                first[k][at] += real(0.1) * (grad - first[k][at])
                second[k][at] += real(0.001) * (grad**2 - second[k][at])
                params[k][at] -= real(scale) * first[k][at] / (np.sqrt(second[k][at]) + real(1e-8))
            params["embedding"][BUCKETS] = 0
    params["embedding"][:, 0] = log_odds(texts, labels)
    return Model(params["embedding"], {w: params[w] for w in WIDTHS}, params["bias"], params["weight"], float(params["intercept"][0]))


def best_cut(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The logit above which the F1 of "toxic" is greatest, halfway to the next lower score; ``counts``
    are the rows that a score and label stand for, one unless given."""
    counts = np.ones(len(scores)) if counts is None else counts
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum((labels * counts)[order])
    f1 = 2 * hits / (np.cumsum(counts[order]) + (labels * counts).sum())
    last = np.r_[scores[order][1:] != scores[order][:-1], True]
    best = int(np.argmax(np.where(last, f1, -1)))
    below = scores[order][best + 1] if best + 1 < len(order) else scores[order][best] - 1
    return float((scores[order][best] + below) / 2)


def binned(docs: DataFrame, marks: DataFrame, model: Model, learned: list[int]) -> pd.DataFrame:
    """(fitted, lang, bin, toxic, n): all labelled rows counted by the bin of their logit; ``fitted`` are
    those of the bounded list ``learned``.

    ``marks`` has (doc_id, toxic), an id once. Texts are scored where they lie; only ids, languages and
    bins are shuffled. Of a repeated id one row counts.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = "doc struct<doc_id: long, lang: string>, bin int"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for doc, texts in blocks(batch, 100):
                bins = np.floor(np.clip(scorer.logits([hashed(t) for t in texts]), -GREATEST, GREATEST) * BINS)
                yield pa.RecordBatch.from_arrays([doc.cast(out.field("doc").type), pa.array(bins.astype(np.int32))], schema=out)

    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).alias("doc")
    texts = docs.filter("text is not null and doc_id is not null").select(own, F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(released(run), schema).groupBy("doc.doc_id").agg(F.min(F.struct("bin", "doc.lang")).alias("row"))
    fitted = spark.createDataFrame([(i, True) for i in learned], "doc_id long, fitted boolean")
    rows = found.join(marks, "doc_id").join(F.broadcast(fitted), "doc_id", "left")
    return rows.groupBy(F.coalesce("fitted", F.lit(False)).alias("fitted"), "row.lang", "row.bin", "toxic").agg(F.count("*").alias("n")).toPandas()


def calibrate(model: Model, counts: pd.DataFrame) -> None:
    """Sets the shift and the thresholds from what ``binned`` counted outside the fit; inside it only if a
    class is missing there. The rows of a class stand for all of it, as the fit took more of the rarer."""
    outside = counts[~counts["fitted"].astype(bool)]
    judge = outside if set(outside["toxic"]) == {0, 1} else counts
    scores = (judge["bin"].to_numpy(np.float64) + 0.5) / BINS
    labels, rows, langs = judge["toxic"].to_numpy(np.float64), judge["n"].to_numpy(np.float64), judge["lang"].to_numpy(object)
    weight = rows * judge["toxic"].map(counts.groupby("toxic")["n"].sum() / judge.groupby("toxic")["n"].sum()).to_numpy(np.float64)
    overall = best_cut(scores, labels, weight)
    to_cut = float(np.log(CUT / (1 - CUT)))
    model.shift = to_cut - overall
    for lang in sorted({x for x in langs[labels > 0] if isinstance(x, str)}):
        which = langs == lang
        positives = (rows * labels)[which].sum()
        own = best_cut(scores[which], labels[which], weight[which])
        cut = to_cut + positives / (positives + PSEUDO_POSITIVES) * (own - overall)
        model.thresholds[lang] = float(1 / (1 + np.exp(-cut)))


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """A model from the text and lang of ``docs`` and the toxic of ``labels``; None if a class is missing.

    A hash of the id chooses about ``sample_per_class`` labelled ids of each class. That bounded list is
    broadcast, so the texts are scanned but never shuffled, and only the chosen ones reach the driver.
    The shift and the thresholds come from all labelled rows outside the fit.
    Null labels, ids and texts are not used; of a repeated id the greatest label and one text count.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if set(counts) != {0, 1}:
        return None
    share = F.when(F.col("toxic") == 1, min(1.0, sample_per_class / counts[1])).otherwise(min(1.0, sample_per_class / counts[0]))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity")), F.lit(1_000_000)) / 1_000_000
    texts_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts_of.filter("text is not null").join(F.broadcast(marks.filter(draw < share)), "doc_id").dropDuplicates(["doc_id"])
    rows = found.toPandas().sort_values("doc_id")
    texts = [hashed(t) for t in rows["text"]]
    labels = rows["toxic"].to_numpy(np.float64)
    held = np.random.default_rng(11).permutation(len(texts)) < HELD_BACK * len(texts)
    if len(set(labels)) < 2:
        return None
    if len(set(labels[held])) < 2 or len(set(labels[~held])) < 2:
        held[:] = False
    model = train([t for t, h in zip(texts, held) if not h], labels[~held])
    calibrate(model, binned(docs, marks, model, rows["doc_id"][~held].tolist()))
    return model


def _make(shared):
    def make():
        scorer = Scorer(shared.value)

        def run(texts: list[str]) -> dict:
            raw = np.concatenate([scorer.logits([hashed(t) for t in texts[s : s + 100]]) for s in range(0, len(texts), 100)])
            return {"score": 1 / (1 + np.exp(-np.clip(raw, -500, 500)))}

        return run

    return make


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) for every whole text, 0 to 1; without a model every score is 0."""
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.0).alias("score"))
    return map_texts(docs, _make(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")


def threshold_of(model: Model | None, lang: str = "lang"):
    """The threshold of a row's language as a column: its own one where it has it, else CUT."""
    own = [F.lit(x) for pair in sorted((model.thresholds if model else {}).items()) for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*own), F.col(lang)), F.lit(CUT)) if own else F.lit(CUT)


def kept(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` (with text and lang) that score below the threshold of their language."""
    if model is None:
        return docs
    found = with_found(docs, _make(docs.sparkSession.sparkContext.broadcast(model)), "score double")
    return found.filter(F.col("found.score") < threshold_of(model, "doc.lang")).select(*unpacked(docs))
