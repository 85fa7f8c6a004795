import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import pitman_yor as py


def posterior(customers: int, weight: float, discount: float) -> np.ndarray:
    """Of the number of tables of one dish, by generalised Stirling numbers."""
    ways = np.zeros((customers + 1, customers + 1))
    ways[0, 0] = 1
    for n in range(customers):
        for t in range(n + 1):
            ways[n + 1, t + 1] += ways[n, t]
            ways[n + 1, t] += ways[n, t] * (n - t * discount)
    p = ways[customers] * weight ** np.arange(customers + 1)
    return p / p.sum()


@pytest.mark.parametrize("customers, weight", [(2, 0.3), (3, 0.5), (5, 1.2), (9, 0.1)])
def test_sweeps_sample_the_posterior(customers, weight):
    seating = py.Seating(np.full(40_000, customers), 0.8, np.random.default_rng(1))
    for _ in range(8):
        tables = seating.sweep(np.full(40_000, weight))
    assert np.allclose(np.bincount(tables, minlength=customers + 1) / 40_000, posterior(customers, weight, 0.8), atol=0.012)


def test_seatings_stay_consistent():
    rng = np.random.default_rng(2)
    counts = rng.zipf(1.6, 500).clip(max=3000)
    seating = py.Seating(counts, 0.7, rng)
    for _ in range(3):
        tables = seating.sweep(rng.random(500))
        assert (tables >= 1).all() and (tables <= counts).all() and (tables[counts == 1] == 1).all()
        sizes = np.bincount(seating.table, minlength=len(seating.filled))
        assert np.array_equal(sizes, seating.filled)
        assert np.array_equal(np.bincount(seating.dish, seating.filled).astype(int), seating.size)
        assert np.array_equal(np.bincount(seating.dish, seating.filled > 0).astype(int), seating.count)


def test_deal_splits_heavy_classes_only():
    tokens = np.zeros(py.CONTEXTS, np.int64)
    tokens[:100] = 10
    tokens[7] = 5000
    first, parts, n = py.deal(tokens, 500)
    assert parts[7] == 20 and (np.delete(parts, 7) == 1).all() and n == first[7] + 20
    load = np.bincount(np.delete(first, 7), np.delete(tokens, 7), n)
    assert load.max() <= 510


def tokens_of(text: str) -> list:
    return [*text.encode().lower().split(), None]


def check(rows, found, held):
    counts = collections.Counter(w for i, t in rows if not held(i) for w in tokens_of(t))
    total, vocabulary = sum(counts.values()), len(counts)
    assert len(found) == len(rows)
    wanted = sorted((str(i), held(i), len(tokens_of(t)), sum(w in counts for w in tokens_of(t)), total, round(sum(math.log10((counts[w] + 1) / (total + vocabulary + 1)) for w in tokens_of(t)), 6)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == wanted
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in found)
    assert all(math.isclose(r["perplexity"], 10 ** (-r["score"] / r["n_tokens"]), rel_tol=1e-9) for r in found)


def fold(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_counts_and_base_scores(documents, rows_of, no_documents):
    held = (F.crc32(F.col("doc_id").cast("string")) % 7).eqNullSafe(2)
    check(rows_of, py.scores(documents, held).collect(), fold)
    assert py.scores(no_documents, held).count() == 0


def test_split_classes_and_many_parts_keep_the_counts(documents, rows_of):
    held = (F.crc32(F.col("doc_id").cast("string")) % 7).eqNullSafe(2)
    check(rows_of, py.scores(documents, held, part_tokens=120).collect(), fold)


def test_all_held_out(documents, rows_of):
    check(rows_of, py.scores(documents, F.lit(True)).collect(), lambda i: True)


def chain(n: int, seed: int) -> list[tuple]:
    """Texts in which a word tells much about the next."""
    rng = np.random.default_rng(seed)
    follow = rng.permutation(200)
    rows = []
    for i in range(n):
        word, text = int(rng.integers(0, 200)), []
        for _ in range(30):
            text.append(f"w{word}")
            word = int(follow[word]) if rng.random() < 0.8 else int(rng.integers(0, 200))
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("part_tokens", [1_000_000, 300])
def test_the_model_learns_what_follows(spark, part_tokens):
    frame = spark.createDataFrame(chain(300, 3), "doc_id long, text string")
    row = py.scores(frame, F.col("doc_id") % 5 == 0, part_tokens).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert -row[0] / row[2] < -row[1] / row[2] - 0.5


def test_predictive_probabilities_sum_to_one():
    """In every context, the known tokens and one place for all others share a probability of one."""
    train = [t for _, t in chain(12, 1)]
    known = sorted({w for t in train for w in t.split()})
    probes = [f"{w} {v}" for w in [*known[:5], "unseen"] for v in [*known, "other"]] + ["", *known[:5], "unseen"]
    texts = [*train, *probes]
    held = [n >= len(train) for n in range(len(texts))]
    tokens = [py.hashes(t) for t in texts]
    customers = sum(np.bincount(py.word_class(t), minlength=py.CONTEXTS) for t, h in zip(tokens, held) if not h)
    first, parts, n = py.deal(sum(np.bincount(py.word_class(t), minlength=py.CONTEXTS) for t in tokens))
    names = "part block docs words counts contexts places held nulls".split()
    rows = [dict(zip(names, r)) for r in py.block_rows(0, list(range(len(texts))), held, tokens, first, parts, n)]
    part = py.Part([r for r in rows if r["words"]])
    told = [dict(zip("kind part sample chunk word customers guests payload".split(), r)) for r in py.sampled_rows(part, 0, customers, parts)]
    tables = np.zeros((py.SAMPLES, py.CONTEXTS), np.int64)
    for r in told:
        if r["kind"] == 1:
            tables[r["sample"], r["chunk"] * py.CHUNK : (r["chunk"] + 1) * py.CHUNK] = np.frombuffer(r["payload"], "<i8")
    totals = [next(r for r in told if r["kind"] == 2 and r["sample"] == s) for s in range(py.SAMPLES)]
    guests, root = (np.array([t["guests"][k] for t in totals], float) for k in (0, 1))
    model = (tables, guests, root, totals[0]["customers"], int(customers.sum()))
    assert model[3] == len(known) + 1
    _, _, log_p = py._token_scores(part, told, customers, model)
    end = int(np.flatnonzero(part.words == np.uint64(py.END))[0])
    other = int(np.flatnonzero(part.words == py.hashes("other")[0])[0])
    vocabulary = {int(np.flatnonzero(part.words == py.hashes(w)[0])[0]) for w in known} | {end, other}
    checked = 0
    for context in np.unique(part.pair_context):
        here = part.pair_context == context
        if vocabulary <= set(part.pair_word[here].tolist()):
            total = sum(10 ** log_p[i] for i in np.flatnonzero(here) if part.pair_word[i] in vocabulary)
            assert math.isclose(total, 1, rel_tol=1e-9)
            checked += 1
    assert checked >= 6


def test_score_is_repeatable(spark):
    frame = spark.createDataFrame(chain(40, 5), "doc_id long, text string")
    held = F.col("doc_id") % 5 == 0
    one, two = (sorted(map(tuple, py.scores(frame, held, 200).collect())) for _ in range(2))
    assert one == two
