import math

import numpy as np
import pytest

from lapsewise.llm import maxscore


@pytest.mark.parametrize("seed", range(6))
def test_top_of_a_shard_against_all_scores(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        n, terms, k = int(rng.integers(1, 70)), int(rng.integers(1, 24)), int(rng.integers(1, 9))
        vectors = rng.integers(-4, 5, (n, terms)) * (rng.random((n, terms)) < rng.random())
        query, names = rng.integers(-4, 5, terms), rng.integers(0, 9, n)
        own = int(rng.integers(0, n)) if rng.random() < 0.7 else None
        places, scores = maxscore.Postings(vectors).top(query, k, names, own)
        full = vectors @ query
        wanted = sorted((-full[i], names[i], i) for i in range(n) if i != own)[:k]
        assert [(-s, names[i], i) for i, s in zip(places, scores)] == wanted


def plain(rows, k=20):
    usable = [(r, v, [math.floor(64 * x) for x in e]) for r, (v, e) in enumerate(rows) if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for r, v, e in usable:
        if v is not None and v % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(e, f)), w is None, w if w is not None else 0, s) for s, w, f in usable if s != r)
            out += [(v, n + 1, None if none else w, -score) for n, (score, none, w, _) in enumerate(scored[:k])]
    return sorted(out, key=str)


def test_op6_query(spark, folder):
    from lapsewise.llm.queries import op6_maxscore

    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/full/embeddings.parquet").collect()]
    found = sorted((tuple(r) for r in op6_maxscore(spark, f"{folder}/full").select("query_id", "rank", "vec_id", "score").collect()), key=str)
    assert [x for x in found] == plain(rows)
    assert op6_maxscore(spark, f"{folder}/empty").count() == 0


def test_blocks_and_shards_give_one_result(spark, folder):
    vectors = maxscore.integer_vectors(spark.read.parquet(f"{folder}/full/embeddings.parquet"))
    queries = vectors.filter("vec_id % 3 = 0")
    columns = ["query_row", "query_id", "rank", "vec_id", "score"]
    one = sorted(map(str, maxscore.top_k(vectors, queries, 5).select(columns).collect()))
    many = sorted(map(str, maxscore.top_k(vectors, queries, 5, shard_rows=7, block_rows=4).select(columns).collect()))
    assert one == many and len(one) > 0
