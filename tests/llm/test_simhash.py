import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lapsewise.llm import simhash
from lapsewise.llm.components import components


def plain_fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(codes: list[int], max_bits: int = 3) -> dict[int, int]:
    group = {c: c for c in codes}

    def root(c):
        while group[c] != c:
            c = group[c]
        return c

    for a in codes:
        for b in codes:
            if (a ^ b).bit_count() <= max_bits:
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    return {c: root(c) for c in codes}


def test_fingerprint_in_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 5)
    for text in ("", "a", "A b", "a b c", " ".join("abcdefghij" * 3), "É é x\ty"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_xxhash_is_sparks(spark):
    from pyspark.sql import functions as F

    value = spark.range(1).select(F.xxhash64(F.lit("the old wolf"))).first()[0]
    assert value % 2**64 == xxhash.xxh64_intdigest("the old wolf", seed=42)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2**64 - 1) | st.integers(0, 600)), min_size=1, max_size=80, unique=True))
def test_index_finds_all_pairs_of_a_bucket(rows):
    bucket = np.array([b for b, _ in rows], np.int64)
    codes = np.array([c for _, c in rows], np.uint64)
    order = np.lexsort((simhash.gray_rank(codes), bucket))
    bucket, codes = bucket[order], codes[order]
    found = {(i, j) for a, b in simhash.GrayIndex(bucket, codes).pairs(3) for i, j in zip(a.tolist(), b.tolist())}
    n = len(codes)
    wanted = {(i, j) for i in range(n) for j in range(i + 1, n) if bucket[i] == bucket[j] and (int(codes[i]) ^ int(codes[j])).bit_count() <= 3}
    assert found == wanted


def test_links_connect_what_is_near_even_when_buckets_are_dealt_again(spark):
    rng = np.random.default_rng(5)
    near = [0x0123456789ABCDEF ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(60)]
    codes = sorted({*near, *rng.integers(0, 2**63, 40).tolist(), 0, 1, 3, 2**64 - 1})
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame([(c,) for c in signed], "code long")
    for limit in (4096, 8):
        links = simhash.code_links(rows, 3, bucket_codes=limit)
        found = {r["node"]: r["component"] for r in components(links).collect()}
        groups = plain_groups(codes)
        by_group: dict = {}
        for code, s in zip(codes, signed):
            by_group.setdefault(groups[code], set()).add(found.get(s, s))
        assert all(len(v) == 1 for v in by_group.values())
        assert len({next(iter(v)) for v in by_group.values()}) == len(by_group)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (3, 2)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_against_all_pairs(documents, rows_of):
    found = sorted((r["doc_id"] is None, r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents).collect())
    prints = [(i, plain_fingerprint(t)) for i, t in rows_of]
    groups = plain_groups(sorted({p for _, p in prints}))
    smallest = {g: min((i for i, p in prints if groups[p] == g and i is not None), default=None) for g in set(groups.values())}
    assert found == sorted((i is None, i, f"{p:016x}", smallest[groups[p]]) for i, p in prints)


def test_one_of_each_group_stays(documents, no_documents):
    kept = simhash.keep_one(documents)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == documents.columns
    # two rows of id 9 with the same text are one document, of which one row stays
    assert 2 in ids and 3 not in ids and 4 not in ids and 10 in ids and 11 not in ids and ids.count(9) == 1 and None in ids
    assert simhash.keep_one(no_documents).count() == 0
