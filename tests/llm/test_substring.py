import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import GroupedData
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from lapsewise.llm import substring


def plain(rows: list[tuple], window: int) -> list[tuple]:
    """(id, words, removed, kept) by comparing all windows."""
    first: dict = {}
    split = [(i, t.encode().split()) for i, t in rows]
    for i, words in split:
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            first[key] = min(first.get(key, substring.NO_DOC), substring.NO_DOC if i is None else i)
    out = []
    for i, words in split:
        gone = set()
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < (substring.NO_DOC if i is None else i):
                gone.update(range(p, p + window))
        out.append((str(i), len(words), len(gone), b" ".join(w for p, w in enumerate(words) if p not in gone).decode()))
    return sorted(out)


def found(frame) -> list[tuple]:
    return sorted((str(r["doc_id"]), r["cut"]["n_words"], r["cut"]["n_removed"], r["cut"]["kept"]) for r in frame.collect())


def test_against_all_windows(documents, rows_of, no_documents):
    result = substring.repeats(documents, window=50, shard_bytes=2_000)
    assert result.columns == [*documents.columns, "cut"]
    assert found(result) == plain(rows_of, 50)
    assert substring.repeats(no_documents).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_few_words_make_many_overlapping_repeats(spark, seed):
    rng = random.Random(seed)
    phrases = [" ".join(rng.choice("abc") for _ in range(rng.randint(3, 25))) for _ in range(8)]
    rows = [(i // 2 if i % 7 == 0 else i, " ".join(rng.choice(phrases) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    rows += [(None, rows[3][1]), (None, rows[3][1]), (61, rows[3][1]), (61, rows[3][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for window in (6, 10):
        result = substring.repeats(frame, window=window, shard_bytes=300)
        assert found(result) == plain(rows, window)


def test_spans_are_maximal_repeats(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, f"a b {passage} c"), (2, f"x {passage} y"), (3, passage), (4, "p1 p2")]
    result = substring.repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=10)
    spans = {r["doc_id"]: [tuple(s) for s in r["cut"]["spans"]] for r in result.collect()}
    assert spans == {1: [], 2: [(1, 31)], 3: [(0, 30)], 4: []}


def test_rolling_hash_is_that_of_each_window():
    values = np.arange(20, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values[12:17] = values[2:7]
    rolled = substring.rolling(values, 5, substring.BASES[0])
    assert len(rolled) == 16 and rolled[12] == rolled[2] and len(set(rolled.tolist())) == 15
    assert len(substring.rolling(values[:3], 5, substring.BASES[0])) == 0


def test_keys_survive_packing():
    rng = np.random.default_rng(1)
    for bits, width in ((1, 5), (6, 5), (8, 8), (24, 5), (30, 5)):
        parts = substring.Parts(bits, width)
        keys = np.unique(parts.short(rng.integers(0, 2**63, 50).astype(np.uint64) * np.uint64(2)))
        back = [parts.unpack(raw, part) for part, _, raw in parts.split(keys)]
        assert np.concatenate(back).tolist() == keys.tolist()


def test_op4_query(spark, folder, rows_of):
    from lapsewise.llm.queries import op4_substring

    result = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op4_substring(spark, f"{folder}/full").collect())
    assert result == sorted(
        (i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in plain(rows_of, 50)
    )


def test_a_shard_is_never_held_as_words_nor_sorted_at_once(spark, monkeypatch):
    steps = {}
    for ops in (GroupedData, PandasCogroupedOps):

        def recorded(self, func, schema, plain=ops.applyInArrow):
            steps[func.__name__] = func
            return plain(self, func, schema)

        monkeypatch.setattr(ops, "applyInArrow", recorded)
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(50_000)}" for _ in range(500))) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)]
    substring.repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=50, part_hashes=10_000)
    shard = pa.table({"doc": pa.array([{"doc_id": i, "text": t} for i, t in rows]), "shard": pa.array([0] * len(rows), pa.int32())})
    peaks = {}

    def peak(name, *tables):
        tracemalloc.start()
        result = steps[name](*tables)
        peaks[name] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return result

    def by_part(name, table):
        return pa.concat_tables([steps[name](table.filter(pc.equal(table["part"], p))) for p in pc.unique(table["part"])])

    hits = by_part("match", peak("probe", shard))
    done = peak("remove", shard, by_part("settle", peak("extend", shard, hits)))
    assert {c["n_removed"] for c in done["cut"].to_pylist()[:400]} == {0}
    # the smaller id of a pair lies in this shard too, so all of a copy goes
    assert [c["n_removed"] for c in done["cut"].to_pylist()[400:]] == [500] * 40
    n_words = 500 * len(rows)
    assert {name: bytes_used for name, bytes_used in peaks.items() if bytes_used > 60 * n_words} == {}
