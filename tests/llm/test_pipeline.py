import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
import public_tokenizers
from lapsewise.llm import language, toxicity
from tests.llm.test_simhash import plain_fingerprint, plain_groups
from tests.llm.test_substring import plain

WORDS = {
    "en": "the and of house river with under morning which something garden window".split(),
    "de": "der und nicht schön haus fluß über morgen welche etwas garten fenster".split(),
}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean and toxic documents in two languages, copies, near copies, shared passages, texts without letters."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(160):
        lang = ("en", "de")[i % 2]
        words = rng.choice(WORDS[lang], rng.integers(30, 120)).tolist()
        words = [f"{w}{rng.integers(0, 40)}" if rng.random() < 0.3 else w for w in words]
        toxic = int(i % 5 == 0)
        if toxic:
            for at in (5, 15, 25):
                words.insert(at, "dolt")
        rows.append((i, " ".join(words), lang, f"s{i % 4}", 0))
        labels.append((i, 1, toxic))
    passage = " ".join(f"{w}{k}" for k, w in enumerate(WORDS["en"] * 6))
    for i, base in enumerate((1, 2, 3, 4)):
        rows.append((200 + i, rows[base][1], "en", "copy", 0))  # copies
        rows.append((300 + i, f"{rows[base][1]} end{i} {passage} tail{i}", "en", "passage", 0))
    rows += [(400, "", "en", "s", 0), (401, None, "en", "s", 0), (402, "123 !!! 456", None, None, None)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, corpus):
    """What goes into each stage and comes out of it."""
    docs, found = spark.read.parquet(f"{corpus}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, corpus).cache()
        found[name] = (docs, out)
        docs = out
    return found


def texts(frame) -> dict:
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_all_but_the_last_return_the_columns_of_documents(stages, spark, corpus):
    columns = spark.read.parquet(f"{corpus}/documents.parquet").dtypes
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "language ID", "SimHash near-dedup", "substring dedup", "packing"]
    for name, _ in pipeline.STAGES[:-1]:
        assert stages[name][1].dtypes == columns


def test_toxic_documents_go_and_clean_ones_stay(stages, spark, corpus):
    kept = texts(stages["toxicity"][1])
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{corpus}/labels.parquet").collect()}
    assert not [i for i, toxic in labels.items() if toxic and i in kept]
    assert sum(i in kept for i, toxic in labels.items() if not toxic) >= 0.97 * sum(not t for t in labels.values())
    model = toxicity.fit(spark.read.parquet(f"{corpus}/documents.parquet"), spark.read.parquet(f"{corpus}/labels.parquet"))
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(stages["toxicity"][0], model).collect()}
    assert kept.keys() == {i for i, s in scored.items() if s < toxicity.CUT}


def test_documents_without_a_language_go(stages):
    before, kept = texts(stages["language ID"][0]), texts(stages["language ID"][1])
    assert before.keys() - kept.keys() == {i for i, t in before.items() if not language.has_letters(t or "")}
    assert {400, 401, 402} & kept.keys() == set()


def test_one_of_each_group_stays(stages):
    before, kept = texts(stages["SimHash near-dedup"][0]), texts(stages["SimHash near-dedup"][1])
    prints = {i: plain_fingerprint(t) for i, t in before.items()}
    groups = plain_groups(sorted(set(prints.values())))
    first = {g: min(i for i, p in prints.items() if groups[p] == g) for g in set(groups.values())}
    assert kept.keys() == {i for i, p in prints.items() if first[groups[p]] == i}


def test_repeated_passages_go(stages):
    before, after = texts(stages["substring dedup"][0]), texts(stages["substring dedup"][1])
    wanted = {int(i): (gone, kept) for i, _, gone, kept in plain(list(before.items()), 50)}
    assert after == {i: kept if gone else before[i] for i, (gone, kept) in wanted.items()}
    assert sum(gone > 0 for gone, _ in wanted.values()) >= 2
    sizes = {r["doc_id"]: r["n_chars"] for r in stages["substring dedup"][1].collect()}
    assert all(sizes[i] == len(after[i]) for i, (gone, _) in wanted.items() if gone)


def test_sequences_hold_what_is_left(stages, spark, corpus):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left = texts(stages["packing"][0])
    found: dict = {}
    for r in stages["packing"][1].collect():
        found.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    assert found.keys() == left.keys()
    for i, text in left.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 0], 0
        for start, length, crc in sorted(found[i]):
            assert start == at and crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    # the same pieces; in which sequence a piece lies follows from its number as stored
    whole = pipeline.run(spark, corpus).collect()
    assert sorted(tuple(r)[:5] for r in whole) == sorted(tuple(r)[:5] for r in stages["packing"][1].collect())
    places: dict = {}
    for r in whole:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024


def test_stages_on_empty_and_odd_documents(spark, folder, documents):
    odd = spark.read.parquet(f"{folder}/full/documents.parquet")
    for tables, docs in ((f"{folder}/full", odd), (f"{folder}/empty", odd.limit(0))):
        for _, stage in pipeline.STAGES:
            assert stage(spark, docs, tables).count() >= 0
    assert pipeline.run(spark, f"{folder}/empty").count() == 0
    assert "fingerprint" in documents.columns
    for _, stage in pipeline.STAGES[:-1]:  # columns named like results
        assert stage(spark, documents, f"{folder}/full").columns == documents.columns


def test_queries_are_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert pipeline.ORACLE_SQL is None
