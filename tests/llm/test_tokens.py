import array
import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lapsewise.llm import byte_bpe, packing, token_counts
from lapsewise.llm.units import slices

RANKS, PIECES, VOCABULARY = (P.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model", "byte_bpe_50k.json"))
ODD = st.lists(
    st.sampled_from([" ", "  ", "\n", "\t", "\x1c", "\x85", "　", "a", "b", "é", "1", "23", "'re", "'", "re", "'s", ".", "!", "日本", "😀", "²", "the", "\r\n", "▁", "</s>", "<|endoftext|>"]),
    max_size=40,
).map("".join)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def vocabulary():
    return Tokenizer.from_file(VOCABULARY)


@settings(max_examples=300, deadline=None)
@given(ODD, st.integers(1, 30))
def test_slices_keep_the_text(text, size):
    assert "".join(slices(text, size)) == text


@settings(max_examples=400, deadline=None)
@given(text=ODD)
def test_units_encode_as_the_library(text, reference, vocabulary):
    with open(RANKS, "rb") as file:
        encoder = byte_bpe._encoder(file.read(), P.PATTERN)
    assert np.frombuffer(encoder.ids(text, 8), "<u4").tolist() == reference.encode_ordinary(text)
    with open(VOCABULARY, encoding="utf-8") as file:
        encoder = packing._encoder(file.read())
    assert np.frombuffer(encoder.ids(text, 8), "<u4").tolist() == vocabulary.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(text=ODD, chunk=st.integers(4, 20), overlap=st.integers(1, 12))
def test_stitched_pieces_encode_as_the_whole(text, chunk, overlap, reference):
    chunks = []
    for number, start in enumerate(range(0, len(text), chunk)):
        found = byte_bpe.boundaries(text[start : start + chunk + overlap], P.PATTERN, start + chunk >= len(text))
        chunks.append((number, [b for b in found if b < overlap], [b for b in found if b >= chunk]))
    cuts = byte_bpe.stitch(chunks, chunk)
    ids = [i for a, b in zip(cuts, [*cuts[1:], len(text)]) for i in reference.encode_ordinary(text[a:b])]
    assert ids == reference.encode_ordinary(text)


@settings(max_examples=400, deadline=None)
@given(text=ODD, chunk=st.integers(4, 20), overlap=st.integers(0, 12))
def test_spliced_counts_are_those_of_the_whole(text, chunk, overlap, pieces):
    spans = token_counts.chunk_spans(text, chunk, overlap)
    counted = [token_counts.stable_starts(pieces, text[a:b], a, low, high) for a, b, low, high in spans]
    assert token_counts.splice(counted) == len(pieces.encode(text))


@pytest.mark.parametrize("chunk, overlap", [(32_768, 2_048), (200, 60)])
def test_encode_and_decode(documents, rows_of, reference, chunk, overlap):
    wanted = sorted((str(i), reference.encode_ordinary(t), t.encode()) for i, t in rows_of)
    encoded = byte_bpe.encode(documents, RANKS, P.PATTERN, chunk, overlap)
    at_once = byte_bpe.encode(documents, RANKS, P.PATTERN, chunk, overlap, decoded=True)
    for frame in (byte_bpe.decode(encoded, RANKS), at_once):
        assert sorted((str(r["doc_id"]), r["ids"], bytes(r["raw"])) for r in frame.collect()) == wanted


def test_op2_digests(spark, folder, rows_of, reference):
    from lapsewise.llm.queries import op2_byte_bpe

    found = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op2_byte_bpe(spark, f"{folder}/full").collect())
    wanted = []
    for i, t in rows_of:
        ids = reference.encode_ordinary(t)
        wanted.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert found == sorted(wanted)
    assert op2_byte_bpe(spark, f"{folder}/empty").count() == 0


@pytest.mark.parametrize("chunk, overlap", [(32_768, 512), (150, 20)])
def test_token_counts(documents, rows_of, pieces, chunk, overlap):
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in token_counts.token_counts(documents, PIECES, chunk, overlap).collect())
    assert found == sorted((str(i), len(t.encode()), len(pieces.encode(t))) for i, t in rows_of)


def test_a_vocabulary_that_spans_words_is_refused():
    class Spanning:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    real, sentencepiece.SentencePieceProcessor = sentencepiece.SentencePieceProcessor, lambda **_: Spanning()
    try:
        with pytest.raises(ValueError, match="spans a word boundary"):
            token_counts._model(b"another model")
    finally:
        sentencepiece.SentencePieceProcessor = real


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 256), max_size=60))
def test_differencing_packs_everything_once(sizes):
    groups = packing.pack(sizes, 1024)
    assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
    assert all(0 < sum(sizes[i] for i in g) <= 1024 for g in groups)


def test_differencing_balances_opposing_imbalances():
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in g) for g in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]
    sums = sorted(sum([5, 5, 5, 4, 4, 3, 3, 1][i] for i in g) for g in packing.differencing([5, 5, 5, 4, 4, 3, 3, 1], 3))
    assert sum(sums) == 30 and sums[-1] - sums[0] <= 2


def test_packed_sequences(documents, rows_of, vocabulary, no_documents):
    found = packing.packed(documents, VOCABULARY, group_windows=2).collect()
    wanted = []
    for i, t in rows_of:
        ids = [*vocabulary.encode(t, add_special_tokens=False).ids, 0]
        wanted += [(str(i), a, n, zlib.crc32(array.array("I", ids[a : a + n]).tobytes()), len(ids)) for a, n in packing.cut(len(ids))]
    assert sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) == sorted(wanted)
    sequences: dict = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.packed(no_documents, VOCABULARY).count() == 0


def test_many_groups_share_the_tasks(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('word ', 40) AS text")
    found = packing.packed(docs, VOCABULARY, window=16, piece=4, group_windows=1)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    assert found.select(F.shiftright("sequence_id", packing.GROUP_SHIFT)).distinct().count() > 8 * tasks
    assert found.rdd.getNumPartitions() <= tasks
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 16").isEmpty()


def test_padding_is_little(spark, vocabulary):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["word"] * int(n))) for i, n in enumerate(rng.lognormal(5, 1, 600))]
    found = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY)
    row = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.sum("n"), F.count("*")).first()
    assert row[0] / (1024 * row[1]) > 0.97
