"""Token counts of documents, with huge documents counted in parallel.

A text longer than ``chunk_chars`` becomes overlapping chunks that are encoded, with offsets, wherever
they land. Two neighbouring chunks are spliced at a boundary that both encodings show and that is
proven stable: a space after a character that is no space. No piece of the vocabulary holds a space
mark behind another character (checked when the model is loaded), so no token of the whole text can
reach across such a place, and what stands on either side cannot change the other. A chunk's overlap
is widened until it holds one; a text without any stays whole, and so is exact too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import arrow_schema, blocks, id_and_text, shuffle_tasks

SPACE_MARK = "▁"
_STABLE = re.compile(f"(?<=[^ {SPACE_MARK}]) ")


@lru_cache(2)
def _model(raw: bytes) -> sentencepiece.SentencePieceProcessor:
    model = sentencepiece.SentencePieceProcessor(model_proto=raw)
    for i in range(model.get_piece_size()):
        if SPACE_MARK in model.id_to_piece(i).lstrip(SPACE_MARK):
            raise ValueError("a piece of this vocabulary spans a word boundary: chunks cannot be spliced")
    if model.encode("a  b", out_type=str) != model.encode("a", out_type=str) + model.encode(" b", out_type=str):
        raise ValueError("this model drops spaces: chunks cannot be spliced")
    return model


def chunk_spans(text: str, chunk_chars: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(start, end, from, to) of overlapping chunks: a chunk is encoded from ``start`` to ``end`` and
    searched for splices in its overlaps, which hold at least one stable boundary each.

    ``from`` is where its left overlap ends, ``to`` where its right overlap begins.
    """
    starts = [0]
    ends, lefts, rights = [], [0], []
    position = chunk_chars
    while position < len(text):
        stable = _STABLE.search(text, position + 1)  # the right chunk must see the character before it
        if stable is None:
            break
        widened = max(position + overlap, stable.end() + overlap)
        rights.append(position)
        ends.append(min(len(text), widened))
        starts.append(position)
        lefts.append(min(len(text), widened))
        position = max(position + chunk_chars, stable.end() + 1)
    ends.append(len(text))
    rights.append(len(text))
    return list(zip(starts, ends, lefts, rights))


def stable_starts(model, text: str, base: int, low: int, high: int) -> tuple[int, list[tuple[int, int]]]:
    """The number of tokens of a chunk that begins at ``base``, and (position, tokens before it) for
    each token that begins at a stable boundary below ``low`` or from ``high`` on."""
    pieces = model.encode(text, return_type="proto").pieces
    raw, mark = text.encode(), SPACE_MARK.encode()
    low, high = (len(text[: max(0, x - base)].encode()) for x in (low, high))
    found = []
    for k, piece in enumerate(pieces):  # offsets count bytes
        at = piece.begin
        if (at < low or at >= high) and at and raw[at : at + 1] == b" " and raw[at - 1 : at] != b" " and not raw[:at].endswith(mark):
            found.append((base + len(raw[:at].decode()), k))
    return len(pieces), found


def splice(chunks: list[tuple[int, list[tuple[int, int]]]]) -> int:
    """Tokens of a text from (tokens, stable starts) of its chunks in order."""
    total, begin = 0, 0
    for (_, left), (_, right) in zip(chunks, chunks[1:]):
        after = dict(right)
        at = next((p for p, _ in left if p in after and dict(left)[p] >= begin), None)
        if at is None:
            raise ValueError("neighbouring chunks share no stable boundary")
        total += dict(left)[at] - begin
        begin = after[at]
    return total + chunks[-1][0] - begin


def token_counts(docs: DataFrame, model: str, chunk_chars: int = 32_768, overlap: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row; a null text counts as empty and has no tokens.

    ``model`` is the path of a sentencepiece model; the driver sends its bytes, a vocabulary of fixed
    size, to the tasks. Long texts are counted once per distinct text.
    """
    spark = docs.sparkSession
    with open(model, "rb") as file:
        raw = spark.sparkContext.broadcast(file.read())
    rows = id_and_text(docs)
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    short = _counted(rows.filter(~is_long), raw)
    long = rows.filter(is_long).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    texts = long.select("key", "text").dropDuplicates(["key"])
    chunks = _chunks(texts, chunk_chars, overlap).repartition(shuffle_tasks(spark), "key", "number")
    counted = _chunk_counts(chunks, raw).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("number", "n", "at", "before"))).alias("chunks"))
    whole = _spliced(counted)
    sizes = long.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"))
    return short.union(sizes.join(whole, "key").select("doc_id", "n_bytes", "n_tokens"))


def _counted(rows: DataFrame, raw) -> DataFrame:
    schema = "doc_id long, n_bytes long, n_tokens long"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(raw.value)
        for batch in batches:
            for ids, texts in blocks(batch):
                sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
                counts = [len(x) for x in model.encode(texts, num_threads=1)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], schema=out)

    return rows.mapInArrow(run, schema)


def _chunks(texts: DataFrame, chunk_chars: int, overlap: int) -> DataFrame:
    schema = "key string, number int, base int, low int, high int, text string"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, text = (c[row].as_py() for c in batch.columns)
                spans = chunk_spans(text, chunk_chars, overlap)
                for first in range(0, len(spans), 256):
                    some = [(key, first + n, s, low, high, text[s:e]) for n, (s, e, low, high) in enumerate(spans[first : first + 256])]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), out)], schema=out)

    return texts.select("key", "text").mapInArrow(run, schema)


def _chunk_counts(chunks: DataFrame, raw) -> DataFrame:
    schema = "key string, number int, n long, at array<int>, before array<int>"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(raw.value)
        for batch in batches:
            keys, numbers, bases, lows, highs, texts = (c.to_pylist() for c in batch.columns)
            found = [stable_starts(model, *x) for x in zip(texts, bases, lows, highs)]
            columns = (keys, numbers, [n for n, _ in found], [[p for p, _ in f] for _, f in found], [[k for _, k in f] for _, f in found])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return chunks.mapInArrow(run, schema)


def _spliced(counted: DataFrame) -> DataFrame:
    schema = "key string, n_tokens long"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, groups = (c.to_pylist() for c in batch.columns)
            totals = [splice([(c["n"], list(zip(c["at"], c["before"]))) for c in group]) for group in groups]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(totals, pa.int64())], schema=out)

    return counted.mapInArrow(run, schema)
