"""Byte-level BPE encoding and decoding, with huge documents encoded in parallel.

A text longer than ``chunk_chars`` is cut into chunks of that many characters, each with an overlap
into the next. Chunks are pre-tokenised wherever they land. A chunk may begin inside a pre-token,
but the pattern looks only forward, so from any boundary that two neighbouring chunks both found,
and that is true for the left one, they agree for good: there the document is stitched. The pieces
between stitches are encoded independently and their ids joined in order. Should two chunks share no
boundary (one unbroken run longer than the overlap), the rest of the document is one piece: exact,
only less parallel. Decoding joins the bytes of the tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import arrow_schema, blocks, id_and_text, shuffle_tasks
from lapsewise.llm.units import UnitEncoder

#: A match ending so close to a chunk's end may change when more text follows ("'r" and "'re").
LOOKAHEAD = 3


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """The lines ``base64(token) rank`` of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


@lru_cache(2)
def _encoder(raw: bytes, pattern: str) -> UnitEncoder:
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=parse_ranks(raw), special_tokens={})
    return UnitEncoder(encoding.encode_ordinary)


@lru_cache(2)
def _token_bytes(raw: bytes) -> list[bytes]:
    ranks = parse_ranks(raw)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


@lru_cache(8)
def _compiled(pattern: str) -> regex.Pattern:
    """Python counts four control characters as white space, the tokenizer does not."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def boundaries(text: str, pattern: str, is_last: bool) -> list[int]:
    """Starts of the pre-tokens of a chunk that are sure if the chunk's own start is one. Those that
    follow white space are left out: a piece ending there would be split in another way."""
    trusted = len(text) - (0 if is_last else LOOKAHEAD)
    starts = [0]
    for match in _compiled(pattern).finditer(text):
        if match.end() > trusted or (match.end() == len(text) and not is_last):
            break
        if not match.group()[-1].isspace():
            starts.append(match.end())
    return starts


def stitch(chunks: list[tuple[int, list[int], list[int]]], chunk_chars: int) -> list[int]:
    """Cuts of a text from (number, boundaries in the first, in the last overlap) of its chunks, as
    positions in the text; stops at the first pair of chunks without a common boundary."""
    cuts = [0]
    for (number, _, tail), (_, head, _) in zip(chunks, chunks[1:]):
        base, following = number * chunk_chars, (number + 1) * chunk_chars
        common = {base + b for b in tail} & {following + b for b in head}
        common = [c for c in common if c > cuts[-1]]
        if not common:
            break
        cuts.append(min(common))
    return cuts


def _chunked(texts: DataFrame, chunk_chars: int, overlap: int) -> DataFrame:
    schema = "key string, number int, is_last boolean, text string"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, (text,) in ((k, t) for keys, group in blocks(batch, 1) for k, t in [(keys[0].as_py(), group)]):
                rows = [(key, n, s + chunk_chars >= len(text), text[s : s + chunk_chars + overlap]) for n, s in enumerate(range(0, len(text), chunk_chars))]
                for start in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[start : start + 256]), out)], schema=out)

    return texts.select("key", "text").mapInArrow(run, schema)


def _chunk_boundaries(chunks: DataFrame, pattern: str, chunk_chars: int, overlap: int) -> DataFrame:
    schema = "key string, number int, head array<int>, tail array<int>"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, numbers, lasts, texts = (c.to_pylist() for c in batch.columns)
            found = [boundaries(text, pattern, last) for text, last in zip(texts, lasts)]
            heads = [[b for b in f if b < overlap] for f in found]
            tails = [[b for b in f if b >= chunk_chars] for f in found]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((keys, numbers, heads, tails), out)], schema=out)

    return chunks.mapInArrow(run, schema)


def _pieces(cut: DataFrame, chunk_chars: int) -> DataFrame:
    """(key, number, piece) from (key, text, chunks): the text between stitches."""
    schema = "key string, number int, text string"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, text, chunks = (c[row].as_py() for c in batch.columns)
                cuts = stitch([(c["number"], c["head"], c["tail"]) for c in chunks], chunk_chars)
                parts = [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]
                for start in range(0, len(parts), 256):
                    some = parts[start : start + 256]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(some)), pa.array(range(start, start + len(some)), pa.int32()), pa.array(some, pa.string())], schema=out
                    )

    return cut.select("key", "text", "chunks").mapInArrow(run, schema)


def _arrays(packed: list[bytes]) -> pa.Array:
    """Packed ids as lists of numbers."""
    offsets = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def _decoded(ids: pa.Array, token) -> pa.Array:
    """The bytes of each list of ids, joined token by token."""
    numbers, offsets = ids.flatten().to_pylist(), ids.offsets.to_pylist()
    start = offsets[0]
    return pa.array([b"".join(map(token, numbers[a - start : b - start])) for a, b in zip(offsets, offsets[1:])], pa.binary())


def _encoded(rows: DataFrame, raw, pattern: str, decoded: bool) -> DataFrame:
    """The column ``text`` of ``rows``, their last, replaced by ``ids`` (and ``raw``)."""
    names = rows.columns[:-1]
    schema = ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes[:-1]), "ids array<int>", *["raw binary"] * decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, token = _encoder(raw.value, pattern), _token_bytes(raw.value).__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 250):
                part = batch.slice(start, 250)
                ids = _arrays([encoder.ids(t or "") for t in part.column(len(names)).to_pylist()])
                found = [ids, _decoded(ids, token)] if decoded else [ids]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found], names=[*names, "ids", "raw"][: len(names) + len(found)])

    return rows.mapInArrow(run, schema)


def encode(
    docs: DataFrame, ranks: str, pattern: str, chunk_chars: int = 32_768, overlap: int = 2_048, decoded: bool = False
) -> DataFrame:
    """(doc_id, ids) for every row, ``ids`` the numbers of the tokens; with ``decoded`` also ``raw``, the
    bytes that these numbers decode to, made in the same pass.

    ``ranks`` is the path of a rank file; the driver reads it and sends its bytes (a vocabulary, so
    of fixed size) to the tasks. A null text has no ids. Long texts are encoded once per distinct text.
    """
    spark = docs.sparkSession
    with open(ranks, "rb") as file:
        raw = spark.sparkContext.broadcast(file.read())
    rows = id_and_text(docs)
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    short = _encoded(rows.filter(~is_long), raw, pattern, decoded)
    long = rows.filter(is_long).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    texts = long.select("key", "text").dropDuplicates(["key"])
    tasks = shuffle_tasks(spark)
    chunks = _chunked(texts, chunk_chars, overlap).repartition(tasks, "key", "number")
    found = (
        _chunk_boundaries(chunks, pattern, chunk_chars, overlap)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("number", "head", "tail"))).alias("chunks"))
    )
    pieces = _encoded(_pieces(texts.join(found, "key"), chunk_chars).repartition(tasks, "key", "number"), raw, pattern, decoded)
    values = pieces.columns[2:]
    parts = pieces.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("number", *values))).alias("parts"))
    whole = parts.select("key", F.flatten("parts.ids").alias("ids"), *[_bytes_joined("parts.raw").alias("raw")] * decoded)
    return short.union(long.select("doc_id", "key").join(whole, "key").select("doc_id", *values))


def _bytes_joined(parts: str):
    """Binary values in one, by way of their digits: Spark joins lists of strings only."""
    return F.unhex(F.array_join(F.transform(parts, F.hex), ""))


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids, raw) from (doc_id, ids): ``raw`` joins the bytes of the tokens. The bytes of a
    text that was encoded are its UTF-8; any other sequence of ids gives bytes all the same."""
    with open(ranks, "rb") as file:
        raw = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _token_bytes(raw.value).__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 250):
                part = batch.slice(start, 250)
                yield pa.RecordBatch.from_arrays([*part.columns, _decoded(part.column(1), token)], names=["doc_id", "ids", "raw"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, raw binary")


__all__ = ["boundaries", "decode", "encode", "parse_ranks", "stitch"]
