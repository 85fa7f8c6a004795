r"""Exact substring deduplication with fixed-block anchors.

A window is ``window`` consecutive words of one document. Every window holds a whole block of
``window / 2`` words that begins at a multiple of that number, so only such non-overlapping blocks of
the documents are indexed (the anchors), and they are probed with every rolling block of all
documents. A hit is extended by all windows around it; those that a document of smaller id also has
are joined into maximal repeats.

Documents are dealt by a hash into shards of a few MB, and each step below runs on whole shards:

1. a shard sends its distinct block hashes, as packed runs, to the parts of the hash range;
2. a part answers with the hashes that are anchors and occur in two documents or more, and the
   smallest document having such an anchor;
3. the shard extends the hits, and sends the hashes of the windows around them with their smallest
   document; a part answers with the smallest document of all;
4. the shard marks the words of each window that a smaller document has.

A shard sends a hash once however many of its documents share it, so a passage in a third of all
documents costs a part one entry a shard. Hashes, not texts, travel; the texts are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.llm.common import all_columns, arrow_schema, plane_pack, plane_unpack, shuffle_tasks, unpacked, words

#: Bytes of text in a shard.
SHARD_BYTES = 8_000_000
#: Hashes that a part of the hash range gets at most, on the average; a word and its space take two bytes or more.
PART_HASHES = 4_000_000
#: The hashes of a shard are sorted in this many slices of their range, so that a sort's copies stay small.
SLICE_BITS = 3
#: Bytes of kept words that a task holds as Python strings.
KEPT_BYTES = 1_000_000
NO_DOC = np.iinfo(np.int64).max
#: Odd multipliers of the rolling polynomials modulo 2^64: blocks, windows, windows' further bits.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Bytes kept of a block hash and of a window hash beside the bits that choose the part.
BLOCK_BYTES, WINDOW_BYTES = 5, 8


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """The polynomial hash of each ``width`` consecutive values, modulo 2^64, well mixed."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    inverse = np.uint64(pow(base, -1, 1 << 64))
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(hashes), np.uint64(base))])
    back = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, inverse)])
    sums = np.r_[np.uint64(0), np.cumsum(hashes * powers[:-1])]
    value = (sums[width:] - sums[:-width]) * back
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


class Shard:
    """The word hashes of the documents of a shard that are long enough to hold a window. Texts are
    read one after the other, and their words are not kept."""

    def __init__(self, docs: pa.ChunkedArray, window: int):
        self.window, self.block = window, window // 2
        self.ids = np.array([NO_DOC if i is None else i for c in docs.chunks for i in c.field("doc_id").to_pylist()], np.int64)
        self.long, self.hashes = [], []
        for i, tokens in enumerate(words_of(docs)):
            if len(tokens) >= window:
                self.long.append(i)
                self.hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens)))

    def sizes(self, width: int) -> np.ndarray:
        """How often ``width`` consecutive words begin in each document."""
        return np.array([len(h) - width + 1 for h in self.hashes], np.int64)

    def over_docs(self, width: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, document id) of every ``width`` consecutive words."""
        sizes = self.sizes(width)
        ends = np.cumsum(sizes)
        keys = np.empty(sizes.sum(), np.uint64)
        for h, n, end in zip(self.hashes, sizes, ends):
            keys[end - n : end] = rolling(h, width, base)
        return keys, np.repeat(self.ids[self.long], sizes)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, document id, whether it is an anchor) of every block."""
        keys, doc = self.over_docs(self.block, BASES[0])
        anchor = np.zeros(len(keys), bool)
        start = 0
        for n in self.sizes(self.block).tolist():
            anchor[start : start + n : self.block] = True
            start += n
        return keys, doc, anchor

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, document id) of every window."""
        return self.over_docs(self.window, BASES[1])


def words_of(docs: pa.ChunkedArray) -> Iterator[list[bytes]]:
    """The words of each document's text, one document in memory at a time."""
    return (words(text.as_py() or "") for c in docs.chunks for text in c.field("text"))


def least(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order with their smallest document, and whether another has them too."""
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    if not len(heads):
        return keys, docs, np.zeros(0, bool)
    low = np.minimum.reduceat(docs, heads)
    return keys[heads], low, np.maximum.reduceat(docs, heads) != low


def lookup(keys: np.ndarray, sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each key, NO_DOC where there is none."""
    if not len(sorted_keys):
        return np.full(len(keys), NO_DOC)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, values[at], NO_DOC)


def _ids(values: np.ndarray) -> bytes:
    """Non-negative or not, ids shrink to the bytes that their range needs, after a header."""
    base = int(values.min()) if len(values) else 0
    apart = (values - np.int64(base)).view(np.uint64)
    width = max(1, -(-int(apart.max()).bit_length() // 8)) if len(values) else 1
    return base.to_bytes(8, "little", signed=True) + bytes([width]) + plane_pack(apart, width)


def _read_ids(raw: bytes) -> np.ndarray:
    return plane_unpack(raw[9:], raw[8]).view(np.int64) + np.int64(int.from_bytes(raw[:8], "little", signed=True))


class Parts:
    """2^bits even parts of the range of a hash; keys inside a part keep ``width`` bytes."""

    def __init__(self, bits: int, width: int):
        self.bits, self.width = bits, width
        self.shift = np.uint64(max(0, 64 - bits - 8 * width))

    def split(self, keys: np.ndarray):
        """(part, slice, packed keys) for sorted keys."""
        edges = np.searchsorted(keys >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        for part in np.flatnonzero(np.diff(edges)):
            here = slice(edges[part], edges[part + 1])
            yield int(part), here, plane_pack(self.inside(keys[here]), self.width)

    def slices(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        """Where the keys of each slice of the range are; a part lies in one slice."""
        bits = min(SLICE_BITS, self.bits)
        top = (keys >> np.uint64(64 - bits)).astype(np.uint8)
        for number in range(1 << bits):
            yield np.flatnonzero(top == number)

    def inside(self, keys: np.ndarray) -> np.ndarray:
        return (keys << np.uint64(self.bits)) >> np.uint64(self.bits) >> self.shift

    def short(self, keys: np.ndarray) -> np.ndarray:
        """The key that survives packing."""
        return keys >> self.shift << self.shift

    def unpack(self, raw: bytes, part: int) -> np.ndarray:
        return (np.uint64(part) << np.uint64(64 - self.bits)) | (plane_unpack(raw, self.width) << self.shift)


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) if rows else schema.empty_table()


def _answers(table: pa.Table) -> list[dict]:
    return table.to_pylist()


def sizes(text_bytes: int, tasks: int, shard_bytes: int = SHARD_BYTES, part_hashes: int = PART_HASHES) -> tuple[int, int]:
    """How many shards, and by how many bits of the hash parts are told apart: both grow with the text."""
    parts = max(tasks, -(-text_bytes // (2 * part_hashes)))
    return max(-(-text_bytes // shard_bytes), tasks), max(1, (parts - 1).bit_length())


def in_shards(docs: DataFrame, shards: int) -> DataFrame:
    """(doc, shard). Rows of equal id and text go by their partition too, so that rows that repeat
    everywhere are not one shard."""
    key = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"), F.spark_partition_id())
    return docs.select(all_columns(docs).alias("doc"), F.pmod(key, F.lit(shards)).cast("int").alias("shard"))


def repeats(docs: DataFrame, window: int = 50, shard_bytes: int = SHARD_BYTES, part_hashes: int = PART_HASHES) -> DataFrame:
    """``docs`` with the result of removing repeated windows, as a struct column ``cut``:
    n_words, n_removed, kept (the kept words joined by one space) and spans (first word and word
    after the last of each maximal repeat that was removed).

    A word goes if a window that covers it also starts in a document of smaller doc_id, judged on the
    input. Null texts have no words. A null doc_id is larger than any other, and equal ids never
    remove each other. Window keys have 64 bits and more; block keys only choose candidates.
    """
    if window < 2 or window % 2:
        raise ValueError("the window must be an even number of words")
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards, bits = sizes(size, shuffle_tasks(spark), shard_bytes, part_hashes)
    parts, window_parts = Parts(bits, BLOCK_BYTES), Parts(bits, WINDOW_BYTES)
    dealt = in_shards(docs, shards)

    probe_schema = "part int, shard int, keys binary, several binary, anchors binary, anchor_docs binary"
    probe_out = arrow_schema(probe_schema)

    def probe(table: pa.Table) -> pa.Table:
        shard, number = Shard(table.column("doc"), window), table.column("shard")[0].as_py()
        keys, doc, anchor = shard.blocks()
        keys = parts.short(keys)
        rows = []
        for here in parts.slices(keys):
            own = here[anchor[here]]
            anchors = {p: (raw, low) for p, raw, low in _with(parts, *least(keys[own], doc[own])[:2])}
            distinct, _, several = least(keys[here], doc[here])
            for part, at, raw in parts.split(distinct):
                own, low = anchors.get(part, (b"", _ids(np.zeros(0, np.int64))))
                rows.append((part, number, raw, np.packbits(several[at]).tobytes(), own, low))
        return _table(probe_out, rows)

    answer_schema = "shard int, part int, keys binary, docs binary"
    answer_out = arrow_schema(answer_schema)

    def match(table: pa.Table) -> pa.Table:
        rows = _answers(table)
        part = rows[0]["part"]
        anchors, low, _ = least(
            np.concatenate([parts.unpack(r["anchors"], part) for r in rows]), np.concatenate([_read_ids(r["anchor_docs"]) for r in rows])
        )
        sent = []
        for r in rows:
            keys = parts.unpack(r["keys"], part)
            several = np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(keys)).astype(bool)
            at = np.minimum(np.searchsorted(anchors, keys), max(len(anchors) - 1, 0))
            is_anchor = anchors[at] == keys if len(anchors) else np.zeros(len(keys), bool)
            sent.append((r["shard"], keys[is_anchor], several[is_anchor], at[is_anchor]))
        count = np.zeros(len(anchors), np.int64)
        for _, _, several, at in sent:
            count[at] += 1 + several
        back = []
        for number, keys, _, at in sent:
            shared = count[at] > 1
            if shared.any():
                back.append((number, part, plane_pack(parts.inside(keys[shared]), parts.width), _ids(low[at[shared]])))
        return _table(answer_out, back)

    def gathered(table: pa.Table, which: Parts) -> tuple[np.ndarray, np.ndarray]:
        rows = _answers(table)
        keys = np.concatenate([np.zeros(0, np.uint64), *(which.unpack(r["keys"], r["part"]) for r in rows)])
        docs_of = np.concatenate([np.zeros(0, np.int64), *(_read_ids(r["docs"]) for r in rows)])
        order = np.argsort(keys, kind="stable")
        return keys[order], docs_of[order]

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not answers.num_rows or not table.num_rows:
            return answer_out.empty_table()
        shard, number = Shard(table.column("doc"), window), table.column("shard")[0].as_py()
        keys, doc, anchor = shard.blocks()
        hits = gathered(answers, parts)
        hit = np.zeros(len(keys), bool)
        for here in parts.slices(keys):
            found = lookup(parts.short(keys[here]), *hits)
            # a hit in this document, or one of its own anchors that another document hits
            hit[here] = (found < doc[here]) | ((found != NO_DOC) & anchor[here])
        del keys, doc, anchor, hits
        around = _near(hit, shard.sizes(shard.block), shard.window - shard.block)
        first, owner = (x[around] for x in shard.windows())
        rows = []
        for here in window_parts.slices(first):
            distinct, low, _ = least(first[here], owner[here])
            rows += [(number, part, raw, docs_of) for part, raw, docs_of in _with(window_parts, distinct, low)]
        return _table(answer_out, rows)

    def settle(table: pa.Table) -> pa.Table:
        rows = _answers(table)
        part = rows[0]["part"]
        sent = [(r["shard"], window_parts.unpack(r["keys"], part), _read_ids(r["docs"])) for r in rows]
        keys, low, several = least(np.concatenate([k for _, k, _ in sent]), np.concatenate([d for _, _, d in sent]))
        keys, low = keys[several], low[several]
        back = []
        for number, own, docs_of in sent:
            best = lookup(own, keys, low)
            smaller = best < docs_of
            if smaller.any():
                back.append((number, part, plane_pack(window_parts.inside(own[smaller]), window_parts.width), _ids(best[smaller])))
        return _table(answer_out, back)

    result = "n_words long, n_removed long, kept string, spans array<struct<first: int, after: int>>"
    final = T.StructType([dealt.schema["doc"], T.StructField("cut", T.StructType.fromDDL(result))])
    cut_type = arrow_schema(final).field("cut").type

    def marked(shard: Shard, answers: pa.Table) -> np.ndarray:
        """Whether each window of the shard also starts in a document of smaller id."""
        first, owner = shard.windows()
        others = gathered(answers, window_parts)
        again = np.zeros(len(first), bool)
        for here in window_parts.slices(first):
            keys, docs_of = first[here], owner[here]
            best = np.minimum(lookup(keys, *least(keys, docs_of)[:2]), lookup(window_parts.short(keys), *others))
            again[here] = best < docs_of
        return again

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"doc": table.column("doc"), "cut": pa.array([], cut_type)})
        shard = Shard(table.column("doc"), window)
        sizes_of = shard.sizes(window).tolist()
        again = marked(shard, answers)
        del shard.hashes
        spans: dict[int, np.ndarray] = {}
        start = 0
        for i, n in zip(shard.long, sizes_of):
            found = np.flatnonzero(again[start : start + n])
            start += n
            if len(found):
                gap = np.flatnonzero(np.diff(found) > window)
                spans[i] = np.c_[found[np.r_[0, gap + 1]], found[np.r_[gap, len(found) - 1]] + window]
        chunks, cuts, held = [], [], 0
        for i, tokens in enumerate(words_of(table.column("doc"))):
            gone = spans.get(i, np.zeros((0, 2), np.int64))
            kept, at = [], 0
            for a, b in gone.tolist():
                kept += tokens[at:a]
                at = b
            kept += tokens[at:]
            text = b" ".join(kept)
            cuts.append({
                "n_words": len(tokens), "n_removed": len(tokens) - len(kept), "kept": text.decode("utf-8", "surrogatepass"),
                "spans": [{"first": a, "after": b} for a, b in gone.tolist()],
            })
            held += len(text)
            if held > KEPT_BYTES:
                chunks.append(pa.array(cuts, cut_type))
                cuts, held = [], 0
        return pa.table({"doc": table.column("doc"), "cut": pa.chunked_array([*chunks, pa.array(cuts, cut_type)], cut_type)})

    by_shard = dealt.groupBy("shard")
    probes = by_shard.applyInArrow(probe, probe_schema)
    hits = probes.groupBy("part").applyInArrow(match, answer_schema)
    windows = by_shard.cogroup(hits.groupBy("shard")).applyInArrow(extend, answer_schema)
    settled = windows.groupBy("part").applyInArrow(settle, answer_schema)
    done = by_shard.cogroup(settled.groupBy("shard")).applyInArrow(remove, final)
    return done.select(*unpacked(docs), "cut")


def _with(parts: Parts, keys: np.ndarray, docs: np.ndarray):
    """(part, packed keys, packed documents) of sorted keys."""
    for part, here, raw in parts.split(keys):
        yield part, raw, _ids(docs[here])


def _near(hit: np.ndarray, sizes: np.ndarray, reach: int) -> np.ndarray:
    """For each window, whether one of the blocks inside it is a hit. Blocks are listed document by
    document; a document of n blocks has n - reach windows."""
    total = np.zeros(len(hit) + 1, np.int64)
    np.cumsum(hit, out=total[1:])
    near = [np.zeros(0, bool)]
    start = 0
    for n in sizes.tolist():
        near.append(total[start + reach + 1 : start + n + 1] > total[start : start + n - reach])
        start += n
    return np.concatenate(near)
