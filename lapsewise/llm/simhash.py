"""SimHash near-duplicates found through a Gray-order hierarchical index.

1. Every text gets a 64-bit fingerprint: the majority of the XXH64 bits of its word shingles.
2. Equal fingerprints are one code. Two codes at ``max_bits`` differing bits agree on at least one
   of ``max_bits + 1`` blocks of their bits, so codes are dealt by (block, bits of the block). A
   bucket with more than ``bucket_codes`` codes is dealt again by the blocks of its unused bits,
   as often as needed: by the same argument no pair is lost, and no task gets a hot bucket.
3. Inside a bucket the codes are sorted by Gray rank, so that neighbours share long bit patterns.
   Runs of ``FANOUT`` nodes get a parent holding the bits they all share (mask and value); a node
   keeps only what its parent does not hold. A search walks down from the top, adds up the
   differing bits, and prunes a whole group once the sum exceeds ``max_bits``.
4. A bucket gives its connected codes as links to the smallest code of each local group, never
   all pairs. Groups across buckets are joined by alternating star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import all_columns, arrow_schema, id_and_text, map_texts, shuffle_tasks, stored, unpacked, words
from lapsewise.llm.components import components

FANOUT = 8
#: Shingles hashed at a time, so that a very long text needs no more memory than this.
SHINGLES_AT_ONCE = 200_000
#: Node pairs looked at together by a search.
FRONTIER = 1_000_000


def fingerprint(text: str, shingle: int = 3) -> int:
    """0 for a text without words; one shingle of all words for a text of fewer than ``shingle``."""
    tokens = words(text, lower=True)
    if not tokens:
        return 0
    if len(tokens) < shingle:
        tokens, shingle = [b" ".join(tokens)], 1
    total, ones = len(tokens) - shingle + 1, np.zeros(64, np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        part = tokens[start : min(start + SHINGLES_AT_ONCE, total) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if shingle > 1 else part
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, len(part) - shingle + 1)
        ones += _ones(hashes)
    return int((np.uint64(1) << np.flatnonzero(2 * ones > total).astype(np.uint64)).sum(dtype=np.uint64))


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many values have each bit set, least significant bit first."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, code, text_hash): the fingerprint of every whole text as a signed 64-bit number, and
    the hash that Spark's xxhash64 gives of the text."""

    def make():
        def score(texts: list[str]) -> dict:
            whole = np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 42) for t in texts), np.uint64, len(texts))
            return {"code": np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64), "text_hash": whole.view(np.int64)}

        return score

    return map_texts(docs, make, "doc_id long, code long, text_hash long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence: the running XOR of its bits."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """The hierarchical index over the codes of many buckets at once.

    ``bucket`` and ``codes`` are sorted by bucket, then Gray rank. ``levels[0]`` are the codes; each
    further level groups FANOUT neighbours of one bucket. A level holds, per node, the bits shared by
    all below it but not yet held by its parent (``own``), their value, its first child and last code.
    """

    def __init__(self, bucket: np.ndarray, codes: np.ndarray):
        self.codes = codes
        n = len(codes)
        group, conj, disj = bucket, codes, codes
        first, last = np.arange(n), np.arange(n)
        self.levels = []
        while True:
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
            shared = conj | ~disj
            self.levels.append({"shared": shared, "value": conj, "child": first, "last": last})
            if len(starts) == len(group):
                break
            place = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
            heads = np.flatnonzero(place % FANOUT == 0)
            ends = np.r_[heads[1:], len(group)]
            conj, disj = np.bitwise_and.reduceat(conj, heads), np.bitwise_or.reduceat(disj, heads)
            first, last, group = heads, last[ends - 1], group[heads]
        for level, above in zip(self.levels, self.levels[1:]):
            width = np.diff(np.r_[above["child"], len(level["shared"])])
            level["own"] = level["shared"] & ~np.repeat(above["shared"], width)
            above["width"] = width
        self.levels[-1]["own"] = self.levels[-1]["shared"]
        self.top = group
        self.bucket = bucket

    def pairs(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i < j, of codes of one bucket with at most ``max_bits`` differing bits."""
        n = len(self.codes)
        root = np.searchsorted(self.top, self.bucket)
        size = np.diff(np.searchsorted(self.bucket, np.r_[self.top, np.iinfo(np.int64).max]))[root] if n else np.zeros(0)
        cuts = np.searchsorted(np.cumsum(size), np.arange(FRONTIER, size.sum() + FRONTIER, FRONTIER)) if n else []
        begin = 0
        for end in [*(int(c) + 1 for c in cuts), n]:
            end = min(end, n)
            if begin < end:
                yield self._search(np.arange(begin, end), root[begin:end], max_bits)
            begin = max(begin, end)

    def _search(self, query: np.ndarray, node: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        differing = np.zeros(len(query), np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            differing = differing + np.bitwise_count((self.codes[query] ^ level["value"][node]) & level["own"][node])
            keep = (differing <= max_bits) & (level["last"][node] > query)
            query, node, differing = query[keep], node[keep], differing[keep]
            if depth:
                width = level["width"][node]
                begin = np.repeat(np.cumsum(width) - width, width)
                node = np.repeat(level["child"][node], width) + np.arange(width.sum()) - begin
                query, differing = np.repeat(query, width), np.repeat(differing, width)
        return query, node


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index reachable from each of n indexes, by hooking and pointer jumping."""
    parent = np.arange(n)
    for left, right in pairs:
        while len(left):
            a, b = parent[left], parent[right]
            apart = a != b
            left, right = left[apart], right[apart]
            np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (jumped := parent[parent] != parent).any():
                parent[jumped] = parent[parent[jumped]]
    return parent


def _bucket_links(max_bits: int):
    schema = arrow_schema("u long, v long")

    def links(bucket: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((gray_rank(codes), bucket))
        bucket, codes = bucket[order], codes[order]
        root = _roots(len(codes), GrayIndex(bucket, codes).pairs(max_bits))
        moved = root != np.arange(len(codes))
        signed = codes.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[root[moved]])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by bucket: whole buckets are indexed, the last one waits for more
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)]
            held = [np.concatenate(x) for x in zip(held, new)]
            ready = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if ready >= 50_000:
                yield links(held[0][:ready], held[1][:ready])
                held = [x[ready:] for x in held]
        if len(held[0]):
            yield links(*held)

    return run


def _deal(rows: DataFrame, blocks: int) -> DataFrame:
    """(bucket, unused, code) keyed again by each of ``blocks`` runs of the unused bits."""
    schema = arrow_schema("bucket long, unused long, code long")
    mix, step = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, unused, code = (c.to_numpy().view(np.uint64) for c in batch.columns)
            for mask in np.unique(unused):
                here = unused == mask
                places = [b for b in range(64) if int(mask) >> b & 1]
                for k, run_of in enumerate(np.array_split(places, blocks)):
                    bits = np.uint64(sum(1 << int(b) for b in run_of))
                    key = (bucket[here] * step + np.uint64(k + 1)) * mix ^ (code[here] & bits)
                    key ^= key >> np.uint64(29)
                    key *= step
                    left = np.full(key.shape, mask & ~bits)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.view(np.int64)) for x in (key, left, code[here])], schema=schema
                    )

    return rows.mapInArrow(run, "bucket long, unused long, code long")


def code_links(codes: DataFrame, max_bits: int = 3, bucket_codes: int = 4096) -> DataFrame:
    """(u, v): links that connect every two codes at ``max_bits`` or fewer differing bits, through
    a smaller code of their bucket. ``codes`` holds distinct values of ``code``.

    Buckets are dealt until none is above ``bucket_codes``; masks of so few unused bits that all
    their codes fit end the dealing by themselves.
    """
    spark = codes.sparkSession
    level = stored(_deal(codes.select(F.lit(0).cast("long").alias("bucket"), F.lit(-1).cast("long").alias("unused"), "code"), max_bits + 1), "simhash-buckets")
    found: DataFrame | None = None
    while True:
        hot = level.groupBy("bucket").count().filter(F.col("count") > bucket_codes).select("bucket")
        n_hot = hot.count()
        calm = level.join(hot, "bucket", "left_anti") if n_hot else level
        spread = calm.select("bucket", "code").repartition(shuffle_tasks(spark), "bucket").sortWithinPartitions("bucket")
        links = spread.mapInArrow(_bucket_links(max_bits), "u long, v long")
        found = links if found is None else found.union(links)
        if not n_hot:
            return found.distinct()
        level = stored(_deal(level.join(hot, "bucket", "left_semi").select("bucket", "unused", "code"), max_bits + 1), "simhash-buckets")


def grouped_codes(prints: DataFrame, max_bits: int = 3, bucket_codes: int = 4096) -> DataFrame:
    """(code, component): each distinct code with the name of its component."""
    codes = prints.select("code").distinct()
    links = stored(code_links(codes, max_bits, bucket_codes), "simhash-links")
    group = components(links)
    return codes.join(group, codes.code == group.node, "left").select("code", F.coalesce("component", "code").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, bucket_codes: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Empty and null texts have fingerprint zero and link like any other. ``component_id`` is the
    smallest doc_id reachable; null ids take no part in the minimum. Repeated rows are returned
    as often as they occur. An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle), "simhash")
    smallest = prints.groupBy("code").agg(F.min("doc_id").alias("smallest"))
    grouped = grouped_codes(prints, max_bits, bucket_codes).join(smallest, "code")
    ids = grouped.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = grouped.join(ids, "component").select("code", "component_id")
    return prints.join(named, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, bucket_codes: int = 4096) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null ids last, and of equal
    ids that of the smallest text hash. Rows of equal id and text are one document and stay as one."""
    prints = stored(fingerprints(docs, shingle), "simhash")
    named = prints.groupBy("doc_id", "text_hash", "code").agg(F.count("*").alias("times"))
    named = named.join(grouped_codes(prints, max_bits, bucket_codes), "code")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    first = named.groupBy("component").agg(F.min(place).alias("first"))
    judged = named.join(first, "component").select(
        F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_text"), (place == F.col("first")).alias("leads"), "times"
    )
    # most documents lead alone: only the others need to be told
    told = judged.filter(~F.col("leads") | (F.col("times") > 1))
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(all_columns(docs).alias("doc"), F.col("doc_id").cast("long").alias("id"), text_hash.alias("text_hash"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_text"))
    rows = rows.join(told, same, "left").filter(F.coalesce("leads", F.lit(True)))
    alone = rows.filter(F.col("times").isNull()).select("doc")
    repeated = rows.filter(F.col("times").isNotNull()).groupBy("id", "text_hash").agg(F.first("doc").alias("doc"))
    return alone.unionByName(repeated.select("doc")).select(*unpacked(docs))


__all__ = ["fingerprint", "fingerprints", "gray_rank", "GrayIndex", "code_links", "near_duplicates", "keep_one", "id_and_text"]
