"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents are tokenised and cut: whole windows first, which are full by themselves, and the rest in
pieces of at most ``piece`` tokens. The pieces are dealt by a hash into groups of about
``group_windows`` windows. In a group every piece starts as a partial partition (one window with the
piece, the others empty); the two partial partitions of widest spread are merged with opposing
imbalances, the fullest window of one with the emptiest of the other, until one is left. Windows come
out near-equal; if the fullest exceeds the capacity, the number of windows rises by one.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lapsewise.llm.common import arrow_schema, blocks, id_and_text, released, shuffle_tasks, stored
from lapsewise.llm.units import UnitEncoder

WINDOW = 1024
PIECE = 256
GROUP_WINDOWS = 256
#: Sequence ids are group << GROUP_SHIFT | place in the group.
GROUP_SHIFT = 32


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if it is printable Latin-1,
    else the next one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + n): b for n, b in enumerate(others)}


def merge_ranks(vocabulary: str) -> dict[bytes, int] | None:
    """The ranks of a byte-level vocabulary whose merges come in the order of its ids, so that merging
    by rank is merging in that order; None for any other vocabulary."""
    model = json.loads(vocabulary)["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    letters, ids = byte_letters(), model["vocab"]
    made = [ids.get(a + b) for a, b in merges]
    single = {ids.get(letter) for letter in letters}
    if None in made or made != sorted(set(made)) or None in single or max(single) >= made[0]:
        return None
    names = [*letters, *(a + b for a, b in merges)]
    return {bytes(letters[c] for c in name): ids[name] for name in names}


class Encoder:
    """Ids as ``tokenizers`` gives them without added special tokens.

    Units that hold no special string are merged by rank, which is the same (see ``merge_ranks``) and
    far quicker for short strings; texts that hold one, and other vocabularies, go to the library.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_str(vocabulary)
        self.special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.library = UnitEncoder(lambda text: tokenizer.encode(text, add_special_tokens=False).ids)
        ranks = merge_ranks(vocabulary)
        self.units = self.library
        if ranks is not None:
            self.units = UnitEncoder(tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary)

    def ids(self, text: str, size: int = 1_000_000) -> bytes:
        if any(token in text for token in self.special):
            return self.library.pack(text)
        return self.units.ids(text, size)


@lru_cache(2)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def cut(n_tokens: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full windows, then pieces of the rest."""
    full = n_tokens - n_tokens % window
    starts = [*range(0, full, window), *range(full, n_tokens, piece)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_tokens])]


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """The indexes of ``sizes`` in ``windows`` groups of near-equal sums.

    A partial partition is its non-empty windows alone, in ascending order of their sums, so it holds
    no more than its pieces, however many windows there are. Its spread is what the fullest has above
    the emptiest. Two are merged by putting the fullest of what does not fit beside the other's into
    its emptiest.
    """
    left: list[int] = []
    right: list[int] = []

    def joined(a: int, b: int) -> int:
        left.append(a)
        right.append(b)
        return len(sizes) + len(left) - 1

    heap = [(-size, place, [size], [i]) for place, (size, i) in enumerate(sorted(((s, i) for i, s in enumerate(sizes)), key=lambda x: (-x[0], x[1])))]
    order = len(heap)
    while len(heap) > 1:
        _, _, sums, parts = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        if len(other) > len(sums):
            sums, parts, other, others = other, others, sums, parts
        meet = max(0, len(sums) + len(other) - windows)
        for k in range(meet):  # the emptiest here with the fullest of those that must share
            opposite = meet - 1 - k
            others[opposite] = joined(parts[k], others[opposite])
            other[opposite] += sums[k]
        sums, parts = sums[meet:], parts[meet:]
        if len(other) <= 8:
            for value, part in zip(other, others):
                at = bisect_right(sums, value)
                sums.insert(at, value)
                parts.insert(at, part)
        else:
            both = sorted(zip(sums + other, parts + others), key=itemgetter(0))
            sums, parts = [x[0] for x in both], [x[1] for x in both]
        spread = sums[-1] - (sums[0] if len(sums) == windows else 0)
        heapq.heappush(heap, (-spread, order, sums, parts))
        order += 1
    groups = []
    for part in heap[0][3] if heap else []:
        group, stack = [], [part]
        while stack:
            node = stack.pop()
            if node < len(sizes):
                group.append(node)
            else:
                stack += [right[node - len(sizes)], left[node - len(sizes)]]
        groups.append(group)
    return groups


def pack(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Groups of indexes with sums of at most ``window``, by differencing; every size must fit."""
    windows = -(-sum(sizes) // window)
    while True:
        groups = differencing(sizes, windows)
        if max((sum(sizes[i] for i in g) for g in groups), default=0) <= window:
            return [g for g in groups if g]
        windows += 1


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, piece: int = PIECE, end_id: int = 0) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the cut documents, each ended by ``end_id``.

    ``tokenizer`` is the path of a vocabulary file of fixed size, sent by the driver. A null text is
    an empty one and becomes one piece that holds the end alone.
    """
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    out = arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        for batch in batches:
            for ids, texts in blocks(batch):
                row, starts, lengths, sums, totals = [], [], [], [], []
                for i, text in enumerate(texts):
                    tokens = memoryview(encoder.ids(text) + end)
                    total = len(tokens) // 4
                    for start, length in cut(total, window, piece):
                        row.append(i)
                        starts.append(start)
                        lengths.append(length)
                        sums.append(zlib.crc32(tokens[4 * start : 4 * (start + length)]))
                        totals.append(total)
                columns = [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row, pa.int64())), *columns], schema=out)

    return id_and_text(docs).mapInArrow(released(run), schema)


def packed(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, piece: int = PIECE, group_windows: int = GROUP_WINDOWS
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset`` in it.

    Repeated rows are packed as often as they occur; an empty table gives no pieces. Pieces are
    numbered as they are stored, so groups are even however many of them are equal, and follow from
    what is stored, so a lost task gives the same sequences again.
    """
    cuts = stored(pieces(docs, tokenizer, window, piece).withColumn("row", F.monotonically_increasing_id()), "pieces")
    tokens = cuts.filter(F.col("length") < window).agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // (window * group_windows)))
    key = F.pmod(F.xxhash64("row"), F.lit(groups))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    out = arrow_schema(schema)

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        lengths = table.column("length").to_numpy()
        small = np.flatnonzero(lengths < window)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        windows = pack(lengths[small].tolist(), window)
        for number, members in enumerate(windows):
            here = small[np.sort(members)]
            sequence[here] = number
            offset[here] = np.cumsum(lengths[here]) - lengths[here]
        full = np.flatnonzero(lengths >= window)
        sequence[full] = len(windows) + np.arange(len(full))
        sequence += table.column("group")[0].as_py() << GROUP_SHIFT
        columns = [table.column(f.name).combine_chunks() for f in list(out)[:-2]]
        return pa.Table.from_arrays([*columns, pa.array(sequence), pa.array(offset)], schema=out)

    # a task packs one group after another, so it is no larger with many of them; each task writes a file
    dealt = cuts.withColumn("group", key).repartition(min(groups, shuffle_tasks(docs.sparkSession)), "group")
    return dealt.groupBy("group").applyInArrow(place, schema)
