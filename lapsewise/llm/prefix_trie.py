"""The prefix trie of conversations, totalled by time-forward processing.

A node is a distinct sequence of first turns; its key is the exclusive or of one 128-bit hash a turn
(of depth, role and text), so keys come from running aggregates and no text is shuffled. Totals of
subtrees (children, leaves, saved code points) are messages to the parent: nodes are sorted in reverse
level order, and a priority queue that spills to disk keeps what was sent until the parent's turn.

Shards are cut so that none is large. A node is heavy if its members have more than ``shard_nodes``
turns at or below it; a subtree whose top is light but hangs from a heavy node is a shard. What the
shards' roots send to one heavy parent is added up before it is shuffled. The heavy nodes above are
cut into bands of ``band`` levels, each again a shard; the bands' roots form a small tree of their own
that is totalled last, after which the bands are read once more with the totals from below them.

Rows without a conv_id belong to no conversation and are left out; a null role or text is empty; null
turns come first; equal turns follow each other in the order of their roles, then of their hashes, so
repeated rows are turns of their own. Without conversations there is no node, not even a root.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.llm.common import arrow_schema, shuffle_tasks, stored

SHARD_NODES = 100_000
BAND = 1024
#: Pending messages that a queue holds in memory.
QUEUE_ITEMS = 500_000
#: Text of joined ids that one row carries at most, in characters.
BLOCK_CHARS = 1_000_000

KEY = ["depth", "hi", "lo"]


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns in slices of a global order, and what each conversation has before each slice.

    (conv_id, slice, at, hi, lo, n_chars) and (conv_id, slice, first, before, n_turns): a turn's number
    from 0 is ``before + at - first``. A conversation of any length is spread over slices.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.col("turn").cast("long")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.isNotNull().alias("has_turn"), F.coalesce(turn, F.lit(0)).alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("hi"), F.xxhash64(F.lit(2), role, text).alias("lo"), F.char_length(text).cast("long").alias("n_chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "has_turn", "turn", "role", "hi", "lo", "row"]
    laid = rows.repartitionByRange(shuffle_tasks(conversations.sparkSession), *order).sortWithinPartitions(*order)
    laid = stored(laid.select("conv_id", F.monotonically_increasing_id().alias("at"), "hi", "lo", "n_chars"), "turns")
    laid = laid.withColumn("slice", F.shiftright("at", 33))
    counts = laid.groupBy("conv_id", "slice").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    whole = Window.partitionBy("conv_id")
    before = F.sum("n").over(whole.orderBy("slice")) - F.col("n")
    return laid, counts.select("conv_id", "slice", "first", before.alias("before"), F.sum("n").over(whole).alias("n_turns"))


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, depth, hi, lo, n_chars): the conversations as they are; ``n`` is a conversation's length."""
    laid, offsets = numbered(conversations)
    depth = F.col("before") + F.col("at") - F.col("first") + 1
    return laid.join(offsets, ["conv_id", "slice"]).select("conv_id", F.col("n_turns").alias("n"), depth.alias("depth"), "hi", "lo", "n_chars")


def rebuilt_paths(conversations: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Paths of conversations that share beginnings, and (conv_id, n) of all of them.

    Conversation c begins with the first h turns of c - c % group and goes on with its own after its
    first h, where h = crc32(c) % most.
    """
    laid, offsets = numbered(conversations)
    number = F.col("before") + F.col("at") - F.col("first")
    leading = (
        laid.filter(F.col("conv_id") % group == 0)
        .join(offsets.filter(F.col("before") < most - 1), ["conv_id", "slice"])
        .filter(number < most - 1)
        .groupBy(F.col("conv_id").alias("lender"))
        .agg(F.array_sort(F.collect_list(F.struct(number.alias("number"), "hi", "lo", "n_chars"))).alias("leading"))
    )
    borrows = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    about = offsets.withColumns({"h": borrows, "lender": F.col("conv_id") - F.col("conv_id") % group}).join(leading, "lender", "left")
    lent = F.least(F.col("h"), F.coalesce(F.size("leading"), F.lit(0)))
    about = about.withColumn("lent", lent).withColumn("n", F.col("lent") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0)))
    once = about.filter(F.col("before") == 0)
    lent_turns = once.filter(F.col("lent") > 0).select("conv_id", "n", F.explode(F.slice("leading", F.lit(1), F.col("lent"))).alias("x"))
    borrowed = lent_turns.select("conv_id", "n", (F.col("x.number") + 1).alias("depth"), "x.hi", "x.lo", "x.n_chars")
    own = laid.join(about.drop("leading"), ["conv_id", "slice"]).filter(number >= F.col("h"))
    own = own.select("conv_id", "n", (F.col("lent") + number - F.col("h") + 1).alias("depth"), "hi", "lo", "n_chars")
    return borrowed.unionByName(own), once.select("conv_id", "n")


def prefixes(turns: DataFrame, band: int = BAND) -> DataFrame:
    """Turns (conv_id, n, depth, hi, lo, n_chars) with the key of the sequence that ends there in (hi, lo),
    that of the sequence before in (parent_hi, parent_lo), and the key at the top of the band of levels
    in (band_hi, band_lo). A long conversation is aggregated band by band."""
    turn = turns.select(
        "conv_id", "n", "depth", F.floor(F.col("depth") / band).alias("band"), "n_chars",
        F.xxhash64(F.lit(3), "depth", "hi", "lo").alias("hi"), F.xxhash64(F.lit(4), "depth", "hi", "lo").alias("lo"),
    )
    totals = turn.filter(F.col("n") >= band).groupBy("conv_id", "band").agg(F.bit_xor("hi").alias("hi"), F.bit_xor("lo").alias("lo"))
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "band", F.bit_xor("hi").over(earlier).alias("carried_hi"), F.bit_xor("lo").over(earlier).alias("carried_lo"))
    inside = Window.partitionBy("conv_id", "band").orderBy("depth")

    def key(half: str) -> Column:
        return F.bit_xor(half).over(inside).bitwiseXOR(F.coalesce(F.col(f"carried_{half}"), F.lit(0)))

    keyed = turn.join(carried, ["conv_id", "band"], "left").withColumns({"key_hi": key("hi"), "key_lo": key("lo")})

    def top(half: str) -> Column:
        return F.when(F.col("band") > 0, F.first(f"key_{half}").over(inside)).otherwise(F.lit(0)).alias(f"band_{half}")

    return keyed.select(
        "conv_id", "n", "depth", "band", F.col("key_hi").alias("hi"), F.col("key_lo").alias("lo"), "n_chars",
        F.col("key_hi").bitwiseXOR(F.col("hi")).alias("parent_hi"), F.col("key_lo").bitwiseXOR(F.col("lo")).alias("parent_lo"), top("hi"), top("lo"),
    )


class SpillingQueue:
    """Messages (key of three integers, three totals) in the order of their keys. More than ``limit`` of
    them go to a temporary file as one sorted run, which is read back as the keys come up."""

    RECORD = struct.Struct("<6q")

    def __init__(self, limit: int = QUEUE_ITEMS):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, message: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            file = tempfile.TemporaryFile()
            for kept in sorted(self.heap):
                file.write(self.RECORD.pack(*kept))
            file.seek(0)
            run = self._read(file)
            self.runs.append([next(run), self.spilled, run])
            heapq.heapify(self.runs)
            self.heap = []
            self.spilled += 1

    def _read(self, file) -> Iterator[tuple[int, ...]]:
        with file:
            while raw := file.read(self.RECORD.size * 4096):
                yield from self.RECORD.iter_unpack(raw)

    def take(self, key: tuple[int, int, int]) -> tuple[int, int, int]:
        """The sums of the messages for ``key``, which must not come after any that is still wanted."""
        children = leaves = saved = 0
        while self.heap and self.heap[0][:3] == key:
            _, _, _, c, l, s = heapq.heappop(self.heap)
            children, leaves, saved = children + c, leaves + l, saved + s
        while self.runs and self.runs[0][0][:3] == key:
            (_, _, _, c, l, s), _, run = self.runs[0]
            children, leaves, saved = children + c, leaves + l, saved + s
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                self.runs[0][0] = following
                heapq.heapify(self.runs)
        return children, leaves, saved


def time_forward(nodes: DataFrame, shard: list[str], tasks: int, limit: int = QUEUE_ITEMS) -> DataFrame:
    """``nodes`` with the totals of their subtrees inside their shards in place of n_children, n_leaves
    and saved, which hold each node's own figures on the way in. Nodes with ``is_top`` send nothing.

    Nodes of a shard meet in one task and come in reverse level order by an external sort; a task
    holds the messages on the way to the level above, beyond ``limit`` on disk.
    """
    laid = nodes.repartition(tasks, *shard).sortWithinPartitions(F.desc("depth"), "hi", "lo")
    out = arrow_schema(laid.schema)
    totals = ["n_children", "n_leaves", "saved"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in [*KEY, "parent_hi", "parent_lo", "is_top", *totals]}
            found = []
            for depth, hi, lo, up_hi, up_lo, is_top, *own in zip(*columns.values()):
                here = tuple(a + b for a, b in zip(own, queue.take((-depth, hi, lo))))
                found.append(here)
                if not is_top:
                    queue.push((1 - depth, up_hi, up_lo, 1, here[1], here[2]))
            sums = dict(zip(totals, zip(*found))) if found else {}
            arrays = [pa.array(sums[f.name], f.type) if f.name in sums else batch.column(f.name) for f in out]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return laid.mapInArrow(run, laid.schema)


def sent(tops: DataFrame) -> DataFrame:
    """What tops of shards send to their parents, added up per parent."""
    up = tops.select((F.col("depth") - 1).alias("depth"), F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo"), "n_leaves", "saved")
    return up.groupBy(*KEY).agg(F.count("*").alias("from_children"), F.sum("n_leaves").alias("from_leaves"), F.sum("saved").alias("from_saved"))


def received(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    plus = {"n_children": "from_children", "n_leaves": "from_leaves", "saved": "from_saved"}
    joined = nodes.join(messages, KEY, "left")
    return joined.withColumns({own: F.col(own) + F.coalesce(F.col(more), F.lit(0)) for own, more in plus.items()}).drop(*plus.values())


def end_digests(ends: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(depth, hi, lo, ends_sha256): the SHA-256 of each node's ascending ids, joined by commas.

    The ids are sorted globally. A node whose ids lie inside one slice is hashed there; the others
    leave as blocks of joined text, which one task hashes one after the other.
    """
    order = [*KEY, "conv_id"]
    tasks = shuffle_tasks(ends.sparkSession)
    laid = ends.select(*order).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    schema = "depth long, hi long, lo long, conv_id long, block string, ends_sha256 string"
    out = arrow_schema(schema)

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        key, first, ids, chars, in_blocks = None, None, [], 0, True

        def close(as_block: bool) -> None:
            text = ",".join(ids)
            rows.append((*key, first, text, None) if as_block else (*key, first, None, hashlib.sha256(text.encode()).hexdigest()))

        def made() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)
            rows.clear()
            return batch

        for batch in batches:
            for *here, conv_id in zip(*(batch.column(c).to_pylist() for c in order)):
                if here != key:
                    if key is not None:
                        close(in_blocks)
                    in_blocks = key is None  # the first run of a slice may have begun in the one before
                    key, first, ids, chars = here, conv_id, [], 0
                elif chars > block_chars:
                    close(True)
                    first, ids, chars, in_blocks = conv_id, [], 0, True
                    yield made()
                ids.append(str(conv_id))
                chars += len(ids[-1]) + 1
                if len(rows) >= 1000:
                    yield made()
        if key is not None:
            close(True)  # and the last may go on in the next
            yield made()

    # read twice below
    joined = stored(laid.mapInArrow(join_ids, schema), "ends")
    blocks = joined.filter(F.col("block").isNotNull()).repartition(tasks, *KEY).sortWithinPartitions(*order).select(*KEY, "block")
    result = "depth long, hi long, lo long, ends_sha256 string"
    final = arrow_schema(result)

    def hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            rows = []
            for *here, block in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if here != key:
                    if key is not None:
                        rows.append((*key, state.hexdigest()))
                    key, state = here, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(block.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), final)], schema=final)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*key, state.hexdigest()), final)], schema=final)

    whole = joined.filter(F.col("block").isNull()).select(*KEY, "ends_sha256")
    return whole.unionByName(blocks.mapInArrow(hash_blocks, result))


def trie(turns: DataFrame, lengths: DataFrame, shard_nodes: int = SHARD_NODES, band: int = BAND, queue_items: int = QUEUE_ITEMS) -> DataFrame:
    """The nodes of the trie of ``turns`` (see ``paths``) of the conversations ``lengths`` (conv_id, n).

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and the node's key hi, lo.
    """
    spark = turns.sparkSession
    tasks = shuffle_tasks(spark)
    zero = F.lit(0).cast("long")
    rows = prefixes(turns, band)
    root = {c: zero for c in rows.columns if c not in ("conv_id", "n")}
    rows = stored(rows.unionByName(lengths.select("conv_id", "n", *[v.alias(c) for c, v in root.items()])), "prefixes")
    same = ["band", "n_chars", "parent_hi", "parent_lo", "band_hi", "band_lo"]
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("n") == F.col("depth")).alias("n_ends"),
        F.sum(F.col("n") - F.col("depth") + 1).alias("weight"), *[F.max(c).alias(c) for c in same],
    )
    nodes = stored(
        nodes.select(
            *KEY, "parent_hi", "parent_lo", "conv_id", "n_convs", (F.col("weight") > shard_nodes).alias("is_heavy"), "band", "band_hi", "band_lo",
            zero.alias("n_children"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"),
        ),
        "nodes",
    )
    heavy = nodes.filter("is_heavy")

    # where each conversation leaves the heavy nodes: the root of its light shard
    marked = rows.select("conv_id", *KEY).join(heavy.select(*KEY, "is_heavy"), KEY, "left").filter(F.col("is_heavy").isNull())
    tops = marked.groupBy("conv_id").agg(F.min(F.struct(*KEY)).alias("top")).select("conv_id", F.col("top.hi").alias("top_hi"), F.col("top.lo").alias("top_lo"))
    light = nodes.filter(~F.col("is_heavy")).join(tops, "conv_id")
    light = light.withColumn("is_top", (F.col("hi") == F.col("top_hi")) & (F.col("lo") == F.col("top_lo")))
    light = stored(time_forward(light, ["top_hi", "top_lo"], tasks, queue_items), "shards")

    heavy = heavy.withColumn("is_top", F.col("depth") == F.col("band") * band)
    heavy = received(heavy, sent(light.filter("is_top")))
    deepest = nodes.filter("is_heavy").agg(F.max("band")).first()[0] or 0
    bands = ["band", "band_hi", "band_lo"]
    if deepest:
        heavy = stored(heavy, "bands")
        roots = stored(time_forward(heavy, bands, tasks, queue_items).filter("is_top"), "roots")
        above = roots.join(
            heavy.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("band_hi").alias("up_hi"), F.col("band_lo").alias("up_lo")),
            ["depth", "parent_hi", "parent_lo"],
            "left",
        )
        # the tree of the bands' roots: its levels are the bands
        small = above.select(
            F.col("band").alias("depth"), "hi", "lo", F.col("up_hi").alias("parent_hi"), F.col("up_lo").alias("parent_lo"), (F.col("band") == 0).alias("is_top"),
            zero.alias("n_children"), "n_leaves", "saved", F.col("depth").alias("level"), F.col("parent_hi").alias("node_hi"), F.col("parent_lo").alias("node_lo"),
        )
        whole = time_forward(small, [], 1, queue_items).filter(F.col("depth") > 0)
        whole = whole.select(F.col("level").alias("depth"), F.col("node_hi").alias("parent_hi"), F.col("node_lo").alias("parent_lo"), "n_leaves", "saved")
        heavy = received(heavy, sent(whole))
    heavy = time_forward(heavy, bands, tasks, queue_items)

    columns = [*KEY, "parent_hi", "parent_lo", "conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    done = light.select(*columns).unionByName(heavy.select(*columns))
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("parent_conv_id"))
    digests = end_digests(rows.filter(F.col("depth") == F.col("n")))
    placed = done.join(up, ["depth", "parent_hi", "parent_lo"], "left").join(digests, KEY, "left")
    none = hashlib.sha256(b"").hexdigest()
    return placed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "hi", "lo",
    )


def prefix_trie(conversations: DataFrame, **sizes: int) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = paths(conversations)
    return trie(turns, turns.filter(F.col("depth") == 1).select("conv_id", "n"), **sizes)
