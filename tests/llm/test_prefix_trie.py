import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lapsewise.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, n int, depth string"


def plain_turns(rows):
    """Turns of each conversation in order; equal turns must not differ here."""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            found[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in found.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        lender = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(lender, [])[:h] + turns[h:]
    return out


def plain_trie(paths):
    members = defaultdict(list)
    for c, turns in sorted(paths.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, here in members.items():
        below = [x for x in members if x[: len(node)] == node]
        inner = {x[:-1] for x in members if x}
        ends = [c for c in here if len(paths[c]) == len(node)]
        out.append((
            min(here), len(node), min(members[node[:-1]]) if node else None, len(here), sum(x[:-1] == node for x in members if x),
            sum(x not in inner for x in below), sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(5)


def nodes_of(frame):
    return sorted((tuple(r) for r in frame.drop("hi", "lo").collect()), key=repr)


def conversations(seed, groups=3, each=25):
    rng = random.Random(seed)
    rows = []
    for c in [g * 100 + i for g in range(groups) for i in range(each)] + [-5, -100, -150, 1 << 40]:
        turns = rng.randrange(0, 9)
        rows += [(c, t, ("user", "assistant")[t % 2], rng.choice(["ok", "yes é", "", "a longer text", f"own {c} {t}"])) for t in range(turns)]
    rows += [(7, None, "system", "first of all"), (8, 3, None, None), (None, 0, "user", "nobody's"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("shard_nodes, band, queue_items", [(100_000, 1024, 1000), (10, 1024, 5), (0, 2, 3), (20, 3, 2), (1_000_000, 2, 1)])
def test_whole_trie(spark, shard_nodes, band, queue_items):
    rows = conversations(1)
    turns, lengths = T.rebuilt_paths(table(spark, rows))
    got = nodes_of(T.trie(turns, lengths, shard_nodes, band, queue_items))
    assert got == plain_trie(plain_rebuilt(plain_turns(rows)))


def test_conversations_as_they_are(spark):
    rows = [r for r in conversations(2, groups=1)]
    assert nodes_of(T.prefix_trie(table(spark, rows), shard_nodes=15)) == plain_trie(plain_turns(rows))


def test_one_long_conversation_and_many_copies(spark):
    """A third of the rows in one conversation, a third in copies of another."""
    rows = [(1, t, "user", f"turn {t % 7}") for t in range(400)]
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(130) for t in range(3)]
    rows += [(5000 + c, 0, "user", f"other {c}") for c in range(200)]
    random.Random(1).shuffle(rows)
    paths = plain_turns(rows)
    got = nodes_of(T.prefix_trie(table(spark, rows), shard_nodes=30, band=16, queue_items=4))
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    assert len(got) == len(members)
    by_place = {(r[0], r[1]): r for r in got}
    assert by_place[1, 0][3:6] == (331, 202, 202)
    assert by_place[1, 1][4:6] == (1, 1) and by_place[1, 400][4:6] == (0, 1)
    assert by_place[1000, 3][3] == 130
    assert by_place[1000, 3][7] == hashlib.sha256(",".join(str(1000 + c) for c in range(130)).encode()).hexdigest()
    assert by_place[1000, 1][6] == 129 * 3 * len("same 0") and by_place[1, 0][6] == by_place[1000, 1][6]


def test_repeated_rows_are_turns(spark):
    rows = [(1, 0, "user", "a")] * 3 + [(2, 0, "user", "a")]
    assert nodes_of(T.prefix_trie(table(spark, rows))) == plain_trie(plain_turns(rows))


def test_blocks_of_ids_are_hashed_in_order(spark):
    ends = spark.range(2000).selectExpr("1L depth", "id % 2 hi", "0L lo", "id * 7 conv_id").repartition(6)
    for chars in (10, 100_000):
        got = {r["hi"]: r["ends_sha256"] for r in T.end_digests(ends, chars).collect()}
        for hi in (0, 1):
            assert got[hi] == hashlib.sha256(",".join(str(i * 7) for i in range(2000) if i % 2 == hi).encode()).hexdigest()


def test_a_spilling_queue_returns_every_message():
    rng = random.Random(4)
    for limit in (1, 7, 10_000):
        queue, wanted = T.SpillingQueue(limit), defaultdict(lambda: [0, 0, 0])
        for _ in range(2000):
            key, values = (-rng.randrange(5), rng.randrange(-9, 9), rng.randrange(3)), [rng.randrange(9) for _ in range(3)]
            queue.push((*key, *values))
            wanted[key] = [a + b for a, b in zip(wanted[key], values)]
        assert bool(queue.spilled) == (limit < 2000)
        for key in sorted(wanted):
            assert queue.take(key) == tuple(wanted[key])
        assert not queue.heap and not queue.runs


def test_empty_table(spark):
    turns, lengths = T.rebuilt_paths(table(spark, []))
    assert T.trie(turns, lengths).count() == 0
