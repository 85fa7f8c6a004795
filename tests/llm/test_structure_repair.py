import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from lapsewise.llm import structure_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, audit string"
WANTED = re.compile(r"(s?(ua)+)?\Z")


def plain_damage(rows):
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            yield conv_id, None
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range(2 if kind == 3 else 1):
            yield conv_id, (turn, "user" if kind == 4 else role, text)


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.strip(R.SPACES)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def all_edits(rows, faults):
    """Every sensible edit string with its cost and what remains: at most three inserts in a row."""
    found = [(0, "", "", ())]  # cost, audit, initials, repaired
    inserted = [("", ())] + [(a, tuple(f"{r}:" for r in names)) for k in (1, 2, 3) for names in itertools.product(("user", "assistant"), repeat=k) for a in ["".join(n[0] for n in names)]]

    def with_inserts(x):
        cost, audit, initials, kept = x
        for more, texts in inserted:
            yield cost + 3 * len(more), audit + "I" * len(more), initials + more, kept + texts

    for (_, role, text), fault in zip(rows, faults):
        following = []
        for cost, audit, initials, kept in itertools.chain.from_iterable(map(with_inserts, found)):
            following.append((cost + 4, audit + "D", initials, kept))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            following.append((cost + more, audit + "K", initials + (role[:1] or "?"), kept + (f"{role}:{text}",)))
            for to in ("user", "assistant"):
                following.append((cost + 3 + more, audit + "R", initials + to[0], kept + (f"{to}:{text}",)))
        # what cannot become a valid order any more, or is dearer than another way to the same initials, goes
        best = {}
        for x in following:
            if re.match(r"(s?(ua)*u?)?\Z", x[2]):
                end = (x[2][-1:], x[2] == "")
                if end not in best or x[:2] < best[end][:2]:
                    best[end] = x
        found = list(best.values())
    return min((x for y in found for x in with_inserts(y) if WANTED.match(x[2])), key=lambda x: x[:2])


def plain(rows):
    kept = defaultdict(list)
    for conv_id, row in plain_damage(rows):
        kept[conv_id] += [row] if row else []
    out = []
    for conv_id, here in kept.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        faults = faults_of(here)
        turns = {t for t, _, _ in here if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(here, here[1:]))
        cost, audit, _, repaired = all_edits(here, faults)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, number=60):
    rng, rows = random.Random(seed), []
    for c in range(number):
        for t in rng.sample(range(14), rng.randrange(0, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "no", " \t", None, "What?", "é!\n", f"own {t}.", "dots... ", "x" * 300])
            rows.append((c, t, role, text))
    rows += [(None, 0, "user", "whose?"), (None, 1, "assistant", "Nobody's."), (900, None, "user", "When?"), (900, 5, "assistant", "Now.")]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(4)


def results(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("seed, pointers, spool", [(1, 1 << 20, 8 << 20), (2, 2, 10)])
def test_against_all_edit_strings(spark, seed, pointers, spool):
    rows = conversations(seed)
    assert results(R.summaries(R.damaged(table(spark, rows)), pointers, spool)) == plain(rows)


def test_the_damage(spark):
    rows = conversations(3)
    got = [(r["conv_id"], None if r["gone"] else (r["turn"], r["role"], r["text"])) for r in R.damaged(table(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(plain_damage(rows), key=repr)
    assert any(row is None for _, row in got)


def test_search_over_unpruned_edits():
    """The dynamic program against every edit string of up to three rows, without any pruning."""
    rng = random.Random(5)
    for _ in range(300):
        rows = [(t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", "c."])) for t in range(rng.randrange(0, 4))]
        faults = faults_of(rows)
        conversation, seen = R.Conversation(), set()
        for turn, role, text in rows:
            fault = R.BLANK if not text else R.CUT if text[-1] != "." else R.NONE
            conversation.add(turn, role, text, fault, (role, text) in seen)
            seen.add((role, text))
        cost, audit, kept = conversation.repaired()
        options = []
        for edits in itertools.product("DKR", repeat=len(rows)):
            for inserts in itertools.product(range(3), repeat=len(rows) + 1):
                audit_, cost_, parts = "I" * inserts[0], 3 * sum(inserts), [None] * inserts[0]
                for edit, (_, role, _text), fault, after in zip(edits, rows, faults, inserts[1:]):
                    cost_ += {"D": 4, "K": 0, "R": 3}[edit] + (3 if fault == "truncated" and edit != "D" else 0)
                    if edit != "D" and fault in ("blank", "duplicate"):
                        cost_ += 1000
                    parts += [] if edit == "D" else [role[0]] if edit == "K" else [None]
                    parts += [None] * after
                    audit_ += edit + "I" * after
                orders = ["", *["ua" * k for k in range(1, 7)], *["s" + "ua" * k for k in range(1, 7)]]
                if any(len(o) == len(parts) and all(p in (None, x) and (p == x or x != "s") for p, x in zip(parts, o)) for o in orders):
                    options.append((cost_, audit_))
        assert (cost, audit) == min(options)
        assert WANTED.match("".join(r[:1] for r, _ in kept))


def test_rows_seen_earlier_in_one_conversation(spark):
    """A third of all rows are one text in one conversation; repeated rows are duplicates too."""
    rows = [(1, t, "user", "ok.") for t in range(300)] + [(2, 1, "assistant", "Fine.")] * 20 + [(c, 0, "user", "Hm?") for c in range(3, 300)]
    plainly = {r[0]: r for r in plain(rows)}
    got = {r[0]: r for r in results(R.summaries(R.damaged(table(spark, rows)), 16, 50))}
    assert got == plainly and got[1][3] > 200


def test_repaired_turns(spark):
    rows = conversations(6)
    digests = {r[0]: r[8] for r in plain(rows)}
    parts = defaultdict(list)
    for r in R.repaired_turns(R.damaged(table(spark, rows))).collect():
        parts[r["conv_id"]].append((r["place"], f"{r['role']}:{r['text']}"))
    assert {c: hashlib.sha256("\n".join(t for _, t in sorted(parts[c])).encode()).hexdigest() for c in digests} == digests


def test_empty_table(spark):
    assert R.summaries(R.damaged(table(spark, []))).count() == 0
