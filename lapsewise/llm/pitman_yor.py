r"""Language-model scores from a hierarchical Pitman-Yor process.

Tokens are the words ``[^\x20\x09-\x0D]+`` of a text with A-Z lower-cased, then one end. Each token is
seated in the restaurant of its context, one of ``CONTEXTS`` hash classes of the token before it (the end,
at the start of a text). All context restaurants share one parent, the unigram restaurant, whose base is
uniform over the known tokens and one place for all others. Every table of a context restaurant is a
customer of the parent.

Seatings are sampled by Gibbs: a customer is taken from its table and seated again, at an old table in
proportion to its size less the discount, at a new one in proportion to the parent's probability.
After ``BURN_IN`` sweeps ``SAMPLES`` seatings are kept, and the predictive probability of a token is the
mean over them, so scores sum logarithms of averaged probabilities.

How it is spread: a token occurrence goes to the part that owns its word. Classes of words, a fixed
number, are counted first; parts get classes of even weight, and a class that is too heavy for a part is
split by context over several. A part samples the seating of all its (context, word) pairs. What the
predictive formula needs from elsewhere has a fixed size: tables per context and sample, and a few totals. Words of
split classes get their parent counts through an aggregation by word. Tokens travel as packed runs, one
row a task and part, and come back as sums per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import arrow_schema, blocks, stored, words

#: Context classes, also the classes by which words are dealt; and how many share a row of sums.
CONTEXTS, CHUNK = 1 << 16, 1 << 12
#: Discount and strength of the context restaurants and of their parent.
LEAF_DISCOUNT, LEAF_STRENGTH = 0.8, 20.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.7, 100.0
BURN_IN, SAMPLES = 2, 2
#: Tokens in one part, and tokens packed together by a task.
PART_TOKENS, BLOCK_TOKENS = 1_000_000, 2_000_000
#: Customers of one dish are seated again in at most so many turns a sweep.
TURNS = 64
SEED = 20_011
END = xxhash.xxh64_intdigest(b"", seed=SEED)


def hashes(text: str) -> np.ndarray:
    """The 64-bit hashes of the tokens of a text, the end included."""
    tokens = words(text, lower=True)
    tokens.append(b"")  # no word is empty, so this is the end
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens, repeat(SEED)), np.uint64, len(tokens))


def word_class(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> np.uint64(48)).astype(np.uint16)


class Seating:
    """Customers of many dishes at tables; a table serves one dish, so dishes only meet in totals.

    ``counts`` are customers per dish, at least one each. Dishes of one customer never change.
    """

    def __init__(self, counts: np.ndarray, discount: float, rng: np.random.Generator):
        self.discount, self.rng = discount, rng
        self.tables = np.ones(len(counts), np.int64)
        self.busy = np.flatnonzero(counts > 1)
        self.size = counts[self.busy].astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        total = int(self.size.sum())
        self.dish = np.repeat(np.arange(len(self.busy)), self.size)
        place = np.arange(total) - self.start[self.dish]
        self.table = self.start[self.dish]  # the first table of the dish; ids below start + size
        self.filled = np.zeros(total, np.int64)
        self.filled[self.start] = self.size
        self.count = np.ones(len(self.busy), np.int64)
        self.gone = np.zeros(total, bool)
        turn = (place % TURNS).astype(np.uint8)
        order = np.argsort(turn, kind="stable")
        self.turns = np.split(order, np.cumsum(np.bincount(turn, minlength=1))[:-1]) if total else []

    def sweep(self, new_weight: np.ndarray) -> np.ndarray:
        """Seats every customer again; ``new_weight`` is, per dish, what a new table weighs. Returns
        tables per dish."""
        weight, d, rng = new_weight[self.busy], self.discount, self.rng
        for who in self.turns:
            dish = self.dish[who]
            if len(who) > 1 and (dish[1:] == dish[:-1]).any():
                leaving = np.bincount(dish, minlength=len(self.busy))
                np.subtract.at(self.filled, self.table[who], 1)
            else:
                leaving = None
                self.filled[self.table[who]] -= 1
            emptied = self.table[who][self.filled[self.table[who]] == 0]
            np.subtract.at(self.count, self.dish[np.unique(emptied)], 1)
            self.gone[who] = True
            staying = self.size[dish] - (1 if leaving is None else leaving[dish]) - d * self.count[dish]
            opens = rng.random(len(who)) * (weight[dish] + staying) < weight[dish]
            # old tables: follow a random seated customer of the dish, kept with chance (size - d) / size
            asking = who[~opens]
            while len(asking):
                dishes = self.dish[asking]
                other = self.start[dishes] + (rng.random(len(asking)) * self.size[dishes]).astype(np.int64)
                table = self.table[other]
                filled = self.filled[table]
                good = ~self.gone[other] & (rng.random(len(asking)) * filled < filled - d)
                self.table[asking[good]] = -1 - table[good]  # joins after all of this turn have chosen
                asking = asking[~good]
            joined = who[self.table[who] < 0]
            self.table[joined] = -1 - self.table[joined]
            np.add.at(self.filled, self.table[joined], 1)
            opening = who[opens]
            if len(opening):
                self._open(opening)
            self.gone[who] = False
        self.tables[self.busy] = self.count
        return self.tables

    def _open(self, opening: np.ndarray) -> None:
        """A free table for each customer. A dish has as many table ids as customers, so one is free;
        the customer's own place is tried first, then the next free ones of the dish."""
        own = self.filled[opening] == 0
        self.table[opening[own]] = opening[own]
        self.filled[opening[own]] = 1
        for who in opening[~own].tolist():
            dish = self.dish[who]
            begin, size = self.start[dish], self.size[dish]
            at = begin + int(np.argmin(self.filled[begin : begin + size] > 0))
            self.table[who], self.filled[at] = at, 1
        np.add.at(self.count, self.dish[opening], 1)


def deal(class_tokens: np.ndarray, part_tokens: int = PART_TOKENS) -> tuple[np.ndarray, np.ndarray, int]:
    """(first part, parts) of each word class, and the number of parts. Light classes share parts of
    even weight; a class above half a part has parts of its own and is split over them by context."""
    heavy = class_tokens > part_tokens // 2
    light = np.where(heavy, 0, class_tokens)
    first = ((np.cumsum(light) - light) // part_tokens).astype(np.int64)
    parts = np.ones(len(class_tokens), np.int64)
    parts[heavy] = -(-class_tokens[heavy] // (part_tokens // 2))
    used = int(first.max()) + 1
    first[heavy] = used + np.cumsum(parts[heavy]) - parts[heavy]
    return first, parts, used + int(parts[heavy].sum())


def _sums(rows: DataFrame, keys: list[str]) -> dict[tuple, np.ndarray]:
    """The element-wise sum of ``payload`` (packed 64-bit numbers) by ``keys``, which are few."""
    types = dict(rows.dtypes)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "payload binary"])
    out = arrow_schema(schema)

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, "<i8") for x in table.column("payload").to_pylist()], axis=0)
        return pa.table([*(table.column(k)[:1].cast(out.field(k).type) for k in keys), pa.array([total.astype("<i8").tobytes()], pa.binary())], schema=out)

    return {tuple(r[k] for k in keys): np.frombuffer(r["payload"], "<i8") for r in rows.groupBy(*keys).applyInArrow(add, schema).collect()}


def _chunks(values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for chunk in range(0, len(values), CHUNK):
        part = values[chunk : chunk + CHUNK]
        if part.any():
            yield chunk // CHUNK, part.astype("<i8").tobytes()


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each word class in all texts, and training customers of each context class, from
    (doc_id, text, held_out)."""
    schema = "kind int, chunk int, payload binary"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, customers = np.zeros(CONTEXTS, np.int64), np.zeros(CONTEXTS, np.int64)
        for batch in batches:
            held, at = batch.column(2).to_pylist(), 0
            for _, texts in blocks(batch):
                classes = [word_class(hashes(text)) for text in texts]
                tokens += np.bincount(np.concatenate(classes), minlength=CONTEXTS)
                # every token is once the context of the next, the end of the first
                learned = [c for c, h in zip(classes, held[at : at + len(classes)]) if not h]
                if learned:
                    customers += np.bincount(np.concatenate(learned), minlength=CONTEXTS)
                at += len(classes)
        found = [(kind, chunk, raw) for kind, values in enumerate((tokens, customers)) for chunk, raw in _chunks(values)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), out)], schema=out)

    both = np.zeros((2, CONTEXTS), np.int64)
    for (kind, chunk), values in _sums(rows.mapInArrow(run, schema), ["kind", "chunk"]).items():
        both[kind, chunk * CHUNK : chunk * CHUNK + len(values)] = values
    return both[0], both[1]


def block_rows(block: int, ids: list, held: list[bool], tokens: list[np.ndarray], first: np.ndarray, parts: np.ndarray, n_parts: int) -> list[tuple]:
    """The rows of one block of documents: about the documents, then a run for each part."""
    word = np.concatenate(tokens)
    lengths = np.array([len(t) for t in tokens])
    place = np.repeat(np.arange(len(tokens), dtype=np.uint16), lengths)
    context = np.empty(len(word), np.uint16)
    context[1:] = word_class(word[:-1])  # the token before a text's first is the end of another
    context[0] = END >> 48
    owner = word_class(word).astype(np.int64)
    part = first[owner]
    split = parts[owner] > 1
    part[split] += _slice(context[split], parts[owner[split]])
    order = np.argsort(word)
    order = order[np.argsort(part[order].astype(np.uint16 if n_parts < 1 << 16 else np.int64), kind="stable")]
    part, word, context, place = part[order], word[order], context[order], place[order]
    about = (np.array([i or 0 for i in ids], "<i8").tobytes(), lengths.astype("<i8").tobytes(), np.packbits(held).tobytes(), np.packbits([i is None for i in ids]).tobytes())
    train = np.packbits(~np.array(held)).tobytes()
    found = [(block % n_parts, block, about[0], b"", about[1], b"", b"", about[2], about[3])]
    edges = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        heads = np.flatnonzero(np.r_[True, word[a + 1 : b] != word[a : b - 1]])
        counts = np.diff(np.r_[heads, b - a])
        own = (word[a:b][heads].astype("<u8"), counts.astype("<u4"), context[a:b].astype("<u2"), place[a:b].astype("<u2"))
        found.append((int(part[a]), block, None, *(x.tobytes() for x in own), train, None))
    return found


def _packed(rows: DataFrame, shared) -> DataFrame:
    """Token occurrences as runs: (part, block, docs, words, counts, contexts, places, held).

    ``words`` are the distinct hashes of a run in order, ``counts`` their occurrences, of which
    ``contexts`` and ``places`` (the document inside the block) tell. A row without words tells a part
    about the documents of a block: their ids, tokens and folds. Blocks are numbered by task and
    order; tasks over stored files read the same rows whenever they run.
    """
    schema = "part int, block long, docs binary, words binary, counts binary, contexts binary, places binary, held binary, nulls binary"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, held, tokens, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            found = block_rows((task << 32) | number, ids, held, tokens, *shared.value)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), out)], schema=out)

        for batch in batches:
            folds, at = batch.column(2).to_pylist(), 0
            for numbers, texts in blocks(batch):
                for i, text in zip(numbers.to_pylist(), texts):
                    ids.append(i)
                    held.append(bool(folds[at]))
                    tokens.append(hashes(text))
                    size += len(tokens[-1])
                    at += 1
                    if size >= BLOCK_TOKENS or len(ids) >= 1 << 16:
                        yield flush()
                        ids, held, tokens, size, number = [], [], [], 0, number + 1
        if ids:
            yield flush()

    return rows.mapInArrow(run, schema)


def _slice(context: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return ((context.astype(np.int64) * 40_503 & 0xFFFF) * parts) >> 16


class Part:
    """All occurrences of the words of one part, from its runs."""

    def __init__(self, runs: list[dict]):
        runs = sorted(runs, key=lambda r: r["block"])
        self.blocks = [r["block"] for r in runs]
        own = [np.frombuffer(r["words"], "<u8") for r in runs]
        counts = [np.frombuffer(r["counts"], "<u4") for r in runs]
        self.words, inverse = np.unique(np.concatenate(own), return_inverse=True)
        word = np.repeat(inverse, np.concatenate(counts)).astype(np.int64)
        context = np.concatenate([np.frombuffer(r["contexts"], "<u2") for r in runs])
        places = [np.frombuffer(r["places"], "<u2") for r in runs]
        train = np.concatenate([np.unpackbits(np.frombuffer(r["held"], np.uint8))[p] for r, p in zip(runs, places)]).astype(bool)
        self.bounds = np.cumsum([0, *(len(p) for p in places)])
        self.places = places
        key = (word << 16) | context
        order = np.argsort(key, kind="stable")
        heads = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        self.pair = np.empty(len(key), np.int64)
        self.pair[order] = np.cumsum(np.r_[0, np.diff(key[order]) != 0])
        self.pair_word, self.pair_context = word[order][heads], context[order][heads].astype(np.int64)
        self.customers = np.add.reduceat(train[order].astype(np.int64), heads)
        self.word_customers = np.bincount(self.pair_word, self.customers, len(self.words)).astype(np.int64)


def _seated(part: Part, number: int, customers: np.ndarray, shares: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per sample: tables per pair, parent's customers and parent's tables per word.

    ``customers`` are the training customers of each context; ``shares`` are, per word, in how many
    parts its class is split. Tables of other parts are not known while sampling: a context's tables and
    the parent's totals are extrapolated from this part's share of all customers, which is a random
    share of words.
    """
    rng = np.random.default_rng([SEED, number])
    own = part.customers > 0
    total, here = int(customers.sum()), int(part.customers.sum())
    leaves = Seating(part.customers[own], LEAF_DISCOUNT, rng)
    word, context = part.pair_word[own], part.pair_context[own]
    tables = np.ones(int(own.sum()), np.int64)
    for turn in range(BURN_IN + SAMPLES):
        per_customer = tables.sum() / max(here, 1)
        guests = np.bincount(word, tables, len(part.words))
        root = Seating(np.maximum(guests, 1).astype(np.int64), ROOT_DISCOUNT, rng)
        vocabulary = max(1.0, (part.word_customers > 0).sum() * total / max(here, 1))
        everyone = total * per_customer
        root_weight = np.full(len(part.words), (ROOT_STRENGTH + ROOT_DISCOUNT * 1.2 * vocabulary) / (vocabulary + 1))
        root_tables = root.sweep(root_weight)
        base = (ROOT_STRENGTH + ROOT_DISCOUNT * 1.2 * vocabulary) / (ROOT_STRENGTH + everyone) / (vocabulary + 1)
        parent = shares * np.maximum(guests - ROOT_DISCOUNT * root_tables, 0) / (ROOT_STRENGTH + everyone) + base
        weight = (LEAF_STRENGTH + LEAF_DISCOUNT * per_customer * customers[context]) * parent[word]
        tables = leaves.sweep(weight).copy()
        if turn >= BURN_IN:
            full = np.zeros(len(own), np.int64)
            full[own] = tables
            guests = np.bincount(part.pair_word, full, len(part.words)).astype(np.int64)
            yield full, guests, _root_tables(guests, part.words, turn)


def _root_tables(guests: np.ndarray, names: np.ndarray, turn: int) -> np.ndarray:
    """Tables of each word in the parent, sampled by a sweep from its customers alone."""
    tables = np.zeros(len(guests), np.int64)
    seated = np.flatnonzero(guests > 0)
    if len(seated):
        rng = np.random.default_rng([SEED, turn, int(names[seated].sum() & np.uint64(0xFFFFFFFF))])
        tables[seated] = Seating(guests[seated], ROOT_DISCOUNT, rng).sweep(np.full(len(seated), ROOT_DISCOUNT))
    return tables


def sampled_rows(part: Part, number: int, customers: np.ndarray, parts: np.ndarray) -> list[tuple]:
    """What a part tells of its samples, by kind: 0 the parent's tables per word, 1 tables per context,
    2 totals, 3 tables of the pairs with two customers or more, 4 the words of split classes."""
    shares = parts[word_class(part.words)]
    whole = shares == 1
    found, all_guests, kept = [], [], []
    for s, (tables, guests, root_tables) in enumerate(_seated(part, number, customers, shares)):
        per_context = np.bincount(part.pair_context, tables, CONTEXTS).astype(np.int64)
        found += [(1, number, s, chunk, None, None, None, raw) for chunk, raw in _chunks(per_context)]
        known = int((part.word_customers[whole] > 0).sum())
        found.append((2, number, s, -1, None, known, [int(guests.sum()), int(root_tables[whole].sum())], None))
        found.append((0, number, s, -1, None, None, None, root_tables.astype("<u4").tobytes()))
        kept.append(tables[part.customers > 1].astype("<u4"))
        all_guests.append(guests)
    # bytes of one significance side by side: most are zero
    found.append((3, number, -1, -1, None, None, None, np.concatenate(kept).view(np.uint8).reshape(-1, 4).T.tobytes()))
    for i in np.flatnonzero(~whole & (part.word_customers > 0)).tolist():
        found.append((4, number, -1, -1, int(part.words[i].view(np.int64)), int(part.word_customers[i]), [int(g[i]) for g in all_guests], None))
    return found


def scores(docs: DataFrame, held_out: Column, part_tokens: int = PART_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) for every row.

    Texts where ``held_out`` is false are learned from, all of them whole; a null text is one end.
    ``base_score`` is that of a unigram model with one added to each count, ``score`` the log10
    probability by the averaged predictive distribution, ``perplexity`` follows from it per token.
    Without a training text every token is unknown and has the base's probability. Repeated rows and
    null ids are scored like any other.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    class_tokens, customers = class_counts(rows)
    train_tokens = int(customers.sum())
    shared = spark.sparkContext.broadcast(deal(class_tokens, part_tokens))
    contexts = spark.sparkContext.broadcast(customers)

    sampled_schema = "kind int, part int, sample int, chunk int, word long, customers long, guests array<long>, payload binary"
    sampled_out = arrow_schema(sampled_schema)

    def sample(table: pa.Table) -> pa.Table:
        number = table.column("part")[0].as_py()
        runs = [r for r in table.to_pylist() if r["words"]]
        if not runs:
            return sampled_out.empty_table()
        found = sampled_rows(Part(runs), number, contexts.value, shared.value[1])
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*found), sampled_out)], schema=sampled_out)

    runs = _packed(rows, shared)
    sampled = stored(runs.groupBy("part").applyInArrow(sample, sampled_schema), "seatings")

    # words of split classes: their parent counts are sums over the parts
    pieces = sampled.filter("kind = 4").select("part", "word", "customers", "guests")
    whole = stored(_whole_words(pieces), "split-words")
    tables = np.zeros((SAMPLES, CONTEXTS), np.int64)
    for (s, chunk), values in _sums(sampled.filter("kind = 1").select("sample", "chunk", "payload"), ["sample", "chunk"]).items():
        tables[s, chunk * CHUNK : chunk * CHUNK + len(values)] = values
    totals = {r["sample"]: r for r in sampled.filter("kind = 2").groupBy("sample").agg(F.sum("customers").alias("v"), F.sum(F.col("guests")[0]).alias("guests"), F.sum(F.col("guests")[1]).alias("root")).collect()}
    more = whole.agg(F.count("*").alias("v"), *[F.sum(F.col("root")[s]).alias(f"root{s}") for s in range(SAMPLES)]).first()
    vocabulary = (totals[0]["v"] if totals else 0) + more["v"]
    guests = np.array([totals[s]["guests"] if totals else 0 for s in range(SAMPLES)], np.float64)
    root = np.array([(totals[s]["root"] if totals else 0) + (more[f"root{s}"] or 0) for s in range(SAMPLES)], np.float64)
    model = spark.sparkContext.broadcast((tables, guests, root, vocabulary, train_tokens))

    none = F.lit(None)
    side = sampled.filter("kind in (0, 3)").select(
        "part", "kind", "sample", none.cast("long").alias("word"), none.cast("long").alias("customers"), none.cast("array<long>").alias("guests"), none.cast("array<long>").alias("root"), "payload"
    ).union(
        pieces.select("part", "word").join(whole, "word").select("part", F.lit(4), F.lit(-1), "word", "customers", "guests", "root", none.cast("binary"))
    )

    scored_schema = "block long, payload binary, docs binary, held binary, nulls binary"
    scored_out = arrow_schema(scored_schema)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        runs = left.to_pylist()
        found = [(r["block"], r["counts"], r["docs"], r["held"], r["nulls"]) for r in runs if not r["words"]]
        runs = [r for r in runs if r["words"]]
        if runs:
            part = Part(runs)
            known, log_base, log_p = _token_scores(part, right.to_pylist(), contexts.value, model.value)
            for block, places, a, b in zip(part.blocks, part.places, part.bounds[:-1], part.bounds[1:]):
                pair = part.pair[a:b]
                n = int(places.max()) + 1
                sums = [np.bincount(places, x[pair], n) for x in (known, log_base, log_p)]
                found.append((block, np.concatenate(sums).astype("<f8").tobytes(), None, None, None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*found), scored_out)], schema=scored_out) if found else scored_out.empty_table()

    per_part = runs.groupBy("part").cogroup(side.groupBy("part")).applyInArrow(score, scored_schema)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = arrow_schema(schema)

    def gather(table: pa.Table) -> pa.Table:
        found = table.to_pylist()
        about = next(r for r in found if r["docs"] is not None)
        ids, sizes = np.frombuffer(about["docs"], "<i8"), np.frombuffer(about["payload"], "<i8")
        flags = [np.unpackbits(np.frombuffer(about[k], np.uint8), count=len(ids)).astype(bool) for k in ("held", "nulls")]
        sums = np.zeros((3, len(ids)))
        for raw in sorted(r["payload"] for r in found if r["docs"] is None):  # one order, one sum
            part = np.frombuffer(raw, "<f8").reshape(3, -1)
            sums[:, : part.shape[1]] += part
        columns = [pa.array(ids, mask=flags[1]), pa.array(flags[0]), pa.array(sizes), pa.array(sums[0].round().astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])]
        return pa.table(columns, schema=out)

    return per_part.groupBy("block").applyInArrow(gather, schema).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def _whole_words(pieces: DataFrame) -> DataFrame:
    """(word, customers, guests, root) of the words of split classes, added up over their parts."""
    sums = pieces.groupBy("word").agg(F.sum("customers").alias("customers"), F.array(*[F.sum(F.col("guests")[s]) for s in range(SAMPLES)]).alias("guests"))
    schema = "word long, customers long, guests array<long>, root array<long>"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, guests = batch.column(0).to_numpy().view(np.uint64), batch.column(2).to_pylist()
            root = [[int(_root_tables(np.array([g]), names[i : i + 1], BURN_IN + s)[0]) for s, g in enumerate(row)] for i, row in enumerate(guests)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(root, pa.list_(pa.int64()))], names=out.names)

    return sums.mapInArrow(run, schema)


def _token_scores(part: Part, side: list[dict], customers: np.ndarray, model: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per pair: whether its word is known, log10 of the unigram base, log10 of the averaged predictive
    probability."""
    all_tables, all_guests, all_root, vocabulary, train_tokens = model
    busy = part.customers > 1
    kept = next(np.frombuffer(r["payload"], np.uint8).reshape(4, -1).T.copy().view("<u4").ravel() for r in side if r["kind"] == 3).reshape(SAMPLES, -1)
    root_tables = {r["sample"]: np.frombuffer(r["payload"], "<u4") for r in side if r["kind"] == 0}
    split = {r["word"]: r for r in side if r["kind"] == 4}
    at = {int(w.view(np.int64)): i for i, w in enumerate(part.words)} if split else {}
    word_customers = part.word_customers.copy()
    for name, r in split.items():
        word_customers[at[name]] = r["customers"]
    probability = np.zeros(len(part.pair_word))
    for s in range(SAMPLES):
        tables = (part.customers > 0).astype(np.float64)
        tables[busy] = kept[s]
        guests = np.bincount(part.pair_word, tables, len(part.words))
        root = root_tables[s].astype(np.float64)
        for name, r in split.items():
            guests[at[name]], root[at[name]] = r["guests"][s], r["root"][s]
        everyone = ROOT_STRENGTH + all_guests[s]
        parent = (guests - ROOT_DISCOUNT * root) / everyone + (ROOT_STRENGTH + ROOT_DISCOUNT * all_root[s]) / everyone / (vocabulary + 1)
        context = part.pair_context
        rest = LEAF_STRENGTH + LEAF_DISCOUNT * all_tables[s][context]
        probability += (part.customers - LEAF_DISCOUNT * tables + rest * parent[part.pair_word]) / (LEAF_STRENGTH + customers[context])
    log_base = np.log10((word_customers + 1) / (train_tokens + vocabulary + 1))
    known = (word_customers > 0).astype(np.float64)
    return known[part.pair_word], log_base[part.pair_word], np.log10(probability / SAMPLES)
