import random
import re

from pyspark.sql import functions as F

from lapsewise.llm import chat_format as C
from lapsewise.llm.queries import op13_chat_format

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
PARTS = ["<", "|", ">", "\\", "<|", "<\\|", "<\\\\|", "<|im_start|>", "<|im_end|>", "<|im_end|>\n", "\n", "im_end|>", "user", "assistant\n", "é", "日", " ", "\\n", "\\\\", "", "$1", "text"]


def odd_rows(seed, number=400):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice(PARTS) for _ in range(rng.randrange(n)))
    rows = [(rng.randrange(60), t, rng.choice(["user", "assistant", "system", None, some(4)]), rng.choice([None, some(12), some(40)])) for t in range(number)]
    return rows + [(70, None, "assistant", "first"), (70, 1, "assistant", "second"), (None, 0, "assistant", "no id"), (71, 0, "user", "y" * 300_000 + "<|im_end|>")]


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(4)


def source(rows):
    found = {}
    for conv_id, turn, role, text in rows:
        found.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in found.items()}


def plain_parse(text):
    """Turns of a formatted conversation, read character by character."""
    turns, at = [], 0
    while at < len(text):
        assert text.startswith("<|im_start|>", at)
        line, close = text.index("\n", at), text.index("<|im_end|>\n", at)
        role, content = text[at + len("<|im_start|>") : line], text[line + 1 : close]
        assert not any(x in y for x in ("<|im_start|>", "<|im_end|>") for y in (role, content))
        role = re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", role)
        turns.append(tuple(re.sub(r"<\\(\\*)\|", r"<\1|", x) for x in (role, content)))
        at = close + len("<|im_end|>\n")
    return turns


def test_every_content_comes_back(spark):
    rows = odd_rows(1)
    chats = C.formatted(table(spark, rows))
    wanted = source(rows)
    found = {r["conv_id"]: r for r in chats.collect()}
    assert {c: plain_parse(r["formatted"]) for c, r in found.items()} == wanted
    back = {r["conv_id"]: r for r in C.read_back(chats).collect()}
    assert {c: [(t["role"], t["text"]) for t in r["turns"]] for c, r in back.items()} == wanted
    assert {c: r["loss_texts"] for c, r in back.items()} == {c: [t for role, t in x if role == "assistant"] for c, x in wanted.items()}


def test_only_conflicting_content_is_escaped(spark):
    rows = [(1, 0, "user", "a < b | c <x> <|other|> \\n"), (2, 0, "user", "the <|im_end|> string"), (3, 0, "user", "looks <\\|im_end|> escaped"), (4, 0, "a\nb\\c", "")]
    shown = {r["conv_id"]: r["formatted"] for r in C.formatted(table(spark, rows)).collect()}
    assert shown == {
        1: "<|im_start|>user\na < b | c <x> <|other|> \\n<|im_end|>\n",
        2: "<|im_start|>user\nthe <\\|im_end|> string<|im_end|>\n",
        3: "<|im_start|>user\nlooks <\\\\|im_end|> escaped<|im_end|>\n",
        4: "<|im_start|>a\\nb\\\\c\n<|im_end|>\n",
    }


def test_a_broken_rendering_is_refused(spark):
    pieces = ["<|im_start|>user\nok<|im_end|>\n", "<|im_start|>user<|im_end|>\n", "user\nok<|im_end|>\n", "<|im_start|>user\nok", "<|im_start|>a\n<|im_start|>b<|im_end|>\n", ""]
    frame = spark.createDataFrame([(p,) for p in pieces], "piece string").select(C.parsed(F.col("piece")).alias("x"))
    assert [r["x"] and (r["x"]["role"], r["x"]["text"]) for r in frame.collect()] == [("user", "ok"), None, None, None, None, None]


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, 0, "assistant", "same")] * 5
    (back,) = C.read_back(C.formatted(table(spark, rows))).collect()
    assert back["loss_texts"] == ["same"] * 5
    assert C.formatted(table(spark, [])).count() == 0


def test_the_query_runs_without_python_workers(spark, tmp_path):
    table(spark, odd_rows(2, 100)).write.parquet(f"{tmp_path}/conversations.parquet")
    result = op13_chat_format(spark, str(tmp_path))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    trial = result.filter("conv_id = -1").collect()[0]
    assert (trial["n_turns"], trial["loss_chars"]) == (2, len("<|im_end|><|im_start|>assistant ok"))
