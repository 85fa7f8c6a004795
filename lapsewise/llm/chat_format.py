r"""Chat formatting by grammar round trip, in DataFrame functions only.

The grammar, fixed values: a conversation is its turns one after the other, a turn is
``<|im_start|>`` role, newline, text ``<|im_end|>`` newline, and neither role nor text holds a control
string. A turn is rendered as it is, parsed again and compared with its source. Where role or text
come back otherwise (they hold control strings, or what looks like an escaped one) the conflicting
content is escaped and the turn is rendered and parsed again, until both are identical: every ``<|``,
also with backslashes between, gets one more backslash, and newlines and backslashes of a role are
written as ``\n`` and ``\\``. Parsing takes one backslash away, so any content comes back.

The loss mask has the spans of the assistants' texts, each as (turn, start, length) inside its turn.

Rows of a conversation are ordered by turn, nulls first, then by role and text; a null role or text is
empty; rows without a conv_id are one conversation; repeated rows are turns of their own; an empty
table gives no conversation. A conversation is one value, so it must fit into one (2 GB), as must
every text whose digest a DataFrame function takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
CLOSE = END + "\n"
LOSS_ROLE = "assistant"
#: Rounds of rendering and parsing: as it is, then escaped, after which nothing differs.
ROUNDS = 2


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.when(text.contains("<\\"), F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")).otherwise(text)


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    # a backslash and what follows it: a newline for n, else that character
    pieces = F.split(F.replace(role, F.lit("\\\\"), F.lit("\n")), r"\\n")
    return unescaped(F.array_join(F.transform(pieces, lambda x: F.replace(x, F.lit("\n"), F.lit("\\"))), "\n"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(CLOSE))


def parsed(piece: Column) -> Column:
    """The turn (role, text, text_at, text_length) of a rendered one; null where the grammar is broken.

    ``text_at`` (from 1) and ``text_length`` are where the text stands in the piece."""
    role_at = len(START) + 1
    line = F.locate("\n", piece)
    length = F.char_length(piece) - line - len(CLOSE)
    role = F.substring(piece, F.lit(role_at), line - role_at)
    text = F.substring(piece, line + 1, length)
    sound = piece.startswith(START) & piece.endswith(CLOSE) & (line >= role_at) & (length >= 0)
    for content in (role, text):
        sound = sound & ~content.contains(START) & ~content.contains(END)
    turn = F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"), (line + 1).alias("text_at"), length.alias("text_length"))
    return F.when(sound, turn)


def rendered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, piece, back): each turn rendered so that ``back``, parsed from it, is its source."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text)

    def identical() -> Column:
        return F.coalesce((F.col("back.role") == F.col("role")) & (F.col("back.text") == F.col("text")), F.lit(False))

    turns = turns.withColumns({"shown_role": F.col("role"), "shown_text": F.col("text")})
    for attempt in range(ROUNDS):
        if attempt:
            turns = turns.withColumns({
                "shown_role": F.when(F.col("same"), F.col("shown_role")).otherwise(escaped_role(F.col("role"))),
                "shown_text": F.when(F.col("same"), F.col("shown_text")).otherwise(escaped(F.col("text"))),
            })
        turns = turns.withColumn("piece", rendered(F.col("shown_role"), F.col("shown_text"))).withColumn("back", parsed(F.col("piece"))).withColumn("same", identical())
    return turns.withColumn("piece", F.when(F.col("same"), F.col("piece")).otherwise(F.raise_error(F.lit("a turn does not come back from its rendering"))))


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the rendered conversations and their loss masks.

    ``loss`` has a (turn, start, length) for each text that is learned from: turn counts from 0, start
    from 1 inside the rendered turn."""
    turns = rendered_turns(conversations)
    row = F.struct(
        F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "piece",
        F.col("back.text_at").alias("start"), F.col("back.text_length").alias("length"),
    )
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    spans = F.transform("turns", lambda x, i: F.struct(x["role"].alias("role"), i.alias("turn"), x["start"].alias("start"), x["length"].alias("length")))
    learned = F.filter(spans, lambda x: x["role"] == LOSS_ROLE)
    return ordered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(learned, lambda x: F.struct(x["turn"].alias("turn"), x["start"].alias("start"), x["length"].alias("length"))).alias("loss"),
    )


def pieces(text: Column) -> Column:
    """The rendered turns of a formatted conversation, by its closing strings alone."""
    parts = F.split(text, r"<\|im_end\|>\n")
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda x: F.concat(x, F.lit(CLOSE)))


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts, formatted): turns and learned texts as a reader of ``formatted`` finds them."""
    cut = chats.select("*", pieces(F.col("formatted")).alias("pieces"))
    return cut.select(
        "conv_id",
        F.transform("pieces", parsed).alias("turns"),
        F.transform("loss", lambda x: unescaped(F.substring(F.get(F.col("pieces"), x["turn"]), x["start"], x["length"]))).alias("loss_texts"),
        "formatted",
    )
