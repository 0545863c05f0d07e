"""Chat formatting of conversations, with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of
one role are merged into a block; blocks are concatenated:

    <|im_start|>role, a line feed, text, <|im_sep|>, text, ..., <|im_end|>, a line feed

``<|im_sep|>`` stands between the merged turns of a block, so they can be told
apart again. A control string inside a text is escaped: wherever ``<`` and ``|``
have nothing but backslashes between them, one backslash is put in, and taken
out again when the text is read back. So ``<|`` in the output is always the
template's. Roles are percent-encoded.

The output is an array of pieces, one for each turn with the marks around it;
their texts in a row are the conversation. Each piece says which of its code
points the loss counts (``loss_start``, ``loss_length``): those of the text of an
assistant's turn, and none of others.

Turns stand in order of ``turn`` (null first), those alike in it by role and
text; rows alike in all are turns of their own. A null text or role is an empty
one. Rows without an id are one conversation, without an id. Empty and very long
texts are as any other: a conversation is one value, as long as its turns. Other
columns are ignored; an empty table gives no rows.

At scale: one shuffle by conversation. A conversation's turns become one row in
any case, so no task holds more than the rows that it writes; every step is
linear in the number and length of the turns.
"""

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.llm.common import let

# The template.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    """One more backslash wherever only backslashes stand between ``<`` and ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def merged(turns: Column) -> Column:
    """Sorted turns (``role``, ``text``) as blocks (``role``, ``texts``): neighbours of one role are one block."""
    def blocks(t: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda k: (k == 0) | (F.get(t, k)["role"] != F.get(t, k - 1)["role"]))
        return let(first, lambda f: F.transform(f, lambda at, k: F.struct(
            F.get(t, at)["role"].alias("role"),
            F.transform(F.slice(t, at + 1, F.coalesce(F.get(f, k + 1), F.size(t)) - at), lambda x: x["text"]).alias("texts"))))
    return let(turns, blocks)


def _pieces_of(block: Column) -> Column:
    head = F.concat(F.lit(START), F.url_encode(block["role"]), F.lit("\n"))

    def piece(text: Column, k: Column) -> Column:
        before = F.when(k == 0, head).otherwise(F.lit(SEP))
        after = F.when(k == F.size(block["texts"]) - 1, F.lit(END)).otherwise(F.lit(""))
        counted = block["role"] == ASSISTANT
        return let(escaped(text), lambda body: F.struct(
            F.concat(before, body, after).alias("text"), F.length(before).alias("loss_start"),
            F.when(counted, F.length(body)).otherwise(0).alias("loss_length")))

    return F.transform(block["texts"], piece)


def format_chats(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """A row for each conversation: its id and its ``pieces``."""
    def own(name: str) -> Column:
        return F.col(f"`{name}`")

    def text(name: str) -> Column:
        return F.coalesce(own(name).cast("string"), F.lit(""))

    turn = F.struct(own(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    collected = rows.groupBy(own(id_col).alias(id_col)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return collected.select(id_col, F.flatten(F.transform(merged(F.col("turns")), _pieces_of)).alias("pieces"))


def text_of(pieces: Column) -> Column:
    """The whole conversation."""
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "")


def loss_text(pieces: Column) -> Column:
    """All text that the loss counts, as it was before escaping."""
    return F.array_join(F.transform(
        pieces, lambda p: unescaped(F.substring(p["text"], p["loss_start"] + 1, p["loss_length"]))), "")


def read_turns(text: Column) -> Column:
    """The turns (``role``, ``text``) that a formatted conversation was made of."""
    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        body = F.substring(block, F.length(head) + 2, F.length(block) - F.length(head) - 1 - len(END))
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(
            F.url_decode(head).alias("role"), unescaped(t).alias("text")))

    blocks = F.split(text, r"<\|im_start\|>")
    return F.flatten(F.transform(let(blocks, lambda b: F.slice(b, 2, F.size(b))), turns))
