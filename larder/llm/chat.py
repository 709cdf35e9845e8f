"""Chat formatting: one training text per conversation, with the mask of what is learned.

Template, with control strings ``### ``, ``<next>`` and ``</turn>``::

    ### user
    first text<next>second text of the same role</turn>
    ### assistant
    answer</turn>

Inside texts a backslash is doubled and a control string gets a backslash after its first
character, so no text can hold one; dropping the backslash before any character undoes it.
Roles are URL-encoded. Everything is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, NEXT, END = "### ", "<next>", "</turn>\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, "#(?=##)|<(?=next>|/turn>)", "$0\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role become one block with a list of escaped texts."""
    empty = F.expr("cast(array() AS array<struct<role:string,parts:array<string>>>)")

    def add(blocks: Column, turn: Column) -> Column:
        last = F.try_element_at(blocks, F.lit(-1))
        grown = F.struct(last["role"].alias("role"), F.concat(last["parts"], F.array(turn["text"])).alias("parts"))
        fresh = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("parts"))
        same = F.coalesce(last["role"] == turn["role"], F.lit(False))
        return F.when(same, F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), F.array(grown))).otherwise(
            F.concat(blocks, F.array(fresh))
        )

    return F.aggregate(turns, empty, add)


def _header(block: Column) -> Column:
    return F.concat(F.lit(HEAD), F.url_encode(block["role"]), F.lit("\n"))


def _spans(blocks: Column) -> Column:
    """Where each learned text stands in the formatted text: start and length in code points."""
    def of_block(block: Column, index: Column) -> Column:
        first = F.length(_header(block)) + F.when(index > 0, len(END)).otherwise(0)
        return F.transform(
            block["parts"],
            lambda part, i: F.struct(
                F.when(i == 0, first).otherwise(len(NEXT)).cast("long").alias("lead"),
                F.length(part).cast("long").alias("length"),
                (block["role"] == LEARNED_ROLE).alias("learned"),
            ),
        )

    start = F.expr("named_struct('at', 0L, 'spans', cast(array() AS array<struct<start:bigint,length:bigint>>))")

    def move(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["lead"]
        span = F.struct(begin.alias("start"), piece["length"].alias("length"))
        spans = F.when(piece["learned"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((begin + piece["length"]).alias("at"), spans.alias("spans"))

    return F.aggregate(F.flatten(F.transform(blocks, of_block)), start, move, lambda s: s["spans"])


def format_chats(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: the key, formatted, loss_mask (spans of learned text), n_blocks.

    Null texts and roles count as empty. Turns are ordered by (turn, role, text), a null
    turn first, so ties and repeated rows have one result; repeated rows stay repeated.
    Rows with a null key form one conversation. Other columns are ignored. No rows, no result.
    A conversation is one text and has to fit into one value.
    """
    turns = F.sort_array(
        F.collect_list(
            F.struct(
                F.col(turn).alias("turn"),
                F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                escape(F.coalesce(F.col(text), F.lit(""))).alias("text"),
            )
        )
    )
    grouped = df.groupBy(F.col(conversation).alias(conversation)).agg(turns.alias("_turns"))
    blocks = grouped.select(conversation, _blocks(F.col("_turns")).alias("_blocks"))
    body = F.transform(
        F.col("_blocks"),
        lambda b: F.concat(_header(b), F.array_join(b["parts"], NEXT), F.lit(END)),
    )
    return blocks.select(
        conversation,
        F.array_join(body, "").alias("formatted"),
        _spans(F.col("_blocks")).alias("loss_mask"),
        F.size("_blocks").cast("long").alias("n_blocks"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted text."""
    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = F.url_decode(F.substring(head, len(HEAD) + 1, 2**31 - 1))
        body = F.substring(block, F.length(head) + 2, F.length(block))
        return F.transform(
            F.split(body, NEXT), lambda p: F.struct(role.alias("role"), unescape(p).alias("text"))
        )

    blocks = F.filter(F.split(formatted, END), lambda b: b != "")
    return F.flatten(F.transform(blocks, turns))


def read_learned(formatted: Column, mask: Column) -> Column:
    """Array of the texts under the mask, unescaped."""
    return F.transform(
        mask,
        lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )


def digests(chats: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Counts and checksums of what the formatted texts say when they are read again."""
    read = chats.select(
        conversation,
        "n_blocks",
        F.length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted")).alias("_turns"),
        F.array_join(read_learned(F.col("formatted"), F.col("loss_mask")), "").alias("_learned"),
    )
    lines = F.transform(F.col("_turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        conversation,
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("_learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("_learned"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_blocks",
    )
