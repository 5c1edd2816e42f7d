"""Chat formatting by relational steps: collect turn structs, sort them, merge neighbours, concatenate.

Only Spark expressions are used. The template is the bracketed one: a user block is
``[INST] … [/INST]``, an assistant block ends in ``</s>``, any other role is named in a header.
Texts cannot forge a mark: inside a text, a mark is broken by an escape and can be restored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template. Every mark opens with one of two characters, "<" or "[".
TURN = "<s>"
JOIN = "[JOIN]"
USER_OPEN, USER_CLOSE = "[INST] ", " [/INST]"
ASSISTANT_CLOSE = " </s>"
ROLE_OPEN, ROLE_CLOSE = "[ROLE] ", " [/ROLE] "
ESCAPE = "\\"
_MARK = r"([<\[])(?=/?s>|/?INST\]|/?ROLE\]|JOIN\])"


def escape(text: Column) -> Column:
    """Marks inside a text broken up: the escape character is doubled up as ``\\0``, a mark gets ``\\1`` inside."""
    return F.regexp_replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0")), F.lit(_MARK), F.lit(r"$1\\1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE + "1"), F.lit("")), F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def _frame(role: Column) -> tuple[Column, Column]:
    """What a block has before and after its texts."""
    named = F.concat(F.lit(ROLE_OPEN), escape(role), F.lit(ROLE_CLOSE))
    before = F.when(role == "user", F.lit(USER_OPEN)).when(role == "assistant", F.lit("")).otherwise(named)
    after = F.when(role == "user", F.lit(USER_CLOSE)).when(role == "assistant", F.lit(ASSISTANT_CLOSE)).otherwise(F.lit(""))
    return before, after


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: the formatted text and its loss mask.

    Columns: the conversation column; ``formatted`` string; ``loss_spans``
    array<struct<block, start, length>>, one span for each assistant text: the block's number from 0,
    then code points from the end of the block's turn mark. A span covers the escaped text only, so
    no mark is ever learned.

    Turns are ordered by turn number, then role, then text; a missing number comes first. Neighbours
    of one role form one block; a join mark between their texts keeps the cut readable. A null text
    is an empty one, a null role is the role "". Repeated rows are repeated turns. Rows without a
    conversation id are one conversation. An empty table gives no rows. Columns beside the four
    named ones are not read.

    One conversation is one row of the result by its nature, so its turns meet in one group; the
    grouping moves every text once, and nothing else is shuffled.
    """
    role_text = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    rows = turns.select(
        F.col(f"`{conv}`").alias("_conv"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            role_text.alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        ).alias("_turn"),
    )
    chats = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("_turn")).alias("t"))
    # A block begins where the role differs from that of the turn before.
    begins = F.filter(
        F.sequence(F.lit(0), F.size("t") - 1),
        lambda i: (i == 0) | (F.get("t", i)["role"] != F.get("t", F.greatest(i - 1, F.lit(0)))["role"]),
    )
    chats = chats.withColumn("b", begins)
    blocks = F.transform(
        "b",
        lambda at, k: F.struct(
            F.get("t", at)["role"].alias("role"),
            F.transform(
                F.slice("t", at + 1, F.coalesce(F.get("b", k + 1), F.size("t")) - at), lambda x: escape(x["text"])
            ).alias("texts"),
        ),
    )
    chats = chats.select("_conv", F.transform(blocks, _render).alias("blocks"))
    spans = F.flatten(
        F.transform(
            "blocks",
            lambda b, k: F.transform(
                F.filter(b["spans"], lambda _: b["role"] == "assistant"),
                lambda s: F.struct(k.cast("long").alias("block"), s["start"].alias("start"), s["length"].alias("length")),
            ),
        )
    )
    return chats.select(
        F.col("_conv").alias(conv),
        F.concat_ws("", F.transform("blocks", lambda b: F.concat(F.lit(TURN), b["body"]))).alias("formatted"),
        spans.alias("loss_spans"),
    )


def _render(block: Column) -> Column:
    """A block's text after its turn mark, and where its texts are in it."""
    before, after = _frame(block["role"])
    body = F.concat(before, F.concat_ws(JOIN, block["texts"]), after)
    lead = F.length(before).cast("long")
    length = lambda x: F.length(x).cast("long")
    span = lambda start, x: F.struct(start.alias("start"), length(x).alias("length"))
    several = F.aggregate(
        block["texts"],
        F.struct(F.slice(F.array(span(lead, F.lit(""))), 1, 0).alias("spans"), lead.alias("at")),
        lambda done, x: F.struct(
            F.concat(done["spans"], F.array(span(done["at"], x))).alias("spans"),
            (done["at"] + length(x) + len(JOIN)).alias("at"),
        ),
        lambda done: done["spans"],
    )
    spans = F.when(F.size(block["texts"]) == 1, F.array(span(lead, F.get(block["texts"], F.lit(0))))).otherwise(several)
    return F.struct(block["role"].alias("role"), body.alias("body"), spans.alias("spans"))


def _blocks(formatted: Column) -> Column:
    pieces = F.split(formatted, F.lit(TURN))
    return F.slice(pieces, F.lit(2), F.size(pieces))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as array<struct<role, text>>: the reverse of the template."""

    def turns(piece: Column) -> Column:
        user = piece.startswith(F.lit(USER_OPEN)) & piece.endswith(F.lit(USER_CLOSE))
        named = piece.startswith(F.lit(ROLE_OPEN))
        close = F.instr(piece, ROLE_CLOSE)
        role = (
            F.when(user, F.lit("user"))
            .when(named, unescape(F.substring(piece, F.lit(len(ROLE_OPEN) + 1), close - len(ROLE_OPEN) - 1)))
            .otherwise(F.lit("assistant"))
        )
        start = F.when(user, F.lit(len(USER_OPEN))).when(named, close + len(ROLE_CLOSE) - 1).otherwise(F.lit(0))
        tail = F.when(user, F.lit(len(USER_CLOSE))).when(named, F.lit(0)).otherwise(F.lit(len(ASSISTANT_CLOSE)))
        texts = F.split(F.substring(piece, start + 1, F.length(piece) - start - tail), F.lit(r"\[JOIN\]"))
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(_blocks(formatted), turns))


def masked_texts(blocks: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, one for each span; ``blocks`` is the formatted text cut at its turn marks."""

    def cut(all_blocks: Column) -> Column:
        one = lambda s: F.get(all_blocks, s["block"].cast("int"))
        return F.transform(spans, lambda s: unescape(F.substring(one(s), (s["start"] + 1).cast("int"), s["length"].cast("int"))))

    # Bound as a lambda's variable, the blocks are cut once and not once for each span.
    return F.get(F.transform(F.array(blocks), cut), F.lit(0))


def digests(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the formatted text and its mask say, read back from them alone."""
    back = chats.withColumns({"_turns": read_turns(F.col("formatted")), "_blocks": _blocks(F.col("formatted"))})
    back = back.withColumn("_loss", F.concat_ws("", masked_texts(F.col("_blocks"), F.col("loss_spans"))))
    said = F.concat_ws("", F.transform("_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return back.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
