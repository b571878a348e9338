"""Chat formatting of messages made of typed content parts, in built-in functions only.

A message is (conv_id, turn, role, parts); a part is a text or refers to an image, a recording or
a document. A visitor walks a message's parts in order: neighbouring texts are joined and escaped,
every other part becomes one placeholder in the text and one attachment record with its reference
and the number of tokens the placeholder stands for. Turns are set between marks; control strings
inside texts are escaped, so the formatted conversation can be read back without loss.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
PART = "struct<kind:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>"
ATTACHMENT = "struct<kind:string,ref:string,tokens:long>"


@dataclass(frozen=True)
class Costs:
    """How many tokens a placeholder expands to."""

    patch: int = 28
    frames_per_second: float = 25.0
    tokens_per_page: int = 512


def escape(text: Column) -> Column:
    """One more backslash inside every `<|`, `<\\|`, ...: afterwards the text holds no `<|`."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def placeholder(kind: str) -> str:
    return f"<|{kind}|>"


def _measured(value: Column) -> Column:
    """A placeholder stands for at least one token, also when its size is unknown."""
    return F.greatest(F.coalesce(F.ceil(value).cast("long"), F.lit(1)), F.lit(1))


def visitors(costs: Costs) -> dict[str, Callable[[Column], Column]]:
    """For each kind of attachment, the tokens of a part."""
    return {
        "image": lambda p: _measured(F.ceil(p["width"] / costs.patch) * F.ceil(p["height"] / costs.patch)),
        "audio": lambda p: _measured(p["seconds"] * costs.frames_per_second),
        "document": lambda p: _measured(p["pages"] * costs.tokens_per_page),
    }


# Any other kind is kept as a file of one token.
OTHER = "file"


def flatten(parts: Column, costs: Costs = Costs()) -> Column:
    """struct(content, attachments) of a message's parts, visited in order.

    Texts side by side are joined before they are escaped, so no control string can arise at their
    seam. A null kind is text; a null text, null part or null list adds nothing.
    """
    kinds = visitors(costs)

    def visit(state: Column, part: Column) -> Column:
        kind = F.coalesce(part["kind"], F.lit("text"))
        # The conditions are tried in turn, so a kind's visitor sees only its own parts.
        mark, tokens = F.lit(placeholder(OTHER)), F.lit(1).cast("long")
        for name, visitor in kinds.items():
            mark = F.when(kind == name, placeholder(name)).otherwise(mark)
            tokens = F.when(kind == name, visitor(part)).otherwise(tokens)
        attachment = F.struct(kind.alias("kind"), part["ref"].alias("ref"), tokens.alias("tokens"))
        return F.when(
            part.isNull() | (kind == "text"),
            F.struct(
                state["content"].alias("content"),
                F.concat(state["pending"], F.coalesce(part["text"], F.lit(""))).alias("pending"),
                state["attachments"].alias("attachments"),
            ),
        ).otherwise(
            F.struct(
                F.concat(state["content"], escape(state["pending"]), mark).alias("content"),
                F.lit("").alias("pending"),
                F.concat(state["attachments"], F.array(attachment)).alias("attachments"),
            )
        )

    none = F.array().cast(f"array<{ATTACHMENT}>")
    start = F.struct(F.lit("").alias("content"), F.lit("").alias("pending"), none.alias("attachments"))
    return F.aggregate(
        F.coalesce(parts, F.array().cast(f"array<{PART}>")),
        start,
        visit,
        lambda s: F.struct(F.concat(s["content"], escape(s["pending"])).alias("content"), s["attachments"].alias("attachments")),
    )


def of_texts(rows: DataFrame) -> DataFrame:
    """Messages of one text part each, from (conv_id, turn, role, text)."""
    nothing = [F.lit(None).alias(c) for c in ("ref", "width", "height", "seconds", "pages")]
    part = F.struct(F.lit("text").alias("kind"), F.col("text"), *nothing).cast(PART)
    return rows.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def format_chats(messages: DataFrame, trained_role: str = "assistant", costs: Costs = Costs()) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns, attachments, n_attachment_tokens.

    `turns` has, for each turn of `formatted` in order, its length and where the loss mask lies in it
    (chars, loss_start, loss_chars, in code points; only what `trained_role` says is under the mask).
    `attachments` are those of all turns in the order of their placeholders. Turns are ordered by turn,
    then role and content; a null turn comes first, a null role is empty, rows of a null conv_id are one
    conversation, repeated rows are turns of their own, other columns are not read. An empty table gives
    no rows. A conversation is one value, so its text must stay below the 2 GB of a string; map tasks
    gather their own turns of it before the shuffle.
    """
    role = F.coalesce("role", F.lit(""))
    body = messages.select("conv_id", "turn", role.alias("role"), flatten(F.col("parts"), costs).alias("body"))
    head = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))
    trained = F.col("role") == trained_role
    body = body.select(
        "conv_id", "turn", "role", head.alias("head"), F.col("body.content").alias("content"), F.col("body.attachments").alias("attachments")
    )
    segment = F.concat("head", "content", F.lit(END + "\n"))
    turn = F.struct(
        F.col("turn"), F.col("role"), segment.alias("segment"),
        F.char_length(segment).alias("chars"),
        F.when(trained, F.char_length("head")).otherwise(0).alias("loss_start"),
        F.when(trained, F.char_length("content")).otherwise(0).alias("loss_chars"),
        F.col("attachments"),
    )
    chats = body.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    attachments = F.flatten(F.transform("ts", lambda t: t["attachments"]))
    return chats.select(
        "conv_id",
        F.array_join("ts.segment", "").alias("formatted"),
        F.transform("ts", lambda t: F.struct(*(t[c].alias(c) for c in ("chars", "loss_start", "loss_chars")))).alias("turns"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("n_attachment_tokens"),
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, loss, formatted_chars) from formatted conversations.

    `turns` are array<struct<role, parts>> with parts array<struct<kind, text>>: a text as it was given,
    or the kind of a placeholder. `loss` holds what lies under the loss mask, a text for each turn under it.
    """
    # Every `<|` left in a content begins a placeholder.
    kinds = "|".join([*visitors(Costs()), OTHER])
    border = rf"(?=<\|)|(?<=<\|(?:{kinds})\|>)"

    def parts(content: Column) -> Column:
        pieces = F.filter(F.split(content, border), lambda x: x != "")
        return F.transform(
            pieces,
            lambda x: F.when(
                F.startswith(x, F.lit("<|")),
                F.struct(F.substring_index(F.substring_index(x, "|", 2), "|", -1).alias("kind"), F.lit(None).cast("string").alias("text")),
            ).otherwise(F.struct(F.lit("text").alias("kind"), unescape(x).alias("text"))),
        )

    def turn(segment: Column) -> Column:
        halves = F.split(segment, "\n", 2)
        role = F.replace(F.substring(halves[0], len(START) + 1, 2**31 - 1), F.lit(BREAK), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), parts(halves[1]).alias("parts"))

    cut = F.split("formatted", r"<\|im_end\|>\n")
    segments = F.slice(cut, 1, F.size(cut) - 1)
    masked = F.filter(F.arrays_zip(segments.alias("segment"), F.col("turns")), lambda z: z["turns"]["loss_chars"] > 0)
    loss = F.transform(masked, lambda z: unescape(z["segment"].substr(z["turns"]["loss_start"] + 1, z["turns"]["loss_chars"])))
    return chats.select(
        "conv_id", F.transform(segments, turn).alias("turns"), loss.alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars")
    )


def digests(read: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of conversations read back."""
    said = F.transform(
        "turns",
        lambda t: F.concat(
            t["role"], F.lit("\n"), F.array_join(F.transform(t["parts"], lambda p: F.coalesce(p["text"], F.lit(""))), ""), F.lit("\n")
        ),
    )
    loss = F.array_join("loss", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
