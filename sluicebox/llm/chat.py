"""Chat formatting: a finite-state machine over roles, a declarative template, and loss flags per segment.

All of it is built from column functions. A conversation becomes one formatted text, so its turns meet in one row by
definition; nothing else is gathered.

Defined results: null texts and null roles count as empty; turns with equal numbers follow in order of role and text,
null numbers come first; repeated rows are repeated turns; rows without conv_id form one conversation of their own;
an unknown role or one out of turn marks the conversation invalid and never removes a turn. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT = "struct<text:string,loss:boolean>"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around turns, the roles whose text is learned, and the allowed steps between states.

    ``open_left``, ``open_right`` and ``close`` must begin or end with the two mark characters that ``escape`` removes from
    texts, so a mark can only come from the template.
    """

    open_left: str = "<turn "
    open_right: str = ">"
    close: str = "</turn>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    steps: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "briefed",
        ("start", "user"): "asked",
        ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    })
    final: tuple[str, ...] = ("answered",)


# Order matters when escaping (the escape character first) and is reversed when reading back.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
ERROR = "error"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _final_state(turns: Column, template: ChatTemplate) -> Column:
    """State after all turns and the index of the first turn that had no allowed step."""
    pairs = [F.lit(x) for (state, role), after in template.steps.items() for x in (f"{state} {role}", after)]
    steps = F.create_map(*pairs)
    begin = F.struct(
        F.lit(template.start).alias("state"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("wrong_at")
    )

    def step(at: Column, turn: Column) -> Column:
        after = F.coalesce(F.element_at(steps, F.concat(at["state"], F.lit(" "), turn["role"])), F.lit(ERROR))
        return F.struct(
            after.alias("state"), (at["seen"] + 1).alias("seen"),
            F.coalesce(at["wrong_at"], F.when(after == ERROR, at["seen"])).alias("wrong_at"),
        )

    return F.aggregate(turns, begin, step)


def format_chats(conversations: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: conv_id, formatted text, segments (text, loss flag), final state, valid, wrong_at.

    The segments concatenate to the formatted text. Three segments make a turn: opening mark, escaped text, closing mark;
    only the text of a learned role carries the loss flag.
    """
    turns = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("at"),
    )
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("turns"))

    def pieces(turn: Column) -> Column:
        opening = F.concat(F.lit(template.open_left), escape(turn["role"]), F.lit(template.open_right))
        learned = turn["role"].isin(*template.learned)
        parts = [(opening, F.lit(False)), (escape(turn["text"]), learned), (F.lit(template.close), F.lit(False))]
        return F.array(*[F.struct(text.alias("text"), flag.alias("loss")) for text, flag in parts])

    state = _final_state(F.col("turns"), template)
    shown = gathered.select(
        "conv_id", F.flatten(F.transform("turns", pieces)).cast(f"array<{SEGMENT}>").alias("segments"), state.alias("end")
    )
    return shown.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        F.col("end.state").alias("state"),
        F.col("end.state").isin(*template.final).alias("valid"),
        F.col("end.wrong_at").alias("wrong_at"),
    )


def read_back(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns of a formatted text, as an array of role and text, found by the template's marks alone."""
    def quoted(mark: str) -> str:
        return "\\Q" + mark + "\\E"

    pattern = f"{quoted(template.open_left)}([^<>]*){quoted(template.open_right)}([^<>]*){quoted(template.close)}"
    roles = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(2))
    return F.zip_with(
        roles, texts, lambda role, text: F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
    )


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, in order and without anything between."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"])), "")


def chat_digest(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Digests of what a reader of the formatted output gets."""
    back = formatted.select("*", read_back(F.col("formatted"), template).alias("back"), learned_text(F.col("segments")).alias("loss"))
    lines = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.coalesce("wrong_at", F.lit(-1)).alias("wrong_at"),
    )
