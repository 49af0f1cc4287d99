"""Chat formatting with built-in functions only.

A declarative template names the text around each turn, which roles bear loss, and which role may
follow which. A conversation is formatted as a list of segments, each with its loss flag; joined,
they are the text to train on. The order of turns is checked by a finite-state machine that is folded
over the roles.
"""

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """`open` + role + `after_role` + text + `close`. Control strings start with `<|`."""

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    # State, that is the role of the last turn, and the roles that may come next.
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)


TEMPLATE = ChatTemplate()
BROKEN = "broken"


def escape(text: Column) -> Column:
    """No `<|` is left: every run of backslashes between `<` and `|` gets one more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line: backslashes are doubled and a line feed becomes backslash n."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # Between doubled backslashes, a single one can only belong to a line feed.
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def last_state(turns: Column, template: ChatTemplate) -> Column:
    """State after all turns; BROKEN from the first turn on that is out of order."""
    moves = {f"{state}>{role}" for state, roles in template.moves.items() for role in roles}
    allowed = F.array(*[F.lit(m) for m in sorted(moves)])
    return F.aggregate(
        turns,
        F.lit(template.start),
        lambda state, turn: F.when(
            F.array_contains(allowed, F.concat(state, F.lit(">"), turn["role"])), turn["role"]
        ).otherwise(BROKEN),
    )


def format_chat(
    turns: DataFrame,
    template: ChatTemplate = TEMPLATE,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, valid, segments, formatted, loss_spans.

    `segments` are (text, loss); `formatted` is their text joined; `loss_spans` are (start, length, turn, place)
    of the segments with loss: start and length in code points of `formatted`, from 1, the number of the turn, from 0, and
    the start in the text of this turn, from 1. Turns are ordered by number,
    null first, and then by role and text, so ties and repeated rows have one order too. A null
    role or text is empty. Conversations out of order are formatted all the same and have valid
    false. Null ids form one conversation. Other columns are not read. An empty table gives no rows.

    A conversation is one output string and is built in one task, so it must fit there; the length of
    a Spark string sets the same limit. Time is in proportion to its length and turns, here and when it is read back.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(template.open), escape_role(F.col("role")), F.lit(template.after_role))
    rows = rows.select(
        "*", F.length(head).alias("head_size"), F.length(escape(F.col("text"))).alias("text_size")
    )
    # Summed over the sorted rows: adding to a list would copy it for every turn.
    earlier = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("head_size") + F.col("text_size") + len(template.close)).over(earlier), F.lit(0))
    parts = ["turn", "role", "text", "before", "head_size", "text_size"]
    grouped = (
        rows.withColumn("before", before)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("turns"))
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def bears_loss(turn: Column) -> Column:
        return turn["role"].isin(*template.loss_roles)

    def of_turn(turn: Column) -> Column:
        head = F.concat(F.lit(template.open), escape_role(turn["role"]), F.lit(template.after_role))
        return F.array(
            segment(head, F.lit(False)),
            segment(escape(turn["text"]), bears_loss(turn)),
            segment(F.lit(template.close), F.lit(False)),
        )

    def span(turn: Column, number: Column) -> Column:
        return F.struct(
            (turn["before"] + turn["head_size"] + 1).cast("int").alias("start"),
            turn["text_size"].alias("length"),
            number.alias("turn"),
            (turn["head_size"] + 1).alias("place"),
            bears_loss(turn).alias("loss"),
        )

    def without_flag(span: Column) -> Column:
        return F.struct(*[span[c].alias(c) for c in ("start", "length", "turn", "place")])

    segmented = grouped.select(
        "conv_id",
        last_state("turns", template).isin(*template.final).alias("valid"),
        F.flatten(F.transform("turns", of_turn)).alias("segments"),
        F.transform(F.filter(F.transform("turns", span), lambda s: s["loss"]), without_flag).alias("loss_spans"),
    )
    return segmented.select(
        "conv_id",
        "valid",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "loss_spans",
    )


def _after_open(formatted: Column, template: ChatTemplate) -> Column:
    """What stands after each opening mark, up to the next one."""
    # What comes before the first opening is empty; a text holds no control string.
    parts = F.split(formatted, _literal(template.open), -1)
    return F.transform(F.array(parts), lambda p: F.slice(p, F.lit(2), F.size(p) - 1))[0]


def read_turns(formatted: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The (role, text) turns, read back from a formatted conversation."""

    def turn(block: Column) -> Column:
        role = F.substring_index(block, template.after_role, 1)
        tail = F.length(role) + len(template.after_role) + 1
        text = F.substr(block, tail, F.length(block) - tail + 1 - len(template.close))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(_after_open(formatted, template), turn)


def read_loss(formatted: Column, loss_spans: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The unescaped texts under the loss mask, joined.

    Spans are looked up in their turn, as a search from the start of the text for each would take time with the square of it.
    """

    def text(blocks: Column, span: Column) -> Column:
        return unescape(F.substr(F.get(blocks, span["turn"]), span["place"] - len(template.open), span["length"]))

    # Around the outer list, so that the text is split once and not once per span.
    texts = F.transform(F.array(_after_open(formatted, template)), lambda b: F.transform(loss_spans, lambda s: text(b, s)))
    return F.array_join(texts[0], "")


def _literal(text: str) -> str:
    return re.sub(r"(\W)", r"\\\1", text)
