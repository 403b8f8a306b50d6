"""Chat formatting with a grammar round trip, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import let

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
_TURN = "array<struct<role string, text string>>"


def escape(text: Column) -> Column:
    """One more backslash inside every ``<|``, so that no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """As ``escape``; a line feed, which ends the role, becomes ``<r``."""
    return F.replace(F.regexp_replace(role, r"<(\\*)([|r])", r"<$1\\$2"), F.lit("\n"), F.lit("<r"))


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(role, F.lit("<r"), F.lit("\n")), r"<\\(\\*)([|r])", r"<$1$2")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, or NULL where it isn't a sentence of the grammar.

    Deterministic: a turn begins at every start mark, its role ends at the first line feed, and
    its text at the first end mark, which only a line feed may follow.
    """
    pieces = F.split(formatted, r"<\|im_start\|>")

    def turn(piece: Column) -> Column:
        body = F.substring_index(piece, END, 1)
        head = F.substring_index(body, "\n", 1)
        sound = (piece == F.concat(body, F.lit(f"{END}\n"))) & F.contains(body, F.lit("\n"))
        text = F.substr(body, F.length(head) + 2)
        return F.when(sound, F.struct(unescape_role(head).alias("role"), unescape(text).alias("text")))

    turns = F.transform(F.slice(pieces, 2, F.size(pieces)), turn)
    return F.when(F.startswith(formatted, F.lit(START)) & ~F.exists(turns, F.isnull), turns.cast(_TURN))


def _plain(role: Column, text: Column) -> Column:
    return F.array(F.struct(role.alias("role"), text.alias("text"))).cast(_TURN)


def _rendered(turn: Column) -> Column:
    """The first of the plain and the escaped form that the parser reads back as the source."""
    source = _plain(turn["role"], turn["text"])
    plain = render(turn["role"], turn["text"])
    half = render(turn["role"], escape(turn["text"]))
    full = render(escape_role(turn["role"]), escape(turn["text"]))

    def recovered(form: Column) -> Column:
        return F.coalesce(parse(form) == source, F.lit(False))

    return let(
        plain,
        lambda a: F.when(recovered(a), a).otherwise(let(half, lambda b: F.when(recovered(b), b).otherwise(full))),
    )


def loss_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in their order: ``formatted`` cut along the runs."""
    first = F.array(F.lit(1).cast("bigint"))
    starts = F.aggregate(mask, first, lambda at, run: F.concat(at, F.array(F.element_at(at, -1) + run["chars"])))

    def cut(at: Column) -> Column:
        placed = F.filter(F.zip_with(mask, at, lambda run, start: F.struct(run.alias("run"), start.alias("start"))), _under_loss)
        return F.transform(
            placed, lambda p: unescape(F.substr(formatted, p["start"].cast("int"), p["run"]["chars"].cast("int")))
        )

    return let(starts, cut)


def _under_loss(placed: Column) -> Column:
    return F.coalesce(placed["run"]["loss"], F.lit(False))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation from rows ``conv_id, turn, role, text``.

    Returns ``conv_id, formatted, turns`` (role and text, read back from ``formatted``) and
    ``mask``, runs ``(chars, loss)`` that cover ``formatted``; the loss runs are the assistants'
    texts. Every turn is rendered, parsed again and compared with its source; where they differ,
    its text, and if need be its role, is escaped. The whole conversation is parsed again at the
    end, and the job fails rather than return one that isn't read back as it was.

    A NULL role or text counts as empty. Turns are ordered by number (NULL first), then role, then
    text, so ties and repeated rows (which stay) have one order. Rows with a NULL ``conv_id`` are
    one conversation. Other columns are ignored. An empty table gives no conversations. A
    conversation becomes one text, so its turns do meet in one task.
    """
    empty = F.lit("")
    kept = turns.select(
        "conv_id",
        F.struct(
            "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
        ).alias("turn"),
    )
    whole = kept.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("source"))
    rendered = whole.select("conv_id", "source", F.transform("source", _rendered).alias("parts"))
    formatted = rendered.select("conv_id", "source", "parts", F.array_join("parts", "").alias("formatted"))
    read = formatted.select("*", parse(F.col("formatted")).alias("turns"))
    source = F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).cast(_TURN)
    checked = F.when(F.coalesce(F.col("turns") == source, F.lit(False)), F.col("turns")).otherwise(
        F.raise_error(F.concat(F.lit("not read back: conversation "), F.coalesce(F.col("conv_id").cast("string"), empty)))
    )

    def runs(part: Column, turn: Column) -> Column:
        head = F.length(F.substring_index(part, "\n", 1)) + 1
        tail = len(END) + 1
        run = lambda chars, loss: F.struct(chars.cast("bigint").alias("chars"), loss.alias("loss"))
        return F.array(
            run(head, F.lit(False)),
            run(F.length(part) - head - tail, turn["role"] == "assistant"),
            run(F.lit(tail), F.lit(False)),
        )

    return read.select(
        "conv_id",
        "formatted",
        checked.alias("turns"),
        F.flatten(F.zip_with("parts", "source", runs)).alias("mask"),
    )
