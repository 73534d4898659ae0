r"""Chat formatting: a finite-state machine over roles, and a declarative template that gives text segments with loss flags.

The template gives each role its opening and closing mark and says whether the role's text is under the loss.  Control
strings inside texts are escaped reversibly: a backslash is doubled, and ``\.`` goes after the first character of a control
string, so that no mark can be forged and nothing is lost.  Roles the template does not know keep their name inside a
generic mark.  The machine walks over the roles in turn order; its verdict (``valid``, and the first turn out of order) is a
column of the result, and conversations out of order are formatted all the same.  DataFrame functions only.

Defined cases: a null text or role counts as empty; turns are ordered by turn (null first), then role, then text, so
repeated rows and ties are all kept; a null conversation id is a conversation of its own; an empty table gives an empty result.
A conversation is one row of the result, so its turns meet in one task and its formatted text is one value: at most 2 GB.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Any string that marks something in this template, as a Java pattern; its first character is captured.
CONTROL = r"([<\[])(?=/?s>|</?SYS>>|/?INST\]|/?ROLE[ \]])"


@dataclass(frozen=True)
class Template:
    begin: str = "<s>"
    #: role: opening mark, closing mark, under the loss
    turns: dict[str, tuple[str, str, bool]] = field(
        default_factory=lambda: {"system": ("<<SYS>>\n", "\n<</SYS>>\n\n", False), "user": ("[INST] ", " [/INST]", False), "assistant": (" ", "</s>", True)}
    )
    #: opening mark before and after the name, and closing mark, of any other role
    other: tuple[str, str, str] = ("[ROLE ", "]", "[/ROLE]")
    #: state: role: next state; what is missing leads to "error"
    machine: dict[str, dict[str, str]] = field(
        default_factory=lambda: {"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"}, "assistant": {"user": "user"}}
    )
    accept: tuple[str, ...] = ("assistant",)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\.")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\)|\\\.", "$1")


def _escape_name(role: Column) -> Column:
    """A role's name inside its mark: besides, a closing bracket must not end the mark."""
    return F.regexp_replace(escape(role), r"\]", r"\\.)")


def format_chats(rows: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, segments (array of text, loss), formatted, valid, first_bad (index from 0, else null)."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    chats = rows.select(F.col(conv_col).alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        def piece(text: Column, loss: bool) -> Column:
            return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

        before, after, close = template.other
        out = F.array(piece(F.concat(F.lit(before), _escape_name(t["role"]), F.lit(after)), False), piece(escape(t["text"]), False), piece(F.lit(close), False))
        for role, (opening, closing, loss) in template.turns.items():
            out = F.when(t["role"] == role, F.array(piece(F.lit(opening), False), piece(escape(t["text"]), loss), piece(F.lit(closing), False))).otherwise(out)
        return out

    def step(acc: Column, t: Column) -> Column:
        after = F.lit("error")
        for state, moves in template.machine.items():
            for role, to in moves.items():
                after = F.when((acc["state"] == state) & (t["role"] == role), F.lit(to)).otherwise(after)
        bad = F.when(acc["bad"].isNull() & (after == "error"), acc["at"]).otherwise(acc["bad"])
        return F.struct(after.alias("state"), (acc["at"] + 1).alias("at"), bad.alias("bad"))

    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))
    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    return (
        chats.withColumn("walk", F.aggregate("turns", start, step))
        .withColumn("segments", F.concat(begin, F.flatten(F.transform("turns", segments))))
        .select(
            "conv_id",
            "segments",
            F.concat_ws("", F.col("segments.text")).alias("formatted"),
            F.col("walk.state").isin(*template.accept).alias("valid"),
            F.col("walk.bad").alias("first_bad"),
        )
    )


def _quoted(mark: str) -> str:
    return "".join("\\" + c if c in r"\[](){}.*+?^$|/<>" else {"\n": r"\n"}.get(c, c) for c in mark)


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """The turns (array of role, text) that a formatted conversation says."""
    before, after, close = template.other
    forms = [_quoted(opening) + r"[\s\S]*?" + _quoted(closing) for opening, closing, _ in template.turns.values()]
    pattern = "|".join([*forms, _quoted(before) + r"[\s\S]*?" + _quoted(close)])
    body = F.substring(formatted, len(template.begin) + 1, 2**31 - 1)

    def turn(t: Column) -> Column:
        inner = F.substring(t, len(before) + 1, 2**31 - 1)
        name = F.substring_index(inner, after, 1)
        text = inner.substr(F.length(name) + len(after) + 1, F.length(inner) - F.length(name) - len(after) - len(close))
        out = F.struct(unescape(F.regexp_replace(name, r"(?<!\\)((?:\\\\)*)\\\.\)", "$1]")).alias("role"), unescape(text).alias("text"))
        for role, (opening, closing, _) in template.turns.items():
            said = t.substr(F.lit(len(opening) + 1), F.length(t) - len(opening) - len(closing))
            out = F.when(t.startswith(opening), F.struct(F.lit(role).alias("role"), unescape(said).alias("text"))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), turn)


def loss_texts(segments: Column) -> Column:
    """The texts under the loss, unescaped, in order."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"]))
