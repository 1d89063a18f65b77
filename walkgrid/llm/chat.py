"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written. ``begin`` opens a turn of a role and ``end`` closes it; both start with ``<|``. Roles without an
    entry of their own are written in hexadecimal. ``loss`` names the roles whose texts are trained on."""

    begin: dict[str, str] = field(default_factory=lambda: {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"})
    other: tuple[str, str] = ("<|role ", "|>\n")
    end: str = "<|end|>\n"
    loss: tuple[str, ...] = ("assistant",)


#: State and role to next state; no entry is an error. A conversation is complete in one of ``FINAL``.
TRANSITIONS = {
    ("start", "system"): "system",
    ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
}
FINAL = ("assistant",)
#: Openings of control strings, of this template and of other common ones; each is broken up after its first letter.
CONTROL = r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """Doubles backslashes and puts one behind the first letter of each control string; so no control string is left."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _begin(role: Column, template: Template) -> Column:
    known = F.create_map(*(F.lit(x) for pair in template.begin.items() for x in pair))
    return F.coalesce(F.element_at(known, role), F.concat(F.lit(template.other[0]), F.hex(F.encode(role, "UTF-8")), F.lit(template.other[1])))


def _state(roles: Column) -> Column:
    """State after all turns, or the error state for good."""
    table = F.create_map(*(F.lit(x) for (state, role), to in TRANSITIONS.items() for x in (f"{state}>{role}", to)))
    return F.aggregate(roles, F.lit("start"), lambda state, role: F.coalesce(F.element_at(table, F.concat(state, F.lit(">"), role)), F.lit("error")))


def format_chats(turns: DataFrame, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments`` (text and loss flag, in order; together they are ``formatted``),
    ``valid`` (the turn order is accepted) and ``complete`` (and ends where a conversation may).

    Turns are taken in order of their number; ties and repeated rows in order of role and text, each a turn of its own; null
    numbers come first. Null text and null role count as empty. Unknown roles are formatted and make the order invalid.
    Rows with a null id form one conversation. Invalid conversations are formatted all the same, so no row is lost. An empty
    table gives no rows; other columns are ignored. A conversation becomes one string, so its turns meet in one task.
    """
    row = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chats = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(F.array_sort(F.collect_list(row)).alias("turns"))

    def segments(t: Column) -> Column:
        part = lambda x, loss: F.struct(x.alias("text"), loss.alias("loss"))
        return F.array(part(_begin(t["role"], template), F.lit(False)), part(escape(t["text"]), t["role"].isin(*template.loss)), part(F.lit(template.end), F.lit(False)))

    out = chats.withColumn("segments", F.flatten(F.transform("turns", segments))).withColumn("_state", _state(F.transform("turns", lambda t: t["role"])))
    return out.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        (F.col("_state") != "error").alias("valid"),
        F.col("_state").isin(*FINAL).alias("complete"),
    )


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted conversation: an array of role and text as they were. Known roles go by their markers."""
    quoted = lambda s: "\\Q" + s + "\\E"
    opening = "|".join([*map(quoted, template.begin.values()), quoted(template.other[0]) + "[0-9A-F]*" + quoted(template.other[1])])
    pattern = F.lit(f"(?s)({opening})(.*?){quoted(template.end)}")
    markers, texts = F.regexp_extract_all(formatted, pattern, F.lit(1)), F.regexp_extract_all(formatted, pattern, F.lit(2))
    known = F.create_map(*(F.lit(x) for role, begin in template.begin.items() for x in (begin, role)))
    code = lambda m: F.substring(m, F.lit(len(template.other[0]) + 1), F.length(m) - len("".join(template.other)))
    role = lambda m: F.coalesce(F.element_at(known, m), F.decode(F.unhex(code(m)), "UTF-8"))
    return F.zip_with(markers, texts, lambda m, x: F.struct(role(m).alias("role"), unescape(x).alias("text")))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
