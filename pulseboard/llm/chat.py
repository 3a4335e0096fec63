"""Chat formatting: a finite-state machine over roles, a declarative template, loss flags per segment.

A template names the strings around each turn, which roles are trained on, and which roles may follow which.
Control strings inside a text are escaped reversibly: every ``<``, any backslashes, ``|`` gets one backslash
more, so an escaped text never holds ``<|`` and the formatted text parses back without doubt.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Template:
    """``follows``: role -> roles that may come next (``start``: before the first turn)."""

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})


CHATML = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role(role: Column) -> Column:
    """A role on one line: backslashes and line ends are escaped."""
    r = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(r)


def _unrole(role: Column) -> Column:
    r = F.replace(unescape(role), F.lit("\\\\"), F.lit("\\\x00"))
    return F.replace(F.replace(r, F.lit("\\n"), F.lit("\n")), F.lit("\\\x00"), F.lit("\\"))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 template: Template = CHATML) -> DataFrame:
    """One row per conversation: conv, ``formatted``, ``segments`` (array of text, loss), ``n_turns``, ``valid``, ``error_turn``.

    The segments joined are ``formatted``; only a loss role's own text has ``loss`` set.  The automaton's
    state after a turn is that turn's role, so a step is legal if the role may follow the one before; ``error_turn`` is the
    first illegal step (0-based; the number of turns if the conversation ends on a turn that is not trained on),
    else null, and ``valid`` tells whether there is none.  Invalid conversations are formatted too.
    Turns are ordered by turn (nulls first), then role and text, so ties and repeated rows are ordered alike on every run;
    each repeated row is a turn.  Null role and text count as empty, rows with a null conversation are one conversation;
    an empty table gives no rows; other columns are ignored.  A conversation is one output row, so its turns meet in one row; nothing larger does.
    """
    t = turns.select(
        F.col(f"`{conv}`").alias("__op_conv"), F.col(f"`{turn}`").alias("__op_turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("__op_role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__op_text"))
    g = t.groupBy("__op_conv").agg(F.sort_array(F.collect_list(F.struct(
        F.coalesce(F.col("__op_turn").cast("long"), F.lit(-(2**63))).alias("turn"),
        F.col("__op_role").alias("role"), F.col("__op_text").alias("text")))).alias("__op_turns"))
    loss = lambda x: x["role"].isin(*template.loss_roles) if template.loss_roles else F.lit(False)
    seg = lambda s, flag: F.struct(s.alias("text"), flag.alias("loss"))
    parts = F.transform("__op_turns", lambda x: F.array(
        seg(F.concat(F.lit(template.opening), _role(x["role"]), F.lit(template.after_role)), F.lit(False)),
        seg(escape(x["text"]), loss(x)),
        seg(F.lit(template.closing), F.lit(False))))
    edges = [f"{a}>{b}" for a, after in template.follows.items() if a != START for b in after]
    starts = template.follows.get(START, ())
    one_of = lambda c, values: c.isin(*values) if values else F.lit(False)
    roles = F.transform("__op_turns", lambda x: x["role"])
    g = g.select("__op_conv", F.size("__op_turns").cast("long").alias("n_turns"), F.flatten(parts).alias("segments"), roles.alias("__op_roles"))
    steps = F.transform("__op_roles", lambda r, k: F.when(k == 0, one_of(r, starts)).otherwise(
        one_of(F.concat(F.get("__op_roles", k - 1), F.lit(">"), r), edges)))
    bad = F.array_position(steps, False) - 1
    last = F.element_at("__op_roles", -1)
    error = F.when(bad >= 0, bad).when(~one_of(last, template.loss_roles), F.col("n_turns"))
    return g.select(F.col("__op_conv").alias(conv), F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    "segments", "n_turns", error.alias("error_turn")).withColumn("valid", F.col("error_turn").isNull())


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, in order, unescaped segment by segment."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def parse_chat(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    turns = F.filter(F.split(formatted, "\\Q" + template.closing + "\\E"), lambda x: x != "")
    body = lambda x: F.substring(x, F.lit(len(template.opening) + 1), F.length(x))
    cut = lambda x: F.instr(x, F.lit(template.after_role))
    return F.transform(F.transform(turns, body), lambda x: F.struct(
        _unrole(F.substring(x, F.lit(1), cut(x) - 1)).alias("role"),
        unescape(F.substring(x, cut(x) + len(template.after_role), F.length(x))).alias("text")))
