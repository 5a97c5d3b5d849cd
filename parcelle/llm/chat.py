"""Chat formatting by a finite-state machine (DataFrame functions only).

A declarative ``Template`` says how a turn is written and which roles carry the
loss; ``TURN_ORDER`` is the machine's transition table.  The output of a
conversation is a list of segments (text, loss flag) whose concatenation is the
formatted text.  Control strings inside a text are escaped, and ``read_back``
undoes it.

Defined results: turns go by ``turn``, nulls first, ties by role, then text;
repeated rows are turns of their own; a null role or text counts as empty; a
conversation whose order breaks the machine is formatted all the same and
marked (``valid`` false, ``bad_turn`` the first offending place, from 0); a null
conv_id is a conversation; an empty table gives none.  A conversation is one
value of the output (its digest is over its whole text), so its turns meet in
one row: memory follows the longest conversation, as with any long text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: state, role -> next state; anything else is a fault.
TURN_ORDER = {
    ("start", "system"): "system", ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
}
END_STATES = ("assistant",)


@dataclass(frozen=True)
class Template:
    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: In texts, in this order; every escape is a backslash and one letter, and
    #: a backslash itself is escaped first, so reading back is exact.
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\s"), ("<|", "<\\p"))
    role_escapes: tuple[tuple[str, str], ...] = (("\n", "\\n"),)
    order: dict = field(default_factory=lambda: dict(TURN_ORDER))


TEMPLATE = Template()


def escape(c: Column, pairs) -> Column:
    for plain, coded in pairs:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column, pairs) -> Column:
    for plain, coded in reversed(pairs):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def format_conversations(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, segments array<struct<text, loss>>, formatted, valid, bad_turn)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    role_pairs = template.escapes + template.role_escapes
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit(template.open), escape(t["role"], role_pairs), F.lit(template.after_role)).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(t["text"], template.escapes).alias("text"), t["role"].isin(list(template.loss_roles)).alias("loss")),
        F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")))))
    table = F.create_map(*[F.lit(x) for (state, r), to in template.order.items() for x in (f"{state}\n{r}", to)])
    # the machine: a state, the place in the list, the first fault
    begin = F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(a: Column, t: Column) -> Column:
        to = F.element_at(table, F.concat(a["state"], F.lit("\n"), t["role"]))
        return F.struct(F.coalesce(to, t["role"]).alias("state"), (a["at"] + 1).alias("at"),
                        F.coalesce(a["bad"], F.when(to.isNull(), a["at"])).alias("bad"))

    conv = conv.withColumn("segments", segments).withColumn("fsm", F.aggregate("turns", begin, step))
    return conv.select("conv_id", "segments", F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
                       (F.col("fsm.bad").isNull() & F.col("fsm.state").isin(list(END_STATES))).alias("valid"),
                       F.col("fsm.bad").alias("bad_turn"))


def read_back(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns (role, text) of a formatted text, exactly as they went in."""
    q = "\\Q" + template.close + "\\E"
    pieces = F.split(formatted, q, -1)
    body = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    role_pairs = template.escapes + template.role_escapes

    def turn(p: Column) -> Column:
        p = F.substr(p, F.lit(len(template.open) + 1))
        head = F.substring_index(p, template.after_role, 1)
        return F.struct(unescape(head, role_pairs).alias("role"),
                        unescape(F.substr(p, F.length(head) + F.lit(len(template.after_role) + 1)), template.escapes).alias("text"))

    return F.transform(body, turn)


def loss_text(segments: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss mask, as it went in."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template.escapes)))


def chat_digests(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Contract columns, read back from the formatted output."""
    out = format_conversations(turns, template)
    out = out.withColumn("back", read_back(F.col("formatted"), template)).withColumn("loss", loss_text(F.col("segments"), template))
    said = F.concat_ws("", F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return out.select("conv_id", F.size("back").cast("long").alias("n_turns"),
                      F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "valid", "bad_turn")
