"""Chat formatting (operator 9): a finite-state machine over roles and a declarative template, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Template:
    """How turns are written and which role may follow which; "" is the state before the first turn."""

    open: str = "<|im_start|>"
    role_end: str = "\n"
    close: str = "<|im_end|>"
    turn_end: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )
    final: tuple[str, ...] = ("user", "assistant")


CHATML = Template()

#: Written in this order and read back in the other; "<|" starts every control string, so no text holds one.
ESCAPES = (("&", "&amp;"), ("<|", "&lt;|"))


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _role_text(role: Column) -> Column:
    """A role's line end would end its header, so it is escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _read_role(text: Column) -> Column:
    return unescape(F.replace(text, F.lit("&#10;"), F.lit("\n")))


def segments(conversations: DataFrame, template: Template = CHATML, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0), role, header, body, footer (formatted text), loss (is `body` trained on), legal (may the role follow the one before), start (code points before `body` in the conversation).

    Turns are ordered by turn, then role and text (nulls first), so repeated rows and ties give the same result in any run.
    A null text or role is empty; rows with a null conversation id form one conversation; other columns are left out.
    A role that no state of the machine knows is written like any other and is never legal.
    """
    turns = conversations.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, after in template.follows.items() for b in after])
    written = turns.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("turn_no"),
        "role",
        F.concat(F.lit(template.open), _role_text(F.col("role")), F.lit(template.role_end)).alias("header"),
        escape(F.col("text")).alias("body"),
        F.lit(template.close + template.turn_end).alias("footer"),
        F.col("role").isin(*template.loss_roles).alias("loss"),
        F.array_contains(steps, F.struct(F.lag("role", 1, "").over(order).alias("a"), F.col("role").alias("b"))).alias("legal"),
    )
    width = F.length("header") + F.length("body") + F.length("footer")
    before = F.sum(width).over(Window.partitionBy("conv_id").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, -1))
    return written.withColumn("start", (F.coalesce(before, F.lit(0)) + F.length("header")).cast("long"))


def format_chats(conversations: DataFrame, template: Template = CHATML, **columns: str) -> DataFrame:
    """One row per conversation: conv_id, formatted, spans (array of role, start, length, loss; in code points of `formatted`; header and footer belong to no loss), valid, error_turn (first turn that the machine refuses, null if none).

    A conversation is valid if each role may follow the one before it and the last role is a final one.
    An empty table gives an empty result. A conversation's turns meet in one row, as its formatted text must.
    """
    parts = F.array_sort(F.collect_list(F.struct("turn_no", "role", "header", "body", "footer", "loss", "legal", "start")))
    by_conv = segments(conversations, template, **columns).groupBy("conv_id").agg(parts.alias("parts"))
    bad = F.filter("parts", lambda p: ~p.legal)
    return by_conv.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p.header, p.body, p.footer)), "").alias("formatted"),
        F.transform("parts", lambda p: F.struct(p.role.alias("role"), p.start.alias("start"), F.length(p.body).cast("long").alias("length"), p.loss.alias("loss"))).alias("spans"),
        ((F.size(bad) == 0) & F.element_at("parts", -1).role.isin(*template.final)).alias("valid"),
        F.when(F.size(bad) > 0, F.element_at(bad, 1).turn_no).alias("error_turn"),
    )


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The turns of a formatted text as an array of (role, text), unescaped."""
    pieces = F.slice(F.split(formatted, _quoted(template.open)), 2, 2**30)
    head = lambda p: F.substring_index(p, template.role_end, 1)
    ending = template.close + template.turn_end

    def body(p: Column) -> Column:
        start = F.length(head(p)) + len(template.role_end)
        return F.substr(p, start + 1, F.length(p) - start - len(ending))

    return F.transform(pieces, lambda p: F.struct(_read_role(head(p)).alias("role"), unescape(body(p)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(spans, lambda s: s.loss), lambda s: unescape(F.substr(formatted, (s.start + 1).cast("int"), s.length.cast("int")))), "")


def _quoted(control: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != "_" else c for c in control)
