"""Chat formatting: a finite-state machine over roles and a declarative template, in native expressions.

``format_conversations`` turns one row per turn into one row per conversation:
the formatted text, its segments with a loss flag each, and whether the order
of the roles is valid. The machine reads the roles in order; the state that a turn
leads to says whether its text carries loss, and the last state whether the
conversation may end there. Out of order, it goes on in error states, which keep
the roles apart but never lead back. ``read_back`` parses the formatted text again,
which the escaping makes possible for any text.

Defined cases: a null or empty text is an empty turn; a null role is the empty
role (never valid); turns come by number, null numbers last, equal numbers by
role and text; repeated rows are turns of their own; rows of a null id form one
conversation; an empty table gives an empty result; other columns are not read.

A conversation becomes one row (its digest needs all of it in order), so one
task holds the turns of one conversation, and never more than that.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class ChatTemplate:
    """A turn is ``open + role + head_end + text + close``; its text carries loss if it leads to a state of ``loss_states``.

    The three markers start with "<" and hold no backslash. Inside roles and
    texts a backslash is doubled, and a marker gets one after its "<"; so no
    marker ever occurs there, and dropping each escape character restores them.
    """

    open: str = "<turn>"
    head_end: str = "<says>"
    close: str = "</turn>"
    loss_states: tuple[str, ...] = ("assistant", "error assistant")
    #: Role automaton: (state, role) -> state. Any other role leads to the state "error" + role.
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    #: States in which a conversation may end.
    accepting: tuple[str, ...] = ("assistant", "user")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.head_end, self.close)


TEMPLATE = ChatTemplate()


def escape(text: Column, template: ChatTemplate = TEMPLATE) -> Column:
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for control in template.controls:
        out = F.replace(out, F.lit(control), F.lit(control[0] + ESCAPE + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def states(roles: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """Run the automaton over an array of roles: the state after each turn."""
    table = F.create_map(*[F.lit(x) for x in chain(*((f"{s} {r}", t) for (s, r), t in template.transitions.items()))])

    def step(seen: Column, role: Column) -> Column:
        state = F.coalesce(F.try_element_at(seen, F.lit(-1)), F.lit("start"))
        return F.concat(seen, F.array(F.coalesce(table[F.concat(state, F.lit(" "), role)], F.concat(F.lit("error "), role))))

    return F.aggregate(roles, F.array().cast("array<string>"), step)


def format_conversations(
    turns: DataFrame, template: ChatTemplate = TEMPLATE, key: str = "conv_id"
) -> DataFrame:
    """One row per conversation: key, ``formatted``, ``segments`` (text, loss) and ``valid``."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    turn = F.struct(
        F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text")
    )
    convs = turns.groupBy(F.col(key)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    convs = convs.withColumn("states", states(F.col("turns.role"), template))
    parts = F.flatten(
        F.zip_with(
            "turns",
            "states",
            lambda t, state: F.array(
                F.struct(
                    F.concat(F.lit(template.open), escape(t["role"], template), F.lit(template.head_end)).alias("text"),
                    F.lit(False).alias("loss"),
                ),
                F.struct(escape(t["text"], template).alias("text"), state.isin(*template.loss_states).alias("loss")),
                F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    out = convs.select(key, F.element_at("states", -1).alias("end"), parts.alias("segments"))
    return out.select(
        key,
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        "segments",
        F.col("end").isin(*template.accepting).alias("valid"),
    )


def read_back(formatted: DataFrame, template: ChatTemplate = TEMPLATE, key: str = "conv_id") -> DataFrame:
    """Parse the formatted text: key, ``turns`` (role, text), the text under the loss mask, lengths."""
    pieces = F.split(F.col("formatted"), r"\Q" + template.close + r"\E", -1)
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)  # after the last marker comes nothing
    turns = F.transform(
        bodies,
        lambda b: F.struct(
            unescape(
                F.substring(F.substring_index(b, template.head_end, 1), len(template.open) + 1, 2**31 - 1)
            ).alias("role"),
            unescape(F.substring_index(b, template.head_end, -1)).alias("text"),
        ),
    )
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return formatted.select(
        key,
        turns.alias("turns"),
        F.array_join(masked, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def digest(parsed: DataFrame, key: str = "conv_id") -> DataFrame:
    """Counts and SHA-256 digests of what :func:`read_back` found."""
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        key,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        "formatted_chars",
        F.col("valid"),
    )
