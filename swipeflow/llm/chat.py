"""Chat formatting with typed content parts (DataFrame functions only).

A conversation is a list of turns; a turn has a role and an ordered list of
content parts. ``visit_parts`` flattens the parts of a turn into one body: text
parts are escaped and copied, image, audio and document parts become ordered
placeholders. Each placeholder records an attachment reference and the number
of tokens that a model expands it to.

Template: ``<|im_start|>role<|im_sep|>body<|im_end|>`` per turn, nothing between
turns. Escaping: a backslash is doubled and ``<|`` becomes ``<\\|``, so control
strings cannot appear inside a role or body and ``\\x -> x`` undoes it.

Edge cases: a null role or text is empty; a null or empty part list gives an
empty body; null units give the base cost only; an unknown part type is
rendered as text; rows with equal (turn, role, body) are all kept; turns with
a null number come first; rows with a null conv_id form one conversation; an
empty table gives an empty result. Only the named columns are read, so extra
columns never clash.

A conversation is one output value, so its turns must meet in one row. Work
inside a row is linear in its length.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PART_TYPE = "array<struct<type:string,text:string,ref:string,n_units:bigint>>"
#: Tokens of a placeholder: base and per unit (image tiles, audio seconds, document pages).
TOKEN_COSTS: Mapping[str, tuple[int, int]] = {"image": (85, 170), "audio": (2, 25), "document": (8, 700)}


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A part list with one text part."""
    none = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), none.alias("ref"), F.lit(None).cast("long").alias("n_units")))


def is_attachment(part: Column, costs: Mapping[str, tuple[int, int]]) -> Column:
    return F.coalesce(part["type"].isin(*costs), F.lit(False))


def expanded_tokens(part: Column, costs: Mapping[str, tuple[int, int]]) -> Column:
    out = F.lit(0).cast("long")
    for kind, (base, per_unit) in costs.items():
        cost = F.lit(base).cast("long") + F.lit(per_unit) * F.coalesce(part["n_units"], F.lit(0))
        out = F.when(part["type"] == kind, cost).otherwise(out)
    return out


def visit_parts(parts: Column, costs: Mapping[str, tuple[int, int]] = TOKEN_COSTS) -> tuple[Column, Column]:
    """(body, attachments): the body text, and an array of
    struct(part, kind, ref, n_tokens) in placeholder order."""
    parts = F.coalesce(parts, F.array().cast(PART_TYPE))

    def render(p: Column) -> Column:
        return F.when(is_attachment(p, costs), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(escape(F.coalesce(p["text"], F.lit(""))))

    body = F.array_join(F.transform(parts, render), "")
    numbered = F.transform(parts, lambda p, i: F.struct(i.alias("part"), p.alias("p")))
    kept = F.filter(numbered, lambda x: is_attachment(x["p"], costs))
    attachments = F.transform(
        kept,
        lambda x: F.struct(x["part"].alias("part"), x["p"]["type"].alias("kind"), x["p"]["ref"].alias("ref"), expanded_tokens(x["p"], costs).alias("n_tokens")),
    )
    return body, attachments


def format_conversations(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    loss_roles: tuple[str, ...] = ("assistant",),
    costs: Mapping[str, tuple[int, int]] = TOKEN_COSTS,
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (turn index,
    start in code points from the turn's beginning, length), attachments (turn
    index, part, kind, ref, n_tokens) and n_attachment_tokens."""
    body, attachments = visit_parts(F.col(parts), costs)
    role_text = F.coalesce(F.col(role), F.lit(""))
    flat = rows.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            escape(role_text).alias("role"),
            body.alias("body"),
            role_text.isin(*loss_roles).alias("loss"),
            attachments.alias("attachments"),
        ).alias("t"),
    )
    turns = flat.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = len(START) + len(SEP)
    indexed = F.transform("turns", lambda t, i: F.struct(i.alias("i"), t.alias("t")))
    spans = F.transform(
        F.filter(indexed, lambda x: x["t"]["loss"]),
        lambda x: F.struct(
            x["i"].alias("turn"),
            (F.lit(head) + F.length(x["t"]["role"])).alias("start"),
            F.length(x["t"]["body"]).alias("length"),
        ),
    )
    refs = F.flatten(
        F.transform(
            indexed,
            lambda x: F.transform(
                x["t"]["attachments"],
                lambda a: F.struct(x["i"].alias("turn"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens")),
            ),
        )
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(START), t["role"], F.lit(SEP), t["body"], F.lit(END))), "")
    out = turns.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"), refs.alias("attachments"))
    return out.withColumn("n_attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, a: acc + a["n_tokens"]))


def _segments() -> Column:
    """Turns of ``formatted`` without their end marks."""
    cut = F.split("formatted", r"<\|im_end\|>", -1)
    return F.slice(cut, 1, F.size(cut) - 1)


def read_conversations(formatted: DataFrame, costs: Mapping[str, tuple[int, int]] = TOKEN_COSTS) -> DataFrame:
    """Parse the output back: conv_id, turns (role and text, unescaped, without
    placeholders) and loss_text (all text under the loss mask, in order)."""
    kinds = "|".join(costs)

    def plain(body: Column) -> Column:
        return unescape(F.regexp_replace(body, rf"<\|({kinds})\|>", ""))

    def turn_of(seg: Column) -> Column:
        cut = F.split(F.substr(seg, F.lit(len(START) + 1)), r"<\|im_sep\|>", -1)
        return F.struct(unescape(cut[0]).alias("role"), plain(cut[1]).alias("text"))

    parsed = formatted.withColumn("_segments", _segments())
    loss = F.transform("loss_spans", lambda s: plain(F.substr(F.element_at("_segments", s["turn"] + 1), s["start"] + 1, s["length"])))
    return parsed.select(
        "conv_id",
        F.transform("_segments", turn_of).alias("turns"),
        F.array_join(loss, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Digest of every conversation, computed from what ``read_conversations`` returns."""
    back = read_conversations(formatted)
    listing = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(listing, "utf-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode(F.col("loss_text"), "utf-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
