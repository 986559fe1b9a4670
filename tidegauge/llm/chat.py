"""Chat formatting by schema fingerprints.

A record is a VARIANT. The paths of its nested fields, without their value types, are hashed into a
fingerprint; fields that are declared to hold no turn (an id, a source) are left out of it. Declared layouts are
hashed the same way, and the layout with the same fingerprint says which paths hold the turns. Prompt, instruction and message records thus become the same array of
(role, text). `render` writes them in a marked-up template in which control strings inside texts are
escaped reversibly, and says which spans are trained on; `read_back` parses the result.
"""

from __future__ import annotations

import dataclasses
import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The template's control strings.
START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
CLOSE = END + "\n"
TRAINED_ROLE = "assistant"
# Single-valued fields that a record or a message may have beside its layout.
EXTRAS = ("id", "name", "source", "timestamp", "weight")

_TURNS = "array<struct<role:string,text:string>>"


@dataclasses.dataclass(frozen=True)
class Layout:
    """How one record layout maps to turns.

    paths: the record's shape as `schema_of_variant` prints it, with every value type as `_` and without EXTRAS.
    fields: (role, path) pairs for a record with one field per turn; null fields are no turns.
    items, role, text: for a record with an array of turns, its path and the names inside.
    aliases: (name in the record, canonical role) pairs.
    """

    name: str
    paths: Sequence[str]
    fields: Sequence[tuple[str, str]] = ()
    items: str | None = None
    role: str = "role"
    text: str = "content"
    aliases: Sequence[tuple[str, str]] = ()


_SHARED_ROLES = (("human", "user"), ("gpt", "assistant"))

LAYOUTS = (
    Layout("prompt", ("OBJECT<completion: _, prompt: _>",), (("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("prompt", ("OBJECT<prompt: _, response: _>",), (("user", "$.prompt"), ("assistant", "$.response"))),
    Layout(
        "instruction",
        ("OBJECT<input: _, instruction: _, output: _>", "OBJECT<instruction: _, output: _>"),
        (("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Layout(
        "messages",
        ("OBJECT<messages: ARRAY<OBJECT<content: _, role: _>>>", "OBJECT<messages: ARRAY<_>>"),
        items="$.messages"),
    Layout(
        "shared", ("OBJECT<conversations: ARRAY<OBJECT<from: _, value: _>>>",),
        items="$.conversations", role="from", text="value",
        aliases=_SHARED_ROLES),
)


def _digest(path: str) -> str:
    return hashlib.sha256(path.encode()).hexdigest()


def fingerprint(record: Column) -> Column:
    """Hash of a record's nested field paths, EXTRAS left out where they hold a single value; null for a null
    record."""
    shape = F.schema_of_variant(record)
    bare = F.regexp_replace(shape, r"(: |ARRAY<)(?:[A-Z]+(?:\([0-9, ]*\))?)(?=[,>])", "$1_")
    extra = f"(?:{'|'.join(EXTRAS)}): _"
    fewer = F.regexp_replace(F.regexp_replace(bare, f"(?<=<){extra}, ", ""), f", {extra}(?=[,>])", "")
    return F.sha2(fewer, 256)


def canonical_turns(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """The turns of a record as an array of (role, text). Null texts become empty, null roles too; a
    record without a known layout gives null, so that it can be counted and is not lost."""
    key = fingerprint(record)
    chosen = F.lit(None).cast(_TURNS)
    for layout in reversed(layouts):
        known = key.isin([_digest(p) for p in layout.paths])
        chosen = F.when(known, _layout_turns(record, layout)).otherwise(chosen)
    return chosen


def layout_name(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    key = fingerprint(record)
    name = F.lit(None).cast("string")
    for layout in reversed(layouts):
        name = F.when(key.isin([_digest(p) for p in layout.paths]), F.lit(layout.name)).otherwise(name)
    return name


def _layout_turns(record: Column, layout: Layout) -> Column:
    if layout.items is None:
        each = [
            F.struct(F.lit(role).alias("role"), F.try_variant_get(record, path, "string").alias("text"))
            for role, path in layout.fields]
        return F.filter(F.array(*each), lambda t: t["text"].isNotNull()).cast(_TURNS)
    items = F.try_variant_get(record, layout.items, f"array<struct<`{layout.role}`:string,`{layout.text}`:string>>")

    def turn(item: Column) -> Column:
        role = F.coalesce(item[layout.role], F.lit(""))
        named = role
        for alias, canonical in layout.aliases:
            named = F.when(role == alias, F.lit(canonical)).otherwise(named)
        return F.struct(named.alias("role"), F.coalesce(item[layout.text], F.lit("")).alias("text"))

    return F.transform(items, turn)


def records_of_turns(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One record (conv_id, record) per conversation of a table with a row per turn. Turns are ordered by
    number, nulls first; equal numbers by role, then text; repeated rows are turns of their own. Rows
    without a conversation form one.

    A conversation becomes a record in the layout that is usual for its roles: one question and its answer are prompt
    and completion, with a system text before them an instruction; longer talks of users and assistants alone
    are shared conversations; all others, also those with a null role, are messages with an id. A null text is an
    empty one in all of them."""
    turn = F.struct(
        F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("content"))
    grouped = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    roles = F.transform("turns", lambda t: t["role"])

    def text(place: int) -> Column:
        return F.coalesce(F.get("turns", F.lit(place))["content"], F.lit(""))

    def are(*names: str) -> Column:
        return roles.eqNullSafe(F.array(*[F.lit(n) for n in names]))

    shared_names = {canonical: name for name, canonical in _SHARED_ROLES}
    shared = F.transform("turns", lambda t: F.struct(
        F.when(t["role"] == "user", shared_names["user"]).otherwise(shared_names["assistant"]).alias("from"),
        F.coalesce(t["content"], F.lit("")).alias("value")))
    messages = F.transform("turns", lambda t: F.struct(
        F.coalesce(t["content"], F.lit("")).alias("content"), t["role"].alias("role")))
    record = (
        F.when(are("user", "assistant"), _object(prompt=text(0), completion=text(1)))
        .when(are("system", "user", "assistant"), _object(instruction=text(0), input=text(1), output=text(2)))
        .when(F.forall(roles, lambda r: F.coalesce(r.isin("user", "assistant"), F.lit(False))), _object(conversations=shared))
        .otherwise(_object(id=F.col("conv_id").cast("string"), messages=messages)))
    return grouped.select("conv_id", record.alias("record"))


def _object(**fields: Column) -> Column:
    return F.to_variant_object(F.struct(*[value.alias(name) for name, value in fields.items()]))


def escape(text: Column) -> Column:
    """One more backslash between `<` and `|`, so that no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def render(turns: Column) -> Column:
    """The conversation in the template; a line break in a role becomes its own control string."""
    def one(t: Column) -> Column:
        role = F.replace(escape(t["role"]), F.lit("\n"), F.lit(LINE))
        return F.concat(F.lit(START), role, F.lit("\n"), escape(t["text"]), F.lit(CLOSE))

    return F.array_join(F.transform(turns, one), "")


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation, as (role, text, size): size is the length of the turn's
    markup, its start control string included."""
    pieces = F.split(formatted, re.escape(START), -1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(head) + 2, F.length(piece) - F.length(head) - 1 - len(CLOSE))
        return F.struct(
            unescape(F.replace(head, F.lit(LINE), F.lit("\n"))).alias("role"), unescape(body).alias("text"),
            (F.length(piece) + len(START)).cast("long").alias("size"),
            (F.length(head) + 1 + len(START)).cast("long").alias("head"),
            F.length(body).cast("long").alias("body"))

    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def format_conversations(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, layout, formatted and loss_spans of records. The loss mask covers the (escaped) texts of
    assistant turns, as (start, end) in code points of `formatted`. Records without a known layout keep
    their row, with nulls."""
    from tidegauge.llm.common import starts_of

    turns = records.select(
        "conv_id", layout_name(F.col("record"), layouts).alias("layout"),
        canonical_turns(F.col("record"), layouts).alias("turns"))
    shown = turns.select("conv_id", "layout", render(F.col("turns")).alias("formatted"))
    parsed = shown.withColumn("_parts", read_back(F.col("formatted")))
    placed = F.arrays_zip(
        F.col("_parts").alias("part"),
        F.when(F.size("_parts") > 0, starts_of(F.transform("_parts", lambda p: p["size"]))).alias("base"))
    trained = F.filter(placed, lambda z: z["part"]["role"] == TRAINED_ROLE)
    spans = F.transform(trained, lambda z: F.struct(
        (z["base"] + z["part"]["head"]).alias("start"),
        (z["base"] + z["part"]["head"] + z["part"]["body"]).alias("end")))
    return parsed.select("conv_id", "layout", "formatted", spans.alias("loss_spans"))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    each = F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return F.array_join(each, "")
