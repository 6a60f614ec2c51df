"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records arrive in unlike layouts (prompt/response, instruction/input/output,
message lists), as JSON or in columns of their own.  A record's nested field
paths are hashed; the hash selects a declarative mapping, which says where roles
and texts stand and turns the record into canonical turns
``array<struct<role, text>>``.  The turns are rendered with a marked template
whose control strings are escaped reversibly inside texts, together with the
spans that the loss covers.

Spark's JSON parsers give null for a string of more than 20,000,000 characters.
Records in columns never pass through them: only their skeleton does, all texts
emptied.  A JSON record with such a string has no layout, hence null turns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from siftworks.llm.common import starts_of

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"
def fingerprint(record: Column) -> Column:
    """Hash of a JSON record's nested field paths.

    Scalars of every type count alike, so a number where others have a string,
    or a null, does not make a new layout; array elements are merged.  Broken
    JSON and null have no fingerprint (null).
    """
    return F.sha2(paths(record), 256)


def paths(record: Column) -> Column:
    """The layout that :func:`fingerprint` hashes, as text."""
    shape = F.schema_of_variant(F.try_parse_json(record))
    return F.regexp_replace(shape, r"(?<=: |ARRAY<|^)(STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|VARIANT|DECIMAL\(\d+,\d+\)|DATE|TIMESTAMP(_NTZ)?|BINARY)(?=[,>]|$)", "_")


def mapping_key(example: str) -> Column:
    """Fingerprint of an example record, as a constant expression."""
    return fingerprint(F.lit(example))


def skeleton(value: Column, kind: DataType) -> Column:
    """A value in columns with all its scalars emptied: its layout, whatever the
    length of its texts.  Nulls stay null, elements that are alike stand once."""
    if isinstance(kind, StructType):
        shown: Column = F.struct(*[skeleton(value[f.name], f.dataType).alias(f.name) for f in kind])
    elif isinstance(kind, ArrayType):
        shown = F.array_distinct(F.transform(value, lambda x: skeleton(x, kind.elementType)))
    else:
        shown = F.lit("")
    return F.when(value.isNotNull(), shown)


@dataclass(frozen=True)
class Listed:
    """Turns in a list; ``names`` gives roles that are called otherwise."""

    turns: str
    role: str
    text: str
    names: Mapping[str, str] = field(default_factory=dict)

    def of_json(self, record: Column) -> Column:
        kind = f"array<struct<`{self.role}`:string,`{self.text}`:string>>"
        return self.of_list(F.from_json(F.get_json_object(record, f"$.{self.turns}"), kind))

    def of_columns(self, record: Column, kind: StructType) -> Column | None:
        if self.turns not in kind.names or not isinstance(kind[self.turns].dataType, ArrayType) or not {self.role, self.text} <= set(getattr(kind[self.turns].dataType.elementType, "names", ())):
            return None
        return self.of_list(record[self.turns])

    def of_list(self, turns: Column) -> Column:
        def role(x: Column) -> Column:
            out = x
            for said, meant in self.names.items():
                out = F.when(x == said, meant).otherwise(out)
            return out

        return F.transform(turns, lambda t: turn(role(t[self.role].cast("string")), t[self.text].cast("string")))


@dataclass(frozen=True)
class Exchange:
    """Turns in fields of their own: role, and the fields whose texts, less the
    empty ones after the first, make its turn with a blank line between."""

    turns: tuple[tuple[str, tuple[str, ...]], ...]

    def of_json(self, record: Column) -> Column:
        return self.of_fields(lambda name: F.get_json_object(record, f"$.{name}"))

    def of_columns(self, record: Column, kind: StructType) -> Column | None:
        if not {n for _, names in self.turns for n in names} <= set(kind.names):
            return None
        return self.of_fields(lambda name: record[name].cast("string"))

    def of_fields(self, of) -> Column:
        def told(names: tuple[str, ...]) -> Column:
            first, *rest = names
            return F.concat_ws("\n\n", of(first), *[F.nullif(of(n), F.lit("")) for n in rest]) if rest else of(first)

        return F.array(*[turn(F.lit(role), told(names)) for role, names in self.turns])


def turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


#: Example record of a layout -> where its turns are.
MAPPINGS: dict[str, Listed | Exchange] = {
    '{"messages":[{"role":"","text":""}]}': Listed("messages", "role", "text"),
    '{"messages":[{"content":"","role":""}]}': Listed("messages", "role", "content"),
    '{"conversations":[{"from":"","value":""}]}': Listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    '{"prompt":"","response":""}': Exchange((("user", ("prompt",)), ("assistant", ("response",)))),
    '{"prompt":"","response":"","system":""}': Exchange((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    '{"prompt":"","completion":""}': Exchange((("user", ("prompt",)), ("assistant", ("completion",)))),
    '{"instruction":"","output":""}': Exchange((("user", ("instruction",)), ("assistant", ("output",)))),
    '{"instruction":"","input":"","output":""}': Exchange((("user", ("instruction", "input")), ("assistant", ("output",)))),
}


def canonical_turns(df: DataFrame, *, id_col: str = "conv_id", record_col: str = "record", mappings: Mapping[str, Listed | Exchange] | None = None) -> DataFrame:
    """conv_id, layout (fingerprint), turns, of records as JSON text or, where the
    column is a struct, in columns, of which a null one is a field that the
    record has not got.

    turns is null for an unknown layout, JSON that is broken or has a string
    above the parsers' limit, or a null record.  A null role or text is empty.
    """
    kind = df.schema[record_col].dataType
    native = isinstance(kind, StructType)
    record = F.col(f"`{record_col}`")
    rows = df.select(F.col(f"`{id_col}`").alias("conv_id"), (record if native else record.cast("string")).alias("record"))
    shape = F.to_json(skeleton(F.col("record"), kind)) if native else F.col("record")
    rows = rows.withColumn("layout", fingerprint(shape))
    turns = F.lit(None).cast(TURNS)
    for example, mapping in (MAPPINGS if mappings is None else mappings).items():
        found = mapping.of_columns(F.col("record"), kind) if native else mapping.of_json(F.col("record"))
        if found is not None:
            turns = F.when(F.col("layout") == mapping_key(example), found).otherwise(turns)
    whole = F.transform(turns, lambda t: turn(F.coalesce(t["role"], F.lit("")), F.coalesce(t["text"], F.lit(""))))
    return rows.select("conv_id", "layout", whole.alias("turns"))


def records_of_rows(df: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows by turn -> conv_id, record, in columns: of a user's and an assistant's
    turn a prompt and its response, of these after a system's turn all three, of
    any other turns a list of messages.

    Turns go by number (null first); rows with equal numbers by role, then
    text; repeated rows stay.  A conversation is one value of the result, so
    its turns meet in one row by the nature of the output.  Rows without a
    conversation's id belong to none: each is a conversation of its own, with
    a null id.
    """
    one = F.struct(
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    lone = F.when(F.col(f"`{id_col}`").isNull(), F.monotonically_increasing_id())
    rows = df.select(F.col(f"`{id_col}`").alias("conv_id"), lone.alias("lone"), one.alias("t"))
    listed = rows.groupBy("conv_id", "lone").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    asked = F.array_join("ts.role", ",") == "user,assistant"
    told = F.array_join("ts.role", ",") == "system,user,assistant"
    text = lambda i: F.get("ts", i)["text"]
    messages = F.transform("ts", lambda t: turn(t["role"], t["text"]))
    # a role with a comma may look like two: the number of turns tells
    asked, told = asked & (F.size("ts") == 2), told & (F.size("ts") == 3)
    record = F.struct(
        F.when(~asked & ~told, messages).alias("messages"),
        F.when(told, text(F.lit(0))).alias("system"),
        F.when(asked, text(F.lit(0))).when(told, text(F.lit(1))).alias("prompt"),
        F.when(asked, text(F.lit(1))).when(told, text(F.lit(2))).alias("response"),
    )
    return listed.select("conv_id", record.alias("record"))


def escape(text: Column) -> Column:
    """A text without control strings: every ``<|``, however many backslashes
    stand between, gets one backslash more; all else stays as it is."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role on one line, without control strings."""
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(turns: DataFrame, *, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans (array<struct<start,end>>, code points of
    ``formatted``, end exclusive, one for each text of ``loss_role``).

    Null turns format as the empty string.
    """
    parts = F.transform(
        F.coalesce(F.col("turns"), F.array().cast(TURNS)),
        lambda t: F.struct(
            F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == loss_role).alias("loss"),
        ),
    )
    tail = END + "\n"
    rows = turns.select("conv_id", parts.alias("parts"))
    whole = F.transform("parts", lambda p: F.length(p["head"]) + F.length(p["body"]) + len(tail))

    def span(p: Column, at: Column) -> Column:
        start = at + F.length(p["head"])
        return F.struct(start.alias("start"), (start + F.length(p["body"])).alias("end"), p["loss"].alias("loss"))

    spans = F.filter(F.zip_with("parts", starts_of(whole), span), lambda s: s["loss"])
    return rows.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "").alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda b: F.length(b) > 0)

    def turn(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substr(block, F.length(role) + 2, F.length(block) - F.length(role) - 1 - len(END) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(blocks, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
