"""Chat formatting: layouts are told by a fingerprint of their nested field paths.

A layout is declared by the paths that it consists of and by how turns are read from them. Of the paths of a table's schema,
or of a JSON record row by row, those of the fullest layout that they contain are hashed, and this fingerprint picks the
declarative mapping. More columns or fields therefore change nothing; of two layouts with equally many paths the one that
is declared first is taken. An empty list counts as having all fields of its items.

Formatted text marks turns with control strings. Texts may hold the same strings: every ``<``, run of backslashes, ``|``
inside a text gets one more backslash, and one less when it is read, so no text can end its turn and every text comes
back as it was. Roles are URL-encoded, as they share a line with the marks. The loss mask has one entry per turn: how
many code points of its formatted part to skip, to take and to skip again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """``paths`` with [] for arrays. Either ``items`` (array, role field, text field) or ``pairs`` of (role, columns)."""

    name: str
    paths: tuple[str, ...]
    items: tuple[str, str, str] | None = None
    pairs: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


#: Names that other tools give to the roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

LAYOUTS = (
    Layout("turns", ("turns[].role", "turns[].text"), items=("turns", "role", "text")),
    Layout("messages", ("messages[].content", "messages[].role"), items=("messages", "role", "content")),
    Layout(
        "conversations",
        ("conversations[].from", "conversations[].value"),
        items=("conversations", "from", "value"),
        roles=ROLE_NAMES,
    ),
    *(
        Layout(f"{ask}_{reply}", (ask, reply), pairs=(("user", (ask,)), ("assistant", (reply,))))
        for ask in ("prompt", "question", "instruction")
        for reply in ("response", "completion", "answer", "output")
    ),
    *(
        Layout(
            f"instruction_input_{reply}",
            ("instruction", "input", reply),
            pairs=(("user", ("instruction", "input")), ("assistant", (reply,))),
        )
        for reply in ("response", "output")
    ),
)


def _hash(paths: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Paths of all leaves, in any order; [] stands for the items of an array."""
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, prefix + "[]")
    if isinstance(kind, T.StructType):
        dot = "." if prefix else ""
        return [path for f in kind.fields for path in field_paths(f.dataType, f"{prefix}{dot}{f.name}")]
    return [prefix]


def fullest(paths: Sequence[str], layouts: Sequence[Layout] = LAYOUTS) -> Layout | None:
    """The layout with the most paths among those whose paths are all there; the first declared of equals."""
    held = set(paths)
    fitting = [layout for layout in layouts if held.issuperset(layout.paths)]
    return max(fitting, key=lambda layout: len(layout.paths), default=None)


def fingerprint(schema: T.StructType, layouts: Sequence[Layout] = LAYOUTS) -> str:
    """Hash of the schema's paths that make up its layout, or of all its paths if no layout fits."""
    paths = field_paths(schema)
    chosen = fullest(paths, layouts)
    return _hash(paths if chosen is None else chosen.paths)


def layout_of(schema: T.StructType, layouts: Sequence[Layout] = LAYOUTS) -> Layout:
    """The layout with the schema's fingerprint; an unknown one is an error that names the paths found."""
    chosen = {_hash(layout.paths): layout for layout in layouts}.get(fingerprint(schema, layouts))
    if chosen is None:
        raise ValueError(f"no layout for the paths {sorted(field_paths(schema))}")
    return chosen


def _role(name: Column, layout: Layout) -> Column:
    given = F.coalesce(name, F.lit(""))
    if not layout.roles:
        return given
    names = F.create_map(*[F.lit(x) for pair in layout.roles.items() for x in pair])
    return F.coalesce(F.try_element_at(names, given), given)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _turns(layout: Layout, array: Callable[[str, str, str], Column], column: Callable[[str], Column]) -> Column:
    if layout.items:
        items = F.coalesce(array(*layout.items), F.array().cast("array<struct<a:string,b:string>>"))
        return F.transform(items, lambda x: _turn(_role(x["a"], layout), x["b"]))
    said = []
    for role, names in layout.pairs:
        parts = [F.coalesce(column(name), F.lit("")) for name in names]
        # An empty input leaves no blank line behind.
        text = F.array_join(F.filter(F.array(*parts), lambda part: part != ""), "\n") if len(parts) > 1 else parts[0]
        said.append(_turn(F.lit(role), text))
    return F.array(*said)


def canonical_turns(records: DataFrame, key: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``key`` and ``turns`` of every record of a table in a known layout.

    Null arrays give no turns, null roles and texts are empty. Records are not grouped, so repeated keys stay.
    """
    layout = layout_of(records.drop(key).schema, layouts)

    def array(name: str, role: str, text: str) -> Column:
        items = F.filter(F.col(f"`{name}`"), lambda x: x.isNotNull())
        return F.transform(
            items, lambda x: F.struct(x[role].cast("string").alias("a"), x[text].cast("string").alias("b"))
        )

    turns = _turns(layout, array, lambda name: F.col(f"`{name}`").cast("string"))
    return records.select(F.col(f"`{key}`").alias(key), turns.cast(TURNS).alias("turns"))


def _shape(variant_schema: Column) -> Column:
    """The schema that Spark reports for a variant, without the types of its leaves."""
    return F.regexp_replace(variant_schema, r": (?!OBJECT|ARRAY)[A-Z]+(\([0-9,]+\))?", "")


def _record_paths(value: Column, layouts: Sequence[Layout]) -> Column:
    """The paths of a JSON object that layouts may ask for: its fields, and those of the items of the arrays they name."""
    fields = F.coalesce(F.map_keys(F.try_variant_get(value, "$", "map<string,variant>")), F.array().cast("array<string>"))
    parts = [fields]
    for name in dict.fromkeys(layout.items[0] for layout in layouts if layout.items):
        items = F.try_variant_get(value, f"$.{name}", "array<variant>")
        keys = F.flatten(
            F.transform(
                F.filter(items, lambda x: x.isNotNull()),
                lambda x: F.coalesce(
                    F.map_keys(F.try_variant_get(x, "$", "map<string,variant>")), F.array().cast("array<string>")
                ),
            )
        )
        every = [path for layout in layouts if layout.items and layout.items[0] == name for path in layout.paths]
        inside = F.transform(F.array_distinct(keys), lambda key: F.concat(F.lit(f"{name}[]."), key))
        known = F.when(F.size(items) == 0, F.array(*map(F.lit, dict.fromkeys(every)))).otherwise(inside)
        parts.append(F.coalesce(known, F.array().cast("array<string>")))
    return F.flatten(F.array(*parts))


def json_turns(records: DataFrame, key: str, text: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``key``, ``layout``, ``fingerprint`` and ``turns`` of JSON records whose layouts may differ row by row.

    Records that are no JSON or of no known layout get a null layout and null turns; their fingerprint, that of their whole
    shape, tells what to declare. Null lists give no turns.
    """
    value = F.col("_value")
    rows = records.select(F.col(f"`{key}`").alias(key), F.try_parse_json(F.col(f"`{text}`")).alias("_value"))
    rows = rows.withColumn("_paths", _record_paths(value, layouts))
    # Last assigned wins: layouts of few paths first, and of equally many the first declared last.
    chosen = F.sha2(_shape(F.schema_of_variant(value)), 256)
    for layout in sorted(reversed(layouts), key=lambda layout: len(layout.paths)):
        held = F.forall(F.array(*map(F.lit, layout.paths)), lambda path: F.array_contains(F.col("_paths"), path))
        chosen = F.when(held, F.lit(_hash(layout.paths))).otherwise(chosen)
    rows = rows.withColumn("fingerprint", chosen)
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:

        def array(name: str, role: str, said: str) -> Column:
            given = F.try_variant_get(value, f"$.{name}", "array<variant>")
            items = F.filter(given, lambda x: x.isNotNull() & ~F.is_variant_null(x))
            return F.transform(
                items,
                lambda x: F.struct(
                    F.try_variant_get(x, f"$.{role}", "string").alias("a"), F.try_variant_get(x, f"$.{said}", "string").alias("b")
                ),
            )

        fits = F.col("fingerprint") == _hash(layout.paths)
        name = F.when(fits, layout.name).otherwise(name)
        read = _turns(layout, array, lambda column: F.try_variant_get(value, f"$.{column}", "string"))
        turns = F.when(fits, read.cast(TURNS)).otherwise(turns)
    return rows.select(key, name.alias("layout"), "fingerprint", turns.alias("turns"))


def grouped_turns(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Records in the ``turns`` layout from a table with a row per turn (turn, role, text).

    Turns are ordered by number, equal numbers by role and text; a null key is a conversation of its own.
    """
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.groupBy(F.col(f"`{key}`").alias(key)).agg(F.sort_array(F.collect_list(said)).alias("said"))
    return grouped.select(key, F.transform("said", lambda x: F.struct(x["role"], x["text"])).alias("turns"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def formatted(records: DataFrame, key: str, learn: Sequence[str] = ("assistant",)) -> DataFrame:
    """``key``, ``formatted`` text and ``loss_mask`` of canonical turns; the text of ``learn`` roles is under the mask.

    Records without turns give an empty text and an empty mask, null turns null ones. Repeated keys have a row each.
    """

    def head(turn: Column) -> Column:
        return F.concat(F.lit(START), F.url_encode(turn["role"]), F.lit("\n"))

    def part(turn: Column) -> Column:
        return F.concat(head(turn), escaped(turn["text"]), F.lit(END))

    def mask(turn: Column) -> Column:
        skip, all_of = F.char_length(head(turn)), F.char_length(escaped(turn["text"]))
        take = F.when(turn["role"].isin(*learn), all_of).otherwise(0)
        return F.struct(skip.alias("skip"), take.alias("take"), (all_of - take + len(END)).alias("rest"))

    return records.select(
        key,
        F.array_join(F.transform("turns", part), "").alias("formatted"),
        F.transform("turns", mask).alias("loss_mask"),
    )


def parsed(output: DataFrame, key: str) -> DataFrame:
    """``key``, ``turns`` and ``loss`` (the unescaped texts under the mask, in order) read back from formatted rows.

    An empty text has no turns; a null one gives null turns. Repeated keys have a row each.
    """
    parts = F.split("formatted", F.lit(r"<\|im_end\|>\n"))
    cut = output.withColumn("parts", F.slice(parts, 1, F.size(parts) - 1))  # nothing follows the last mark

    def turn(part: Column) -> Column:
        line = F.instr(part, "\n")
        role = F.url_decode(F.substr(part, F.lit(len(START) + 1), line - len(START) - 1))
        return F.struct(role.alias("role"), unescaped(F.substr(part, line + 1)).alias("text"))

    def under(part: Column, mask: Column) -> Column:
        return unescaped(F.substr(part, mask["skip"] + 1, mask["take"]))

    return cut.select(
        key, F.transform("parts", turn).alias("turns"), F.zip_with("parts", "loss_mask", under).alias("loss"), "formatted"
    )
