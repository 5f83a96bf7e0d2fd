"""Chat formatting by schema fingerprint; DataFrame functions only.

Records of any layout are recognised by a fingerprint: the paths of the nested fields
that hold a value in the row are put in order and hashed (``xxhash64``).  Each declarative
``Mapping`` lists the paths a layout must and may have; the fingerprints of all its
combinations select the mapping that turns the row into canonical turns
(position, role, text).  Rows of one conversation that come turn by turn are then gathered
by their key, turned into one string by the template, and given a loss mask.

Template: ``[INST] user [/INST]``, ``<s> assistant </s>``, ``<<SYS>> system <</SYS>>``,
and ``[ROLE] name [/ROLE][TURN] text [/TURN]`` for any other role.  Control strings
inside texts and role names are escaped: a backslash is doubled and one more is put behind
the first character of a control string, so no control string of the output comes from a
text, and ``read_turns`` gives every text back exactly.

Output of ``format_chats``: id, formatted, pieces (array of text and loss; the texts joined are
``formatted``, the pieces under the loss mask are the assistants' escaped texts).

Defined cases: a null or missing text or role is empty; a null position comes first;
equal positions are ordered by role, then text; repeated rows are turns of their own; rows
that no mapping knows have no turns and give an empty string (``unknown`` finds them); a null
key is a conversation of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the template: role, opening and closing control string.
TEMPLATE = (("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"), ("system", "<<SYS>>", "<</SYS>>"))
OTHER = ("[TURN]", "[/TURN]")
ROLE = ("[ROLE]", "[/ROLE]")
_CONTROL_TAILS = r"(?=/?s>|<SYS>>|</SYS>>|/?INST\]|/?TURN\]|/?ROLE\])"
#: Names under which layouts know the three common roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """A layout: paths it must have, paths it may have, and its turns.

    Each of ``turns`` is (role, source path) for a fixed role, or (role path, text path)
    inside the array ``each`` (``array[].field`` in paths), or both paths of a flat row.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    fixed: tuple[tuple[str, str], ...] = ()
    each: str | None = None
    role: str | None = None
    text: str | None = None

    def path_sets(self):
        for k in range(len(self.optional) + 1):
            for extra in combinations(self.optional, k):
                yield tuple(sorted({*self.required, *extra}))


#: Layouts known by default.
MAPPINGS = (
    Mapping("turn_rows", (), ("role", "text"), role="role", text="text"),
    Mapping("messages", ("messages",), ("messages[].role", "messages[].content"), each="messages", role="role", text="content"),
    Mapping("conversations", ("conversations",), ("conversations[].from", "conversations[].value"),
            each="conversations", role="from", text="value"),
    Mapping("instruction", ("instruction",), ("input", "output", "system"),
            fixed=(("system", "system"), ("user", "instruction\n\ninput"), ("assistant", "output"))),
    Mapping("prompt", ("prompt",), ("completion", "system"),
            fixed=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt_response", ("prompt", "response"), ("system",),
            fixed=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
)


def _name(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def _any_has(array: str, field: str) -> Column:
    return F.coalesce(F.exists(F.col(f"`{array}`"), lambda m: m[field].isNotNull()), F.lit(False))


def field_paths(schema: T.StructType, known: set[str]) -> list[tuple[str, Column]]:
    """(path, whether it holds a value) of the fields of the schema that a mapping names."""
    out = []
    for f in schema.fields:
        if f.name in known:
            out.append((f.name, F.col(f"`{f.name}`").isNotNull()))
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            for g in f.dataType.elementType.fieldNames():
                if (path := f"{f.name}[].{g}") in known:
                    out.append((path, _any_has(f.name, g)))
    return sorted(out, key=lambda x: x[0])


def fingerprint(df: DataFrame, mappings=MAPPINGS) -> Column:
    """Hash of the ordered paths that hold a value in the row, of those the mappings name."""
    known = {p for m in mappings for s in m.path_sets() for p in s}
    present = [F.when(has, F.lit(path)) for path, has in field_paths(df.schema, known)]
    return F.xxhash64(F.concat_ws("|", *present) if present else F.lit(""))


def _role(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    for alias, name in ROLE_NAMES.items():
        c = F.when(c == alias, F.lit(name)).otherwise(c)
    return c


def _turn(position: Column, role: Column, text: Column) -> Column:
    return F.struct(position.cast("long").alias("position"), role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


_TURNS = "array<struct<position:bigint,role:string,text:string>>"


def _mapped(df: DataFrame, m: Mapping, position: str | None) -> Column | None:
    """The turns that a mapping makes of a row; None where the schema has no such layout."""
    names = {f.name: f.dataType for f in df.schema.fields}
    text = lambda p: F.col(f"`{p}`").cast("string") if p in names else F.lit(None).cast("string")
    if m.each:
        kind = names.get(m.each)
        if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
            return None
        inner = set(kind.elementType.fieldNames())
        get = lambda x, p: x[p].cast("string") if p in inner else F.lit(None).cast("string")
        return F.transform(F.col(f"`{m.each}`"), lambda x, i: _turn(i, _role(get(x, m.role)), get(x, m.text)))
    if m.fixed:
        if not all(p in names for p in m.required):
            return None
        turns = []
        for i, (role, source) in enumerate(m.fixed):
            parts = [text(p) for p in source.split("\n\n")]
            value = F.concat_ws("\n\n", *parts) if len(parts) > 1 else parts[0]
            turns.append(F.when(F.coalesce(*parts).isNotNull(), _turn(F.lit(i), F.lit(role), value)))
        return F.array_compact(F.array(*turns))
    if m.role not in names and m.text not in names:
        return None
    at = F.col(f"`{position}`") if position in names else F.lit(0)
    return F.array(_turn(at, _role(text(m.role)), text(m.text)))


def canonical_turns(df: DataFrame, *, position_col: str | None = "turn", mappings=MAPPINGS) -> Column:
    """The row's turns by the mapping that its fingerprint selects; null if none does."""
    seen, fp, out = set(), fingerprint(df, mappings), None
    for m in mappings:
        turns = _mapped(df, m, position_col)
        if turns is None:
            continue
        prints = [s for s in m.path_sets() if s not in seen]
        seen.update(prints)
        if prints:
            hit = fp.isin(*[F.xxhash64(F.lit("|".join(s))) for s in prints])
            turns = turns.cast(_TURNS)
            out = F.when(hit, turns) if out is None else out.when(hit, turns)
    return F.lit(None).cast(_TURNS) if out is None else out


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([<\[])" + _CONTROL_TAILS, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _pieces(turn: Column) -> Column:
    """Opening, text and closing of a turn, each with its loss flag."""
    def marked(opening: Column, closing: str, loss: bool):
        part = lambda c, flag: F.struct(c.alias("text"), F.lit(flag).alias("loss"))
        return F.array(part(F.concat(opening, F.lit(" ")), False), part(escape(turn["text"]), loss),
                       part(F.lit(f" {closing}"), False))

    out = None
    for role, opening, closing in TEMPLATE:
        made = marked(F.lit(opening), closing, role == "assistant")
        out = F.when(turn["role"] == role, made) if out is None else out.when(turn["role"] == role, made)
    named = F.concat(F.lit(f"{ROLE[0]} "), escape(turn["role"]), F.lit(f" {ROLE[1]}{OTHER[0]}"))
    return out.otherwise(marked(named, OTHER[1], False))


def unknown(df: DataFrame, *, position_col: str | None = "turn", mappings=MAPPINGS) -> DataFrame:
    """The rows whose layout no mapping knows."""
    return df.where(canonical_turns(df, position_col=position_col, mappings=mappings).isNull())


def format_chats(df: DataFrame, *, id_col: str = "conv_id", position_col: str | None = "turn",
                 mappings=MAPPINGS) -> DataFrame:
    """One row per conversation: id, formatted, pieces."""
    turns = canonical_turns(df, position_col=position_col, mappings=mappings)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(turns, F.array().cast(_TURNS)).alias("turns"))
    chats = rows.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("turns"))).alias("turns"))
    pieces = F.flatten(F.transform("turns", _pieces))
    return (chats.select("id", pieces.alias("pieces"))
            .select(F.col("id").alias(id_col), F.array_join("pieces.text", "").alias("formatted"), "pieces"))


_READ = (r"(?s)(?:\[ROLE\] (.*?) \[/ROLE\])?(\[INST\]|<s>|<<SYS>>|\[TURN\]) (.*?) (?:\[/INST\]|</s>|<</SYS>>|\[/TURN\])")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    names, marks, texts = (F.regexp_extract_all(formatted, F.lit(_READ), k) for k in (1, 2, 3))

    def turn(x):
        role = unescape(x["name"])
        for known, opening, _ in TEMPLATE:
            role = F.when(x["mark"] == opening, F.lit(known)).otherwise(role)
        return F.struct(role.alias("role"), unescape(x["text"]).alias("text"))

    return F.transform(F.arrays_zip(names.alias("name"), marks.alias("mark"), texts.alias("text")), turn)


def read_loss(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")
