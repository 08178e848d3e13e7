"""Values of dynamic JSON: type tests, truth, text and metadata lookup.

A job stays JSON text. The wanted members are read by two parses of that text, as
``VARIANT`` for their types and as strings for their text; nested text must be
read in the order of the source, while a variant sorts its keys.

``with_members`` stacks a few projections in which each step refers to columns of
the step before. That keeps the expression trees small: the optimizer leaves such
projections apart when a column is used several times.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FALSY = ["false", "0", "0.0", "-0.0", "-0", "[]", "{}"]
# One JSON token in compact text whose strings hold no escaped quote: a string with
# the colon that would make it a key, a number, or a bare word. Nothing here repeats
# a group, which the JVM would match by recursion, so any length of text is fine.
_TOKEN = r'"[^"]*":?|-?\d[\d.eE+-]*|true|false|null|\{\}|\[\]'


@dataclass(frozen=True)
class Member:
    """Columns that ``with_members`` makes for one member."""

    name: str

    @property
    def kind(self) -> Column:
        """Type of the member, such as STRING, BIGINT or OBJECT<...>; NULL if absent."""
        return F.col(f"{self.name}__kind")

    @property
    def text(self) -> Column:
        """Searchable text: all leaves of nested values joined by a space."""
        return F.col(f"{self.name}__text")

    @property
    def shown(self) -> Column:
        """Text of the value, nested values as JSON; NULL if absent or null."""
        return F.col(f"{self.name}__shown")

    @property
    def object_text(self) -> Column:
        """JSON text of an object, NULL for anything else."""
        return F.when(self.is_object, self.shown)

    @property
    def array_text(self) -> Column:
        """JSON text of an array, NULL for anything else."""
        return F.when(self.kind.startswith("ARRAY"), self.shown)

    @property
    def on(self) -> Column:
        """Truth: false for absent, null, false, zero and everything empty."""
        return F.col(f"{self.name}__on")

    @property
    def shown_or_empty(self) -> Column:
        return F.when(self.on, self.shown).otherwise("")

    @property
    def is_object(self) -> Column:
        return F.coalesce(self.kind.startswith("OBJECT"), F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def with_members(df: DataFrame, raw: str, *names: str, prefix: str = "") -> DataFrame:
    """Add the columns of ``Member(prefix + name)`` for members of an object.

    ``raw`` is a column of JSON text; when it is NULL or no object, every member
    is absent. Call it again on the text of a member to go one level down.
    """
    kept = [f"`{c}`" for c in df.columns]
    shape = {kind: ", ".join(f"`{n}`: {kind}" for n in names) for kind in ("variant", "string")}
    df = df.selectExpr(
        *kept,
        f"from_json(`{raw}`, 'struct<{shape['variant']}>') AS _typed",
        f"from_json(`{raw}`, 'struct<{shape['string']}>') AS _texts",
    )
    df = df.selectExpr(
        *kept,
        *[f"schema_of_variant(_typed.`{n}`) AS `{prefix}{n}__kind`" for n in names],
        *[f"_texts.`{n}` AS `{prefix}{n}__plain`" for n in names],
    )

    def texts(n: str) -> list[str]:
        kind, plain = f"`{n}__kind`", f"`{n}__plain`"
        shown = f"if({kind} = 'BOOLEAN', initcap({plain}), {plain})"
        nested = f"(startswith({kind}, 'OBJECT') OR startswith({kind}, 'ARRAY'))"
        falsy = ", ".join(f"'{text}'" for text in _FALSY)
        return [
            kind,
            f"coalesce(if({nested}, {_leaf_text_sql(plain)}, {shown}), '') AS `{n}__text`",
            f"{shown} AS `{n}__shown`",
            f"coalesce(if({kind} = 'STRING', {plain} <> '', {plain} NOT IN ({falsy})), false) AS `{n}__on`",
        ]

    return df.selectExpr(*kept, *[c for n in names for c in texts(prefix + n)])


def leaf_text(raw: str) -> Column:
    """All leaf values of JSON text in source order, joined by a space.

    Every token is taken by one expression, keys are dropped and one more parse
    decodes the escapes, so any depth is handled without recursion.
    """
    return F.expr(_leaf_text_sql(f"`{raw}`"))


def _leaf_text_sql(raw: str) -> str:
    # Escaped backslashes and quotes get their other JSON spelling; bare words become
    # the text Python prints for them.
    plain = f"replace(replace({raw}, r'\\\\', r'\\u005c'), r'\\\"', r'\\u0022')"
    return (
        "array_join(from_json(concat('[', array_join(transform(filter("
        f"regexp_extract_all({plain}, r'{_TOKEN}', 0), "
        "t -> NOT (startswith(t, '\"') AND endswith(t, ':'))), "
        "t -> CASE t WHEN 'true' THEN '\"True\"' WHEN 'false' THEN '\"False\"' "
        "WHEN 'null' THEN '\"\"' WHEN '{}' THEN '\"\"' WHEN '[]' THEN '\"\"' ELSE t END), ','), ']'), "
        "'array<string>'), ' ')"
    )


def metadata_text(entries: Column, field: str) -> Column:
    """Values of the entries called ``field``, joined by a space.

    ``entries`` is array<variant> of ``{name, value}``; names ignore case and a
    trailing colon; a value is a scalar or a list of scalars.
    """
    wanted = field.lower().rstrip(":")

    def values_of(entry: Column) -> Column:
        listed = F.try_variant_get(entry, "$.value", "array<string>")
        single = F.array_compact(F.array(F.try_variant_get(entry, "$.value", "string")))
        return F.coalesce(F.transform(listed, lambda v: F.coalesce(v, F.lit("None"))), single)

    named = F.filter(
        entries,
        lambda e: F.regexp_replace(
            F.lower(F.try_variant_get(e, "$.name", "string")), ":+$", ""
        ) == wanted,
    )
    return F.coalesce(F.array_join(F.flatten(F.transform(named, values_of)), " "), F.lit(""))
