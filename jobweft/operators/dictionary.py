"""Match canonical names in text through alias dictionaries.

Every alias is one literal regular expression, so a dictionary becomes an array
of JVM expressions evaluated in one projection: no join, no shuffle, no Python
worker. An alias counts when no letter, digit or underscore touches it on either
side; case is ignored and only its first occurrence in the text matters.

Running hundreds of regular expressions over every text is the cost to avoid.
``key_tokens`` splits the text once and keeps the few tokens some alias needs; an
expression runs only if its token is there. The tokens decide only what is worth
trying, never what matches, so one token list made from several texts serves all
of them.
"""

from __future__ import annotations

import re
import tomllib
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_DICTIONARIES = Path(__file__).parent.parent / "config" / "dictionaries.toml"

DICTIONARY_NAMES = (
    "companies",
    "roles",
    "skills",
    "seniority_levels",
    "proficiency_levels",
    "requirement_types",
    "work_modes",
    "locations",
    "employment_relations",
    "workloads",
)

_WORD = r"\p{L}\p{N}_"
_TOKEN_SPLIT = rf"[^{_WORD}]+"
# Letters that match "s" or "i" without case although lower() keeps them apart.
_ODD_CASE = ("ſıİ", "sii")
# Lower-casing is one to one for these letters, so a token test cannot miss one.
_SIMPLE_CASE = re.compile(r"[0-9a-z_à-öø-þā-įĳ-ňŋ-ž]+")


@dataclass(frozen=True)
class Alias:
    name: str
    alias: str
    rule_ord: int

    @property
    def pattern(self) -> str:
        literal = re.escape(self.alias)
        if self.width > len(self.alias):
            return rf"(?iu)(?<![{_WORD}]){literal}(?![{_WORD}])"
        # What stands before is looked at only where the alias is: few places of a text.
        return rf"(?iu){literal}(?<![{_WORD}]{literal})(?![{_WORD}])"

    @property
    def width(self) -> int:
        """Length in the JVM's UTF-16 units, the unit of regexp_instr."""
        return len(self.alias.encode("utf-16-le")) // 2

    @property
    def key(self) -> str | None:
        """The longest word of the alias, if a token test is safe for it."""
        words = re.findall(r"\w+", self.alias.lower())
        word = max(words, key=len, default="")
        return word if _SIMPLE_CASE.fullmatch(word) else None


class AliasDictionary:
    """Canonical names with their aliases, compiled to Spark columns."""

    def __init__(self, name: str, rules: Iterable[tuple[str, Iterable[str]]]) -> None:
        self.name = name
        self.rules = [(str(n), tuple(str(a) for a in aliases)) for n, aliases in rules]
        self.aliases = [
            Alias(canonical, alias, order)
            for order, (canonical, aliases) in enumerate(self.rules)
            for alias in aliases
            if alias
        ]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.rules]

    def hits(self, text: str, keys: str | None = None) -> str:
        """SQL for the first hit of each alias: array<struct<start, rank, name>>.

        ``rank`` is the negated width, so sorting the structs gives position,
        then the longest alias, then the name. ``text`` and ``keys`` are column
        names or SQL expressions; one parsed expression is far cheaper to build
        than hundreds of column objects.
        """
        if not self.aliases:
            return "cast(array() as array<struct<start:int,rank:int,name:string>>)"
        found = []
        for alias in self.aliases:
            start = f"regexp_instr({text}, {_quote(alias.pattern)})"
            if keys is not None and alias.key:
                start = f"if(array_contains({keys}, {_quote(alias.key)}), {start}, 0)"
            found.append(
                f"named_struct('start', {start}, 'rank', {-alias.width}, 'name', {_quote(alias.name)})"
            )
        return f"filter(array({', '.join(found)}), hit -> hit.start > 0)"

    def find_all(self, text: str, keys: str | None = None) -> Column:
        """All names in order of position, then name, each once."""
        by_place = f"transform({self.hits(text, keys)}, h -> named_struct('start', h.start, 'name', h.name))"
        return F.expr(f"array_distinct(transform(array_sort({by_place}), h -> h.name))")

    def find_first(self, text: str, keys: str | None = None) -> Column:
        """The earliest name; at one position the longest alias wins, then the name."""
        return F.expr(f"array_min({self.hits(text, keys)}).name")

    def find_non_overlapping(self, text: str, keys: str | None = None) -> Column:
        """Names of hits left when every hit overlapping an earlier pick is dropped."""
        return F.expr(self._non_overlapping(text, keys))

    def find_non_overlapping_each(self, texts: str, keys: str | None = None) -> Column:
        """``find_non_overlapping`` over an array of texts, merged in order."""
        return F.expr(
            f"array_distinct(flatten(transform({texts}, t -> {self._non_overlapping('t', keys)})))"
        )

    def _non_overlapping(self, text: str, keys: str | None) -> str:
        return (
            f"array_distinct(aggregate(array_sort({self.hits(text, keys)}), "
            "named_struct('stop', 0, 'names', cast(array() as array<string>)), "
            "(acc, hit) -> if(hit.start >= acc.stop, "
            "named_struct('stop', hit.start - hit.rank, 'names', array_append(acc.names, hit.name)), "
            "acc)).names)"
        )


def key_tokens(text: Column | str, dictionaries: Iterable[AliasDictionary]) -> Column:
    """Distinct tokens of ``text`` that some alias needs, from one split of it."""
    text = F.col(text) if isinstance(text, str) else text
    wanted = sorted({a.key for d in dictionaries for a in d.aliases if a.key})
    if not wanted:
        return F.array().cast("array<string>")
    odd, plain = _ODD_CASE
    has_odd = F.lit(False)
    for letter in odd:
        has_odd = has_odd | F.contains(text, F.lit(letter))
    lowered = F.when(has_odd, F.lower(F.translate(text, odd, plain))).otherwise(F.lower(text))
    tokens = F.split(F.coalesce(lowered, F.lit("")), _TOKEN_SPLIT)
    words = ", ".join(_quote(w) for w in wanted)
    return F.array_intersect(tokens, F.expr(f"array({words})"))


def find_first_of(dictionary: AliasDictionary, keys: str | None, *texts: str) -> Column:
    """First name found in the first text that has one (title before body)."""
    return F.coalesce(*[dictionary.find_first(text, keys) for text in texts])


def _quote(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def load_dictionary(path: Path | str, section: str) -> AliasDictionary:
    """Read one ``section`` holding a list of ``{name, aliases}`` entries."""
    with open(path, "rb") as handle:
        entries = tomllib.load(handle).get(section)
    if not isinstance(entries, list):
        raise ValueError(f"{path}: array '{section}' is missing")
    return AliasDictionary(section, [(e["name"], e.get("aliases", [])) for e in entries])


def load_dictionaries(path: Path | str = DEFAULT_DICTIONARIES) -> dict[str, AliasDictionary]:
    """Load all ten, from one file or from a folder with one file per section."""
    path = Path(path)
    return {
        name: load_dictionary(path / f"{name}.toml" if path.is_dir() else path, name)
        for name in DICTIONARY_NAMES
    }


def aliases_frame(spark: SparkSession, dictionaries: dict[str, AliasDictionary]) -> DataFrame:
    """The dictionaries as a table (dict, name, alias, rule_ord)."""
    return spark.createDataFrame(
        [
            (d.name, a.name, a.alias, a.rule_ord)
            for d in dictionaries.values()
            for a in d.aliases
        ],
        "dict string, name string, alias string, rule_ord int",
    )
