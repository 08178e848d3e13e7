"""Dictionary matching against a literal reading of its rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from jobweft.operators import alias_index
from jobweft.operators.alias_index import alias_keys, all_names, first_name, non_overlapping_names, with_hits
from jobweft.operators.dictionary import (
    AliasDictionary,
    aliases_frame,
    find_first_of,
    key_tokens,
    load_dictionaries,
    load_dictionary,
)

ODD = AliasDictionary(
    "odd",
    [
        ("Plus", ["C++", "+", "a+b"]),
        ("Dot", [".net", "Sr.", "Sr"]),
        ("Long", ["data engineer", "data", "engineer x"]),
        ("Short", ["engineer", "e"]),
        ("Czech", ["DPČ", "žluť", "Práce z domova"]),
        ("Quote", ["it's", 'a "b"', "back\\slash"]),
        ("Sharp", ["straße", "is"]),
        ("Greek", ["ΣΑΣ"]),
        ("None", []),
    ],
)


def model_hits(dictionary, text):
    hits = []
    for alias in dictionary.aliases:
        found = re.search(rf"(?<!\w){re.escape(alias.alias)}(?!\w)", text, re.IGNORECASE)
        if found:
            hits.append((found.start(), found.end(), alias.name))
    return hits


def model_all(hits):
    return list(dict.fromkeys(name for _, _, name in sorted(hits, key=lambda h: (h[0], h[2]))))


def model_first(hits):
    return min(hits, key=lambda h: (h[0], h[0] - h[1], h[2]))[2] if hits else None


def model_non_overlapping(hits):
    picked, end = [], 0
    for start, stop, name in sorted(hits, key=lambda h: (h[0], h[0] - h[1], h[2])):
        if start >= end:
            picked.append(name)
            end = stop
    return list(dict.fromkeys(picked))


def texts():
    rng = random.Random(3)
    words = [
        "C++", "c", "+", "a+b", ".NET", "sr.", "SR", "data", "engineer", "x", "e", "dpč", "DPČ", "ŽLUŤ",
        "práce z domova", "it's", "IT'S", 'a "b"', "back\\slash", "STRASSE", "straße", "iſ", "Iſ", "İs",
        "ıs", "σας", "ΣΑΣ", "_data", "data_", "data2", "😀", "\n", "\t", "(data)", "-", "ﬁ",
    ]
    made = [" ".join(rng.choices(words, k=rng.randrange(0, 12))) for _ in range(300)]
    return made + ["".join(rng.choices(words, k=rng.randrange(0, 8))) for _ in range(100)] + ["", None]


@pytest.mark.parametrize("with_keys", [True, False])
def test_all_first_and_non_overlapping(spark, with_keys):
    rows = [(i, t) for i, t in enumerate(texts())]
    frame = spark.createDataFrame(rows, "i int, t string").withColumn("k", key_tokens("t", [ODD]))
    keys = "k" if with_keys else None
    got = frame.select(
        "i", "t",
        ODD.find_all("t", keys).alias("every"),
        ODD.find_first("t", keys).alias("first"),
        ODD.find_non_overlapping("t", keys).alias("apart"),
    ).collect()
    assert len(got) == len(rows)
    for row in got:
        hits = model_hits(ODD, row.t or "")
        assert row.every == model_all(hits), row.t
        assert row["first"] == model_first(hits), row.t
        assert row.apart == model_non_overlapping(hits), row.t


def test_first_text_with_a_hit_wins(spark):
    frame = spark.createDataFrame([("plain", "data"), ("engineer", "data"), ("", "")], "a string, b string")
    assert [r[0] for r in frame.select(find_first_of(ODD, None, "a", "b")).collect()] == [
        "Long", "Short", None,
    ]


def test_each_text_of_an_array(spark):
    places = load_dictionaries()["locations"]
    frame = spark.createDataFrame([(["Brno, CZ", "Praha, Česká republika; Brno"],), ([],)], "t array<string>")
    found = [r[0] for r in frame.select(places.find_non_overlapping_each("t")).collect()]
    assert found == [["Brno, Czechia", "Prague, Czechia"], []]


def test_long_text_with_many_hits(spark):
    text = "filler words, " * 200_000 + "data engineer"
    row = spark.createDataFrame([(text,)], "t string").select(
        ODD.find_all("t").alias("a"), F.size(key_tokens("t", [ODD])).alias("k")
    ).first()
    assert row.a == ["Long", "Short"]
    assert row.k == 2


def test_builtin_dictionaries(spark):
    loaded = load_dictionaries()
    assert len(loaded) == 10
    assert sum(len(d.names) for d in loaded.values()) == 92
    frame = aliases_frame(spark, loaded)
    assert frame.count() == 300
    assert frame.where("dict = 'skills'").count() == 95
    row = spark.createDataFrame([("SQL Server and Python 3",)], "t string").select(
        loaded["skills"].find_all("t")
    ).first()
    assert row[0] == ["SQL", "SQL Server", "Python"]


def test_list_of_tables_is_read_and_a_missing_section_is_an_error(tmp_path):
    path = tmp_path / "skills.toml"
    path.write_text("[[skills]]\nname = 'A'\naliases = ['a', 'b']\n[[skills]]\nname = 'B'\n")
    loaded = load_dictionary(path, "skills")
    assert loaded.rules == [("A", ("a", "b")), ("B", ())]
    with pytest.raises(ValueError, match="'roles' is missing"):
        load_dictionary(path, "roles")


def test_index_equals_expressions(spark):
    """Texts of aliases, pieces of them and odd letters, against one expression for each alias."""
    rng = random.Random(4)
    small = AliasDictionary(
        "x",
        [
            ("C++", ["c++", "cpp"]), ("C", ["c"]), ("dot", [".NET", "asp.net core"]), ("plus", ["++"]), ("long", ["one two three four", "one two three"]),
            ("street", ["Straße", "STRASSE"]), ("greek", ["ΟΔΟΣ"]), ("micro", ["µm"]), ("turk", ["istanbul"]), ("quote", ["a\\Eb", "it's"]), ("wide", ["🙂 ok"]),
        ],
    )
    bits = [a.alias for a in small.aliases] + [
        " ", " ", "_", ".", "x", "İstanbul", "ıstanbul", "STRAẞE", "οδος", "οδοσ", "μm", "one", "two", "three", "\n", ",", "1", "é",
    ]
    rows = [(i, "".join(rng.choices(bits, k=rng.randrange(12)))) for i in range(600)] + [(1000, None), (1001, "")]
    texts = spark.createDataFrame(rows, "id long, text string")
    found = with_hits(texts, aliases_frame(spark, {"x": small}), "id", "text")
    got = found.select("id", all_names().alias("a"), first_name().alias("f"), non_overlapping_names().alias("n")).collect()
    want = texts.select("id", small.find_all("text").alias("a"), small.find_first("text").alias("f"), small.find_non_overlapping("text").alias("n"))
    want = {r.id: (r.a or [], r.f, r.n or []) for r in want.collect()}
    assert {r.id: (r.a, r.f, r.n) for r in got} == want and sum(bool(w[0]) for w in want.values()) > 200
    assert with_hits(texts.limit(0), aliases_frame(spark, {"x": small}), "id", "text").count() == 0
    nothing = with_hits(texts, aliases_frame(spark, {"x": small}).limit(0), "id", "text")
    assert {len(r.hits) for r in nothing.collect()} == {0}


def test_index_plan_does_not_grow_with_the_dictionary(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "w7 w12"), (2, "w3000")], "id long, text string")
    sizes = []
    for n in (10, 4000):
        aliases = spark.range(n).select(F.concat(F.lit("n"), "id").alias("name"), F.concat(F.lit("w"), "id").alias("alias"))
        found = with_hits(texts, aliases, "id", "text")
        sizes.append(len(found._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(sizes[0] - sizes[1]) < 200
    assert {r.id: [h.name for h in r.hits] for r in found.orderBy("id").collect()}[2] == ["n3000"]
    monkeypatch.setattr(alias_index, "BROADCAST_BYTES", 0)
    shuffled = with_hits(texts, aliases, "id", "text")
    assert {r.id: sorted(h.name for h in r.hits) for r in shuffled.collect()} == {1: ["n12", "n7"], 2: ["n3000"]}


def test_hits_of_many_words_are_those_of_the_expressions(spark):
    long = " ".join(f"w{n}" for n in range(200))
    texts = [
        (1, f"a,b a b {long}  Straße — c++ and C#"), (1, "b a"), (2, f"{long} w63 w64-w65 ſtraße"), (3, ""), (4, None),
        (None, "a b"), (5, "of, the of  the Of The end"), (6, "\U0001f600 a b µ K w5"), (7, "xa b_ a_b"), (8, f"\n {long} a\nb a b"),
    ]
    texts = spark.createDataFrame(texts, "id bigint, text string")
    words = ["a", "b", "a b", "of the", "the end", "w63 w64", "w64-w65", "w127", "w128", "w199", "straße", "c++", "#", "μ", "k", "w1 w2 w3 w4", "w1 w2 w3 w5"]
    aliases = spark.createDataFrame([(f"n{n % 5}", word) for n, word in enumerate(words)], "name string, alias string")
    found = with_hits(texts, aliases, "id", "text")
    got = sorted((r.id or 0, r.text or "", sorted(map(tuple, r.hits))) for r in found.collect())
    met = texts.crossJoin(alias_keys(aliases)).withColumn("start", F.expr("regexp_instr(text, pattern)")).where("start > 0 AND id IS NOT NULL").collect()
    want = sorted(
        (t.id or 0, t.text or "", sorted((r.start, r.rank, r.name) for r in met if (r.id, r.text) == (t.id, t.text))) for t in texts.collect()
    )
    assert got == want
    # What met is not shuffled to its text.
    assert "hashpartitioning(_id" not in found._jdf.queryExecution().executedPlan().toString()


def test_letters_beside_an_alias_are_looked_at_only_where_it_is(spark):
    names = AliasDictionary("names", [("the", ["the"]), ("plus", ["+"]), ("smile", ["\U0001f600"]), ("twice", ["aa"])])
    assert names.aliases[0].pattern.startswith("(?iu)the")
    cases = ["the", "xthe the", "the_ THE", "9the", "a+ +", "a \U0001f600", "aaa aa", "aaa", "\U0001f600the", "thé the", ""]
    texts = spark.createDataFrame([(t,) for t in cases], "text string")
    got = {r.text: {(h.start, h.name) for h in r.hits} for r in texts.select("text", F.expr(names.hits("text")).alias("hits")).collect()}
    old = {a.name: rf"(?iu)(?<![\p{{L}}\p{{N}}_]){re.escape(a.alias)}(?![\p{{L}}\p{{N}}_])" for a in names.aliases}
    starts = texts.select("text", *[F.regexp_instr("text", F.lit(p)).alias(n) for n, p in old.items()]).collect()
    assert got == {r.text: {(r[n], n) for n in old if r[n] > 0} for r in starts}
