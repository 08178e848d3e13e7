"""The set-based linking against a literal one-by-one reading of the rule."""

import random

import pytest
from pyspark.sql import functions as F

from jobweft.operators import canonical
from jobweft.operators.canonical import _followed, assign_canonical, fallback_candidates

NEW = (
    "posting_key string, company string, fingerprint string, role string, seniority string, "
    "locations array<string>, ord int"
)
LINKED = (
    "posting_key string, company string, fingerprint string, role string, seniority string, "
    "locations array<string>, canonical_id string"
)


def one_by_one(new, linked):
    pool = [tuple(row) for row in linked]
    links = {}
    for key, company, print_, role, level, places, _ in sorted(new, key=lambda r: r[6]):
        same = [p for p in pool if p[1] == company and company is not None]
        exact = {p[6] for p in same if print_ and p[2] == print_}
        canonical = None
        if len(exact) == 1:
            canonical = exact.pop()
        elif not exact and role is not None and places:
            fallback = {
                p[6]
                for p in same
                if p[3] == role
                and sorted(p[5]) == sorted(places)
                and (p[4] is None or level is None or p[4] == level)
            }
            if len(fallback) == 1:
                canonical = fallback.pop()
        links[key] = canonical or key
        pool.append((key, company, print_, role, level, places, links[key]))
    return links


def random_case(rng, companies, n_new, n_linked, prints):
    def attributes():
        return (
            rng.choice(companies),
            rng.choice([None, *[f"f{i}" for i in range(prints)]]),
            rng.choice([None, "r1", "r1", "r2"]),
            rng.choice([None, None, "junior", "senior", "lead"]),
            rng.choice([[], ["a"], ["b", "a"], ["a", "b"], ["a"]]),
        )

    linked = [(f"L{i}", *attributes(), f"L{rng.randrange(i + 1)}") for i in range(n_linked)]
    new = [(f"N{i:03d}", *attributes(), i) for i in range(n_new)]
    rng.shuffle(new)
    return new, linked


@pytest.mark.parametrize("seed", range(2))
def test_matches_the_sequential_rule(spark, seed):
    """Many small companies at once: each is a case of its own."""
    rng = random.Random(seed)
    new, linked = [], []
    for case in range(120):
        n, l = random_case(
            rng, [f"c{case}"], rng.randrange(1, 16), rng.choice([0, 0, 2, 5]), rng.choice([2, 5, 9])
        )
        new += [(f"{case}-{r[0]}", *r[1:]) for r in n]
        linked += [(f"{case}-{r[0]}", *r[1:6], f"{case}-{r[6]}") for r in l]
    # ord must be unique across the frame
    new = [(*r[:6], i) for i, r in enumerate(sorted(new, key=lambda r: (r[6], r[0])))]
    got = assign_canonical(
        spark.createDataFrame(new, NEW).repartition(8), spark.createDataFrame(linked, LINKED)
    ).collect()
    want = one_by_one(new, linked)
    assert len(got) == len(new)
    assert {r.posting_key: r.canonical_id for r in got} == want
    for r in got:
        expected = "new_canonical_job" if r.canonical_id == r.posting_key else "algorithmic_match"
        assert r.match_method == expected


def test_hot_company(spark):
    rng = random.Random(99)
    new, linked = random_case(rng, ["big"], 300, 20, 40)
    frame = spark.createDataFrame(new, NEW)
    state = spark.createDataFrame(linked, LINKED)
    got = {r.posting_key: r.canonical_id for r in assign_canonical(frame, state).collect()}
    assert got == one_by_one(new, linked)


def test_null_company_and_no_state(spark):
    new = [
        ("a", None, "f", "r", None, ["x"], 1),
        ("b", None, "f", "r", None, ["x"], 2),
        ("c", "k", "f", None, None, [], 3),
        ("d", "k", "f", "r", None, ["x"], 4),
        ("e", "k", "g", "r", "senior", ["x"], 5),
    ]
    got = {
        r.posting_key: r.canonical_id
        for r in assign_canonical(spark.createDataFrame(new, NEW)).collect()
    }
    assert got == {"a": "a", "b": "b", "c": "c", "d": "c", "e": "c"}


def test_fallback_candidates_count_like_pairs(spark):
    rng = random.Random(5)
    new, linked = random_case(rng, ["x", "y"], 80, 60, 5)
    got = {
        r.posting_key: (r.c_low, r.c_high)
        for r in fallback_candidates(
            spark.createDataFrame(new, NEW), spark.createDataFrame(linked, LINKED)
        ).collect()
    }
    for key, company, _, role, level, places, _ in new:
        if role is None or not places:
            assert key not in got
            continue
        found = {
            p[6]
            for p in linked
            if p[1] == company and p[3] == role and sorted(p[5]) == sorted(places)
            and (p[4] is None or level is None or p[4] == level)
        }
        assert got[key] == ((min(found), max(found)) if found else (None, None))


def test_a_long_chain_of_carried_canonicals_takes_few_rounds(spark, monkeypatch):
    """Each head joins what a copy of the head before carried into its block."""
    steps, new = 1000, []
    for i in range(steps):
        new.append((f"h{i:04d}", "c", f"f{i}", f"r{i}", None, ["x"], 2 * i))
        new.append((f"k{i:04d}", "c", f"f{i}", f"r{i + 1}", None, ["x"], 2 * i + 1))
    kept, rounds, cut, resolve = [], [], canonical.cut_lineage, canonical._resolve
    monkeypatch.setattr(canonical, "cut_lineage", lambda df: kept.append(1) or cut(df))
    monkeypatch.setattr(canonical, "_resolve", lambda *a, **k: rounds.append(1) or resolve(*a, **k))
    got = {r.posting_key: r.canonical_id for r in assign_canonical(spark.createDataFrame(new, NEW)).collect()}
    assert set(got.values()) == {"h0000"} and len(got) == 2 * steps
    # One round decides all of them, ten doublings follow 1,000 symbols.
    assert len(rounds) == 2 and len(kept) < 45


def test_heads_that_see_several_canonicals_wait_for_none(spark, monkeypatch):
    """Whatever a copy of the head before brings into a block, two linked postings there differ already."""
    steps, new = 8, []
    linked = [(f"L{i}{n}", "c", None, f"r{i}", None, ["x"], f"C{n}") for i in range(steps + 1) for n in range(2)]
    linked += [("J1", "c", None, "j", "junior", ["x"], "J1"), ("J2", "c", None, "j", "junior", ["x"], "J2")]
    for i in range(steps):
        new.append((f"h{i}", "c", f"f{i}", f"r{i}", None, ["x"], 2 * i))
        new.append((f"k{i}", "c", f"f{i}", f"r{i + 1}", None, ["x"], 2 * i + 1))
    # Several for an unknown seniority and for juniors, none for seniors but what a head of unknown seniority founds.
    new += [("u", "c", "fu", "j", None, ["x"], 30), ("s", "c", "fs", "j", "senior", ["x"], 31), ("s2", "c", "fs", "r0", None, ["x"], 32)]
    rounds, resolve = [], canonical._resolve
    monkeypatch.setattr(canonical, "_resolve", lambda *a, **k: rounds.append(1) or resolve(*a, **k))
    got = assign_canonical(spark.createDataFrame(new, NEW), spark.createDataFrame(linked, LINKED)).collect()
    assert {r.posting_key: r.canonical_id for r in got} == one_by_one(new, linked)
    assert {r.posting_key: r.canonical_id for r in got}["s"] == "u" and len(got) == len(new)
    assert len(rounds) == 1


def test_symbols_that_turn_out_to_be_one(spark):
    """Two copies bring one canonical into a block by different ways; a third way differs."""
    new = [
        ("a", "c", "fa", "r1", None, ["x"], 1), ("a2", "c", "fa", "r2", None, ["x"], 2), ("a3", "c", "fa", "r3", None, ["x"], 3),
        ("b", "c", "fb", "r2", None, ["x"], 4), ("d", "c", "fd", "r3", None, ["x"], 5),
        ("b2", "c", "fb", "r4", None, ["x"], 6), ("d2", "c", "fd", "r4", None, ["x"], 7), ("e", "c", "fe", "r4", None, ["x"], 8),
        ("e2", "c", "fe", "r5", None, ["x"], 9), ("z", "c", "fz", "r6", None, ["x"], 10), ("z2", "c", "fz", "r5", None, ["x"], 11),
        ("y", "c", "fy", "r5", None, ["x"], 12), ("y2", "c", "fy", "r6", None, ["x"], 13), ("w", "c", "fw", "r6", None, ["x"], 14),
    ]
    got = {r.posting_key: r.canonical_id for r in assign_canonical(spark.createDataFrame(new, NEW)).collect()}
    assert got == one_by_one(new, [])
    assert got["e"] == "a" and got["y"] == "y"


def test_chains_keep_measured_sizes(spark):
    """The planner's guess for a join is a product; a loop must not carry it from round to round."""
    rows = [(f"k{i:02d}", f"k{i + 1:02d}", False) for i in range(40)]
    known = spark.createDataFrame(rows, "head_key string, value string, done boolean")
    decided = spark.createDataFrame([("k40", "c")], "head_key string, value string")
    undecided = spark.createDataFrame([], "posting_key string")
    table = _followed(known, decided, undecided)
    assert {r["value"] for r in table.collect()} == {"c"}
    assert len(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 100
