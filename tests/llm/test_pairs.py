"""Near-duplicates, lines, components and fingerprints against brute force on small tables."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from jobweft.llm import common, components, fingerprints, line_dedup, near_dedup


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def smallest_reachable(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def near_by_pairs(texts, percent):
    sets = {k: shingles(t) for k, t in texts.items()}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, smallest_reachable(sets, links)


def test_super_minhash_estimates_with_less_spread_than_independent_hashes():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(80):
        shared, left, right = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (60, 20, 20))
        sets = [np.unique(np.concatenate([shared, x])) for x in (left, right)]
        held = near_dedup.super_minhash(np.concatenate(sets), np.repeat([0, 1], [len(s) for s in sets]), 2, 128)
        errors.append((held[0] == held[1]).mean() - 0.6)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < (0.6 * 0.4 / 128) ** 0.5


def test_super_minhash_does_not_depend_on_the_other_sets():
    elements = np.arange(1, 40, dtype=np.uint64)
    alone = near_dedup.super_minhash(elements, np.zeros(39, int), 1, 64)
    both = near_dedup.super_minhash(np.concatenate([elements, elements + np.uint64(500)]), np.repeat([0, 1], 39), 2, 64)
    assert (alone[0] == both[0]).all() and not (both[0] == both[1]).all()


def test_groups_equal_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sets, label = near_by_pairs({r.doc_id: r.text for r in docs.collect()}, 85)
    for row in near_dedup.near_duplicates(docs).collect():
        assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), label[row.doc_id])
        assert row.kept == (row.component_id == row.doc_id)


def test_a_crowd_of_moderately_similar_texts_is_linked_completely(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for k in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 7), replace=False):
            words[at] = f"x{k}_{at}"
        texts[1000 - k] = " ".join(words)
    _, label = near_by_pairs(texts, 85)
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == label


def test_near_duplicates_of_odd_rows(spark):
    text = "one two three four five six seven eight"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A B"), (6, text), (6, text), (7, text.upper()), (None, text), (8, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("id", "n", "bucket", "rep", "content")}
    )
    found = sorted(
        ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()),
        key=lambda r: (r[0] is None, r),
    )
    assert found == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
        (6, 4, 6, True), (6, 4, 6, True), (7, 4, 6, False), (8, 1, 8, True), (None, 4, None, None),
    ]
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
    left = near_dedup.keep_one(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == {1: 1, 2: 1, 3: 1, 4: 1, 6: 2, 8: 1, None: 1}


def test_components_of_a_long_path_and_odd_edges(spark):
    edges = [(i, i + 1) for i in range(300)] + [(500, 500), (None, 3), (900, 700), (700, 900), (900, 800)]
    found = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.id: r.component for r in found} == {i: 0 for i in range(301)} | {700: 700, 800: 700, 900: 700}
    assert len(found) == 304
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_lines_equal_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(40):
        words = [f"{'abcdefgh'[i % 8] * (1 + i % 5)}{'pqrst'[(i * 7 + k // 8) % 5]}" for i in range(30)]
        if k % 8:
            words[int(rng.integers(30))] = "changed" + "xyz"[k % 3]
        rows.append((k // 4, " ".join(words) + "!" * (k % 2)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_list("text")), "\n").alias("text")
    )
    lines = line_dedup.lines_of(docs, "doc_id", "text").withColumn("bits", line_dedup.simhash(F.col("normal"))).collect()
    classes = {r.cls: (r.normal, r.bits) for r in lines}
    links = [
        (a, b) for a, b in itertools.combinations(classes, 2)
        if bin((classes[a][1] ^ classes[b][1]) & (2**64 - 1)).count("1") <= 3
        and edit_distance(classes[a][0], classes[b][0]) <= max(len(classes[a][0]), len(classes[b][0])) * 20 // 100
    ]
    assert links
    label = smallest_reachable(classes, links)
    first = {}
    for r in sorted(lines, key=lambda r: (r.doc_id, r.line_no)):
        first.setdefault(label[r.cls], (r.doc_id, r.line_no))
    want = {(r.doc_id, r.line_no): (label[r.cls], first[label[r.cls]] == (r.doc_id, r.line_no)) for r in lines}
    got = {(r.doc_id, r.line_no): (r.group_id, r.kept) for r in line_dedup.line_groups(docs).collect()}
    assert got == want


def test_lines_with_changed_words_equal_brute_force_on_edit_similarity(spark):
    rng = np.random.default_rng(4)
    lines = []
    for n, changes in ((3, 1), (5, 1), (8, 1), (20, 1), (20, 3), (27, 4), (50, 6)):
        for _ in range(3):
            base = ["".join("abcdefghijklmnopqrstuvwxyz"[c] for c in rng.integers(0, 26, rng.integers(3, 9))) for _ in range(n)]
            edited = list(base)
            for at in rng.choice(n, changes, replace=False):
                edited[at] = edited[at][:1] + "zq" + edited[at][3:]
            lines += [" ".join(base), " ".join(edited)]
    lines += ["copyright company", "copyright compny", "all rights", "all rihts"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    links = [
        (a, b) for a, b in itertools.combinations(range(len(lines)), 2)
        if abs(len(lines[a]) - len(lines[b])) * 5 <= max(len(lines[a]), len(lines[b]))
        and edit_distance(lines[a], lines[b]) <= max(len(lines[a]), len(lines[b])) * 20 // 100
    ]
    assert len(links) >= 20
    label = smallest_reachable(range(len(lines)), links)
    got = {r.doc_id: r.kept for r in line_dedup.similar_lines(docs).collect()}
    assert got == {i: label[i] == i for i in range(len(lines))}


def test_keys_and_texts_of_lines_that_meet_nobody_are_not_held(spark, monkeypatch):
    rng = np.random.default_rng(6)
    lines = [" ".join("".join("abcdefghijklmnopqrstuvwxyz"[c] for c in rng.integers(0, 26, 6)) for _ in range(20)) for _ in range(60)]
    lines.append(lines[0].replace(lines[0].split()[4], "changed"))
    held = []

    def recorded(df):
        out = common.settled(df)
        held.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(line_dedup, "settled", recorded)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id for r in line_dedup.similar_lines(docs).where("NOT kept").collect()}
    assert got == {60}
    assert all(n <= len(lines) and "normal" not in columns for columns, n in held)


def test_heads_and_rests_of_lines_agree_with_their_edits(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n in (1, 2, 5, 9, 30, 80, 200, 900):
        for edits in (0, 1, n // 10, n // 6, n // 5, n // 3, n):
            base = [*rng.integers(97, 100 if n < 30 else 123, n)]
            other = list(base)
            for _ in range(edits):
                at = int(rng.integers(0, len(other) + 1))
                kind = int(rng.integers(0, 3))
                other[at : at + (kind > 0)] = [] if kind == 2 else [int(rng.integers(97, 123))]
            rows.append(("".join(map(chr, base)), "".join(map(chr, other)) or "x"))
    rows += [("é" * 50 + "a" * 30, "a" * 30 + "é" * 50), ("same", "same"), ("aaaa", "aaaaa"), ("abc" * 40, "abc" * 44), ("xéy" * 9, "xéy" * 4 + "z" + "xéy" * 5)]
    pairs = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", F.length("a").alias("size_a"), F.length("b").alias("size_b"),
        line_dedup.line_head(F.col("a")).alias("head_a"), line_dedup.line_head(F.col("b")).alias("head_b"),
    )
    most = "CAST(greatest(size_a, size_b) * 20 div 100 AS INT)"
    got = pairs.selectExpr(
        f"levenshtein(a, b) <= {most} AS linked", f"{line_dedup.heads_allow()} AS allowed",
        f"{line_dedup.within('a', 'b', most)} AS told",
    ).collect()
    assert [r.told for r in got] == [r.linked for r in got] and 10 < sum(r.linked for r in got) < len(got) - 10
    assert all(r.allowed for r in got if r.linked) and not all(r.allowed for r in got)


def test_a_hub_is_compared_once_and_unlike_lines_by_their_heads(spark, monkeypatch):
    """Three unlike lines share one run: two pairs with the hub of their bucket, one without."""
    rng = np.random.default_rng(9)
    words = ["".join("abcdefghijklmnopqrstuvwxyz"[c] for c in rng.integers(0, 26, 8)) for _ in range(60)]
    shared = ["extraordinarily", "incomprehensible", "misunderstandings"]
    docs = spark.createDataFrame([(i, " ".join(words[20 * i : 20 * i + 20] + shared)) for i in range(3)], "doc_id long, text string")
    made, whole, linked, settle = [], [], line_dedup.linked_members, common.settled

    def watched(members, found, compare, *rest):
        return linked(members, found, lambda pairs: made.append(pairs.distinct().count()) or compare(pairs), *rest)

    def kept(df):
        out = settle(df)
        whole.extend([out.count()] if out.columns == ["a", "b"] else [])
        return out

    monkeypatch.setattr(line_dedup, "linked_members", watched)
    monkeypatch.setattr(line_dedup, "settled", kept)
    assert line_dedup.similar_lines(docs).where("kept").count() == 3
    assert made == [1] and whole == [0] * 4


def test_shared_keys_equal_a_count_by_hand(spark):
    rows = [(1, 5, 10), (2, 6, 10), (3, 7, 11), (2, 6, 12), (3, 7, 12), (1, 5, 12), (4, 9, 13), (5, 40, 12), (6, 10, 14), (7, 13, 14), (8, 8, 15), (9, 10, 15), (10, 13, 15)]
    keyed = spark.createDataFrame(rows, "cls long, size int, bucket long")
    got = sorted((r.bucket, r.rep, r.size, r.hub_rep, r.hub_size) for r in line_dedup.shared_keys(keyed).collect())
    assert got == [(10, 1, 5, 1, 5), (10, 2, 6, 1, 5), (12, 1, 5, 1, 5), (12, 2, 6, 1, 5), (12, 3, 7, 1, 5), (15, 8, 8, 8, 8), (15, 9, 10, 8, 8)]


def test_simhash_counts_words_and_blocks_find_three_flipped_bits(spark):
    line = "to be or not to be that is the question"
    row = spark.range(1).select(
        line_dedup.simhash(F.lit(line)).alias("bits"),
        F.array(*[F.xxhash64(F.lit(w)) for w in line.split()]).alias("words"),
    ).first()
    for k in range(64):
        votes = sum(w >> k & 1 for w in row["words"])
        assert (row.bits >> k & 1) == (votes > 5)
    rng = np.random.default_rng(1)
    for _ in range(20):
        other = row.bits ^ sum(1 << int(k) for k in rng.choice(63, 3, replace=False))
        keys = spark.createDataFrame([(row.bits,), (other,)], "b long").select(line_dedup.block_keys(F.col("b"))).collect()
        assert set(keys[0][0]) & set(keys[1][0])


def test_lines_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "a b\n\n--\nA  b!"), (4, "a b"), (None, "a b"), (4, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line_no", F.lit("x"))
    got = sorted(((r.doc_id, r.line_no, r.kept) for r in line_dedup.line_groups(docs).collect()), key=lambda r: (r[0] or 0, r))
    assert got == [(None, 0, True), (2, 0, True), (3, 0, False), (3, 1, True), (3, 2, True), (3, 3, False), (4, 0, False), (4, 0, False)]
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect() if r.text is not None) == [(0, "a b"), (2, ""), (3, "\n--"), (4, ""), (4, "")]
    assert line_dedup.line_groups(docs.limit(0)).count() == 0


def counts_of(text):
    return Counter(w for w in re.split("[\x20\x09-\x0d]+", text) if w)


def weighted_jaccard(a, b):
    a, b = counts_of(a), counts_of(b)
    return sum(min(a[w], b[w]) for w in a) / max(1, sum(max(a[w], b[w]) for w in a | b))


def test_fingerprints_collide_as_often_as_counts_overlap(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    rows = fingerprints.fingerprints(docs).orderBy("doc_id").collect()
    errors, by_text = [], {}
    for i, (text, row) in enumerate(zip(texts, rows, strict=True)):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
        errors += [row.near_edited - weighted_jaccard(text, edited), row.near_next - weighted_jaccard(text, following)]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1


def test_fingerprints_of_odd_rows(spark):
    rows = [(5, None), (7, "a"), (9000, "a b"), (9000, "a b"), (None, "ç é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("h", "block", "seq", "last")})
    found = sorted(fingerprints.fingerprints(docs).collect(), key=lambda r: (r.doc_id or 0, r.n_chars))
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in ("ç ", "", "a", "a a", "a ç")]
    assert [r.n_chars for r in found] == [3, 0, 1, 3, 3]
    assert [r.edited_sha256 for r in found[:3]] == sha[:3]
    assert sorted(r.edited_sha256 for r in found[3:]) == sorted(sha[3:])
    assert found[1].fingerprint == "" and found[1].near_edited == 1.0 and found[1].near_next == 0.0
    assert found[3].fingerprint == found[4].fingerprint
    alone = fingerprints.fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1.0
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0


def test_text_blocks_cover_all_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "", "b" * 50, "c"])], names=["t"])
    found = [x for _, texts in common.text_blocks(batch, "t", 12) for x in texts]
    assert found == [b"a" * 10, None, b"", b"b" * 50, b"c"]
