"""Lexical search, byte-pair encoding and Merkle proofs against plain versions."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobweft.llm import bpe, catalog, lexical_search, manifest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"

# Lexical search


def terms(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))


def ranked(docs, items, top):
    """Every document scored for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked, out = {}, []
    for i, text in items:
        asked.setdefault(i, Counter()).update(terms(text))
    for item, wanted in asked.items():
        scores = []
        for doc, c in counted:
            m = 75 + 25 * sum(c.values()) * n // max(total, 1)
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, times in wanted.items() if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def found(docs, items, **options):
    return sorted(map(tuple, lexical_search.search(docs, items, **options).collect()), key=repr)


def test_search_equals_scoring_everything(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    rows = docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect()
    # One document a block leaves each block with fewer than ``top``; three items travel together.
    for block, bundle, top in ((8192, 256, 20), (7, 3, 5), (1, 256, 3)):
        monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
        monkeypatch.setattr(lexical_search, "BUNDLE_ITEMS", bundle)
        assert found(docs, items, top=top) == ranked(*rows, top)


def test_search_without_a_vocabulary_in_every_task(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    want = found(docs, items)
    monkeypatch.setattr(lexical_search, "VOCABULARY_BYTES", 0)
    assert found(docs, items) == want


def test_search_of_odd_rows(spark):
    rows = [
        (1, "Alpha beta"), (1, "Alpha beta"), (2, None), (3, ""), (4, "-- !"), (None, "alpha"), (None, "alpha"), (5, "ÄRGER Über beta"),
        (6, "gamma " * 50000), (-7, "alpha beta"), (8, "beta\x00beta_beta"), (9, "delta"), (10, "delta"), (11, "x1 22"),
    ]
    asked = [(1, "ALPHA alpha, beta"), (2, None), (3, "..."), (None, "gamma"), (4, "delta"), (4, "ÄRGER"), (5, "nowhere"), (6, "22")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("v") for c in ("term", "block", "rank", "item_id")})
    items = spark.createDataFrame(asked, "item_id long, text string").withColumns({c: F.lit(1) for c in ("bundle", "score", "doc_id")})
    got = found(docs, items, top=3)
    assert got == ranked(rows, asked, 3)
    assert {r[2] for r in got if r[0] == 1} == {-7, 1}
    for empty in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id IN (2, 3, 4)"), items)):
        assert found(*empty) == []


# Byte-pair encoding

PIECES = [
    "a", "b", "the", " ", "  ", "\n", "\t\t", "'s", "'", "'re", "'r", "'ll", "1", "22", "!", "??", "é", "日本", "🙂", "<|endoftext|>",
    "<|endoftext", "՘", " ", "x" * 30, "ÃÂ" * 10, " " * 9, "\x1c", "\x85", "I'll", "\u0000", "'ve ", "፡", "١٢",
]


@pytest.fixture(scope="module")
def vocabulary():
    with open(catalog.tokenizer_path(), "rb") as file:
        return bpe.Vocabulary(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_equals_the_library(vocabulary, library):
    rng = random.Random(5)
    encoders = [bpe.Encoder(vocabulary, window) for window in (8, 9, 64, 1 << 16)]
    for _ in range(3000):
        text = "".join(rng.choices(PIECES, k=rng.randrange(30)))
        want = library.encode(text, add_special_tokens=False).ids
        for encoder in encoders:
            assert list(encoder.ids(text)) == want, text


@pytest.mark.parametrize("letters", ["ab", "aeiou", "ÃÂ", "abcdefghijklmnopqrstuvwxyz", "a", " ", "-=", "0123456789", "日本語", " \n"])
def test_long_pieces_are_streamed(vocabulary, library, letters):
    rng = random.Random(7)
    text = "".join(rng.choices(letters, k=30000))
    want = library.encode(text, add_special_tokens=False).ids
    for window in (8, 1000, 1 << 16):
        assert list(bpe.Encoder(vocabulary, window).ids(text)) == want


def test_transducer_emits_only_what_is_final(vocabulary):
    rng = random.Random(9)
    assert 0 < vocabulary.lookahead < 1000
    for letters in ("ab", "ÃÂ", "etaoin"):
        transducer, data, out, most = bpe.Transducer(vocabulary), b"", [], 0
        for _ in range(200):
            part = "".join(rng.choices(letters, k=rng.randrange(120))).encode()
            data += part
            out += transducer.feed(part)
            most = max(most, len(transducer.held))
            # What was emitted stays the beginning, whatever follows.
            for later in (b"", b"a" * 50, "ÂÃ".encode() * 40):
                assert vocabulary.merged(data + later)[: len(out)] == out
        assert most < transducer.block
        assert out + transducer.finish() == vocabulary.merged(data)


def test_lookahead_of_a_small_list(vocabulary):
    """Two texts that part after ``n`` bytes agree but for the lookahead, and the bound is met."""
    letters = bpe.byte_letters()
    names = {c: n for n, c in enumerate(sorted(letters))}
    merges = [("b", "c"), ("a", "bc"), ("a", "b"), ("ab", "ab")]
    vocab = names | {u + v: 256 + n for n, (u, v) in enumerate(merges)}
    file = {
        "model": {"type": "BPE", "vocab": vocab, "merges": [list(m) for m in merges]},
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
    }
    small = bpe.Vocabulary(json.dumps(file).encode())
    assert small.lookahead == 4  # "abab" is one token, but "ababc" is "ab" and "abc"
    rng, worst = random.Random(3), 0
    for _ in range(4000):
        start = "".join(rng.choices("abc", k=12)).encode()
        ends = []
        for _ in range(2):
            at, cuts = 0, {0}
            for token in small.merged(start + "".join(rng.choices("abc", k=6)).encode()):
                at += len(small.bytes_of[token])
                cuts.add(at)
            ends.append(cuts)
        worst = max(worst, len(start) - max(c for c in ends[0] & ends[1] if c <= len(start)))
    assert worst == 4
    with pytest.raises(ValueError):
        bpe.Vocabulary(json.dumps(file | {"model": {**file["model"], "merges": [["a", "bc"], ["b", "c"]]}}).encode())


def test_decoder_waits_for_whole_characters(vocabulary, library):
    rng = random.Random(11)
    ids = rng.choices(range(50257), k=4000)
    decoder = bpe.Decoder(vocabulary)
    parts = [decoder.feed([i]) for i in ids]
    assert "".join(parts) + decoder.feed([], last=True) == library.decode(ids, skip_special_tokens=False)
    split = library.encode("🙂", add_special_tokens=False).ids
    decoder = bpe.Decoder(vocabulary)
    assert [decoder.feed([i]) for i in split] == [""] * (len(split) - 1) + ["🙂"]


def test_bpe_query_equals_the_library(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = catalog.op12_bpe(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        hashes = [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), text)]
        assert [r.n_tokens, r.ids_sha256, r.decoded_sha256] == [len(ids), *hashes]


def test_bpe_of_odd_rows(spark, library):
    texts = [None, "", "  ", "a<|endoftext|>b", "x" * 300000, " " * 200000 + "y", "the " * 50000, "the"]
    rows = [(n if n != 3 else None, t) for n, t in enumerate([*texts, "the"])] + [(7, "the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("v") for c in ("ids", "decoded")})
    path = catalog.tokenizer_path()
    got = bpe.decode(bpe.encode(docs, path), path).collect()
    assert sorted(repr((r.doc_id, r.decoded)) for r in got) == sorted(repr((i, t or "")) for i, t in rows)
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 99999999, -1]), (4, [None, 64])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(odd, path).collect()} == {1: "", 2: "", 3: "", 4: library.decode([64])}
    assert bpe.decode(bpe.encode(docs.limit(0), path), path).count() == 0


# Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def proofs(rows):
    """``(doc_id, leaf, subroot, root, proof, folded)`` by lists of levels; rows are ids, texts, languages, sources, sizes."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    def beside(tree, at):
        return [((at >> k) & 1, "".join(level[(at >> k) ^ 1 : ((at >> k) ^ 1) + 1])) for k, level in enumerate(tree[:-1])]

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for group in groups.values():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in groups[g]]) for g in langs]
    crown, out = tree([t[-1][0] for t in trees]), []
    for i, g in enumerate(langs):
        for at, row in enumerate(groups[g]):
            path = beside(trees[i], at) + beside(crown, i)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None
            folded = leaf((*row[:4], row[4] + 1) if tampered else row)
            for right, other in path:
                folded = sha(other + folded if right else folded + other)
            out.append((row[0], leaf(row), trees[i][-1][0], crown[-1][0], sha("".join(h for _, h in path)), folded))
    return sorted(out, key=repr)


def proven(docs):
    rows = manifest.document_proofs(docs)
    folded = manifest.folded(F.coalesce("altered", "leaf"), F.col("path"))
    proof = manifest.digest(manifest.sibling_text(F.col("path")))
    return sorted(map(tuple, rows.select("doc_id", "leaf", "subroot", "root", proof, folded).collect()), key=repr)


def test_proofs_over_several_rounds_of_blocks(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    want = proofs([tuple(r) for r in docs.collect()])
    assert proven(docs) == want and proven(docs.repartition(7)) == want
    # 127 leaves of a language are 32 blocks, then 8, 2 and 1.
    monkeypatch.setattr(manifest, "DEPTH", 2)
    monkeypatch.setattr(manifest, "BLOCK", 4)
    assert proven(docs) == want


def test_proofs_of_odd_rows(spark):
    rows = [
        (1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", "en", None, None), (None, None, None, None, None), (None, "x", "en", "s", 2),
        (2, "", "", "", 0), (3, "ü\n" * 100000, "fr", "s", 200000), (4, "c", "é", "s", 2**63 - 1), (5, "c", "z", "s", -1), (6, "c", "z", "s", 3), (7, "c", "z", "s", 3),
    ] + [(20 + k, "t", "hot", "s", k) for k in range(40)]
    docs = spark.createDataFrame(rows, DOCUMENT).withColumns({c: F.lit("v") for c in ("grp", "at", "n", "hash", "path", "root", "leaf")})
    assert proven(docs) == proofs(rows)
    lone = docs.where("lang = 'fr'")
    (row,) = manifest.document_proofs(lone).collect()
    assert row.leaf == row.subroot == row.root and row.path == []
    assert manifest.document_proofs(docs.limit(0)).count() == 0
