"""Mixing, shards, pseudonyms, main text, quality, URL lists and decontamination."""

import datetime
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobweft.llm import decontaminate, main_text, mixing, pseudonyms, quality, sharding, url_lists


def shared_out(sizes):
    """Targets by sharing again and again, as the contract words it."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full, target = 1.5 * sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sizes[s] if s in full else rest * weight[s] / open_weight for s in order}
        above = {s for s in order if s not in full and target[s] > 2 * sizes[s]}
        if not above:
            return target
        full |= above


def test_mix_meets_its_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise(F.col("source"))
    )
    rows = mixing.copies(docs).collect()
    assert sorted(rows) == sorted(mixing.copies(docs.repartition(5)).collect())
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.copies <= 2
    for source, target in shared_out(sizes).items():
        assert all(r.target == pytest.approx(target) for r in rows if r.source == source)
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6


def test_mix_expects_what_it_should(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(90)], "doc_id long, text string, source string")
    copies = defaultdict(list)
    for seed in range(6):
        for r in mixing.copies(docs, seed=seed).collect():
            copies[r.source].append(r.copies - r.target / r.source_size)
    assert all(abs(np.mean(v)) < 0.12 for v in copies.values())
    assert any(np.std(v) > 0.1 for v in copies.values())


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "x", "b"), (4, "z", "c"), (4, "z", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {c: F.lit("v") for c in ("size", "copies", "taken", "target", "id")}
    )
    units = mixing.copies(docs).collect()
    assert sum(r.copies_of for r in units) == 7
    assert all(r.copies <= 2 for r in units)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter((r.doc_id, r.source) for r in mixed.collect())
    assert got == {(r.id, r.source): r.copies * r.copies_of for r in units if r.copies}
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.copies(docs.limit(0)).count() == 0


def jump(key, shards):
    """One key at a time."""
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % 2**64
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_jump_hash_by_hand_and_growth():
    keys = np.array([0, 1, 2, 256, 123456789, -5, 2**62], np.int64)
    for shards in (1, 2, 40, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [jump(int(k) % 2**64, shards) for k in keys]
    many = np.arange(40000)
    old, new = sharding.jump_hash(many, 40), sharding.jump_hash(many, 41)
    assert set(new[old != new]) == {40}
    assert abs((old != new).mean() - 1 / 41) < 0.005
    assert abs(np.bincount(old) - 1000).max() < 150


def test_shards_are_numbered_without_gaps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("slot", F.lit("old"))
    placed = sharding.shard(docs, 7).collect()
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
        assert r.size == len(r.text.encode()) + 16 and r.shard == jump(r.doc_id, 7) and r.grown_shard == jump(r.doc_id, 8)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (1, "x")], "doc_id long, text string")
    rows = sharding.shard(odd, 1).collect()
    assert sorted(r.slot for r in rows) == [0, 1, 2, 3] and sorted(r.size for r in rows) == [16, 16, 16, 17]
    assert [r.text_crc32 for r in rows if r.text is None] == [None]
    assert sharding.shard(odd.limit(0), 3).count() == 0


def test_permutations_are_permutations():
    for size in (1, 2, 10, 997, 4096):
        p = pseudonyms.Permutation(b"key", "form", size)
        moved = [p.forward(i) for i in range(size)]
        assert sorted(moved) == list(range(size)) and [p.back(m) for m in moved] == list(range(size))
    assert len({pseudonyms.Permutation(k, "f", 10**6).forward(5) for k in (b"a", b"b")}) == 2


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10


@pytest.mark.parametrize(
    "value,form",
    [
        ("4111 1111 1111 1111", "card"), ("5500005555555559", "card"), ("1234567812345678", "card"),
        ("DE89 3704 0044 0532 0130 00", "iban"),
        ("2024-02-29", "date"), ("31.12.1999", "date"), ("12/31/1999", "date"), ("2023-02-29", None),
        ("192.168.0.255", "address"), ("192.168.0.256", None), ("+1 (826) 555-4081", "phone"), ("555-867-5309", "phone"),
        ("219-09-9999", "national"), ("666-09-9999", None), ("some.name7@mail.example.org", "email"),
        ('"908038b7daaf91e730d2f64001c52934d43d9336"', "secret"), ("12345", None), ("3.14159", None),
    ],
)
def test_values_keep_their_form(value, form):
    text = f"see {value}, or {value} again"
    fresh, spans = pseudonyms.pseudonymise(text, pseudonyms.Forms(b"k"))
    if form is None:
        assert (fresh, spans) == (text, [])
        return
    assert [s[0] for s in spans] == [form, form]
    new = {fresh[a : a + n] for _, a, n in spans}
    assert len(new) == 1 and value.strip('"') not in fresh
    value, (new,) = value.strip('"'), new
    assert form == "address" or len(new) == len(value)
    if form == "card":
        assert luhn(new.replace(" ", "")) == luhn(value.replace(" ", ""))
    back, _ = pseudonyms.pseudonymise(fresh, pseudonyms.Forms(b"k", inverse=True))
    assert back == text


def test_letters_in_an_account_number_survive():
    fresh, spans = pseudonyms.pseudonymise("GB82 WEST 1234 5698 7654 32", pseudonyms.Forms(b"k"))
    packed = fresh.replace(" ", "")
    assert spans[0][0] == "iban" and packed[4:8] == "WEST"
    assert int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1


@pytest.mark.parametrize(
    "iban", ["ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "SE4550000000058398257466", "PL61 1090 1014 0000 0712 1981 2874"]
)
@pytest.mark.parametrize("after", [" EUR", " BIC GEBABEBB", " 2024", " ACCOUNT HOLDER", " A", ", EUR", ""])
def test_what_follows_an_account_number_is_not_part_of_it(iban, after):
    alone, _ = pseudonyms.pseudonymise(iban, pseudonyms.Forms(b"k"))
    fresh, spans = pseudonyms.pseudonymise(f"to {iban}{after}", pseudonyms.Forms(b"k"))
    assert alone != iban and fresh == f"to {alone}{after}" and spans == [("iban", 3, len(iban))]
    assert pseudonyms.pseudonymise(fresh, pseudonyms.Forms(b"k", inverse=True))[0] == f"to {iban}{after}"


def test_an_account_number_may_end_with_letters():
    body = "MALT011000012345MTLCASTABCD"
    check = 98 - int("".join(str(int(c, 36)) for c in body + "MT00")) % 97
    packed = f"MT{check:02d}{body}"
    iban = " ".join(packed[i : i + 4] for i in range(0, 31, 4))
    fresh, spans = pseudonyms.pseudonymise(f"see {iban} now", pseudonyms.Forms(b"k"))
    assert spans == [("iban", 4, len(iban))] and iban not in fresh


def test_slash_dates_are_permuted_and_come_back():
    """All texts of ten years, in both readings: no two become one, and all are undone."""
    there, back = pseudonyms.Forms(b"k"), pseudonyms.Forms(b"k", inverse=True)
    day, texts = datetime.date(1950, 1, 1), set()
    while day.year < 1960:
        texts |= {day.strftime("%m/%d/%Y"), *([day.strftime("%d/%m/%Y")] if day.day > 12 else [])}
        day += datetime.timedelta(1)
    fresh = {t: there.date(t) for t in texts}
    assert len(set(fresh.values())) == len(texts) and all(back.date(f) == t for t, f in fresh.items())
    assert there.date("13/13/1950") is None and there.date("02/30/1950") is None


@pytest.mark.parametrize("name", ["a" * 70, "jürgen.groß", "и" * 100 + "7", "мария", "x" * 40 + "." + "y" * 80, "李雷", "a+b_c-d"])
def test_mail_names_of_any_length_and_script(name):
    text = f"5 see {name}@example.org now"
    fresh, spans = pseudonyms.pseudonymise(text, pseudonyms.Forms(b"k"))
    assert [s[0] for s in spans] == ["email"] and spans[0][2] == len(name) + 12
    shown = fresh[spans[0][1] : spans[0][1] + len(name)]
    letters = [(a, b) for a, b in zip(name, shown) if a.isalpha()]
    assert all(b.isalpha() for _, b in letters) and sum(a == b for a, b in letters) <= max(1, len(letters) // 4)
    assert pseudonyms.pseudonymise(fresh, pseudonyms.Forms(b"k", inverse=True))[0] == text


def test_finder_equals_trying_every_place():
    """Values in long texts without other digits, against a search that starts at every character."""
    rng = np.random.default_rng(2)
    values = ["12/24/1959", "GB82 WEST 1234 5698 7654 32", "+1 555 123 4567", "a.b@x.org", "4111 1111 1111 1111", "10.0.0.7", "z" * 90 + "@y.net"]
    forms = pseudonyms.Forms(b"k")
    for _ in range(40):
        text = " ".join(rng.choice(values) if rng.random() < 0.3 else "word" * int(rng.integers(1, 30)) for _ in range(20))
        want, at = [], 0
        while found := pseudonyms.FINDER.search(text, at):
            form, (start, last) = found.lastgroup, found.span()
            fresh = None
            for last in pseudonyms.iban_ends(text, start, last) if form == "iban" else [last]:
                fresh = getattr(forms, form)(text[start:last])
                if fresh is not None:
                    want.append((form, start, last, fresh))
                    break
            at = start + 1 if fresh is None else last
        assert list(pseudonyms.replacements(text, forms)) == want


def test_personal_data_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "call +1 (826) 555-4081 190.137.223.204 now"), (4, "+1 (826) 555-4081"), (None, "x" * 100000 + " 4111111111111111")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    found = {r.doc_id: r for r in pseudonyms.replace_personal_data(docs, b"k").collect()}
    assert found[1].text is None and found[2].text == "" and found[1].n_replaced == 0
    assert found[3].n_replaced == 2 and "555-4081" not in found[3].text
    assert found[4].text in found[3].text
    assert found[None].n_replaced == 1 and len(found[None].text) == 100017
    assert pseudonyms.replace_personal_data(docs.limit(0), b"k").count() == 0


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "source,text",
    [
        (page("<nav><ul><li>Home</ul></nav><article><h1>A &amp; B</h1><p>x\n  y<br>z<p>w</article><footer>f</footer>"), "A & B\nx y z\nw"),
        (page("<div class='cookie-notice'>no</div><main><p>yes<div class=ad>buy</div></main><aside>s</aside>"), "yes"),
        (page("<article><p>one</p><script>var t='</p>';</script><form><p>mail</p></form><section id='comments'><article>r</article></section></article>"), "one"),
        (page("<header>Site</header><article><header><h1>Title</h1></header><p>text</p></article>"), "Title\ntext"),
        (page("<div id=content><ul><li>1<li>2</ul><table><tr><td>c<td>d</table></div><div>other</div>"), "1\n2\nc\nd"),
        ("just text &lt;b&gt; <b>bold", "just text <b> bold"),
        (page("<article><p>cut <b>off<!-- x"), "cut off"),
        ("", ""), ("<", "<"), (page("<p hidden>h</p><p>v</p>"), "v"),
    ],
)
def test_main_text_of_a_page(source, text):
    assert main_text.Page(source).text() == text


@pytest.mark.parametrize(
    "source,text",
    [
        (page("<main class='overflow-hidden'><p>a</p></main>"), "a"),
        (page("<div class='md:hidden' style='overflow: hidden'><article><p>a</p></article></div>"), "a"),
        (page("<article style='display: none'><p>a</p></article><p>b</p>"), "b"),
        (page("<div class='has-sidebar'><article class='no-comments'><p>a</p></article></div><p>b</p>"), "a"),
        (page("<div class='content with-sidebar'><p>a</p></div><p>b</p>"), "a"),
        (page("<div class='sidebar-layout'><main><p>a</p></main><div class='ads'>b</div></div>"), "a"),
        (page("<div class='widget-page'><article><p>a long text</p></article></div><p>b</p>"), "a long text"),
        (page("<div class='related'><article><p>teaser</p></article></div><article><p>a</p></article>"), "a"),
        ("<html><head><title>T</title><meta charset=utf-8><body><article><p>a</p></article></body></html>", "a"),
        ("<html><head><title>T</title><p>a</p>", "a"),
        (page("<form><div><article><p>a</p></article></div></form>"), "a"),
        (page("<form action='x'><p>a</p><p>b</p></form>"), "a\nb"),
        (page("<form><h1>t</h1><p>words</p></form><div>x</div>"), "t\nwords\nx"),
    ],
)
def test_an_article_is_not_lost_through_what_is_around(source, text):
    assert main_text.Page(source).text() == text


def test_templates_of_a_host_are_removed(spark):
    box = "<div><p>Read our other offers</p></div>"
    rows = [(i, f"http://h.example.com/{i}", page(f"{box}<div><p>own text {i}</p></div>")) for i in range(12)]
    rows += [(20, "http://g.example.com/", page(f"{box}<div><p>alone</p></div>"))]
    rows += [(30 + i, "http://c.example.com/", page("<article><p>copied everywhere</p></article>")) for i in range(12)]
    rows += [(50 + i, f"http://d.example.com/{i}", page(f"<article><p>said often</p><p>own {i}</p></article>")) for i in range(12)]
    rows += [(80, None, None), (81, "no url", ""), (82, "http://h.example.com/1", rows[1][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "templates", "text")})
    found = {r.page_id: r for r in main_text.main_text(pages).collect()}
    assert len(found) == len(rows)
    assert [found[i].text for i in range(12)] == [f"own text {i}" for i in range(12)] and found[82].text == "own text 1"
    assert found[20].text == "Read our other offers\nalone"
    assert found[30].text == "copied everywhere" and found[50].text == "said often\nown 0"
    assert found[80].text == "" and found[81].n_chars == 0
    assert main_text.main_text(pages.limit(0)).count() == 0


def test_rotating_adverts_and_menus_of_sections_are_removed_from_a_hot_host(spark):
    def body(i):
        advert, menu = f"<div><p>Buy product {i % 12} today</p></div>", f"<div><ul><li>Part {i % 10}<li>of the site</ul></div>"
        return page(f"{menu}<div><p>own text {i}</p></div>{advert}")

    rows = [(i, f"http://hot.example.com/s{i % 10}/{i}", body(i)) for i in range(400)]
    rows += [(1000 + i, f"http://small.example.com/{i}", page(f"<div><p>Our offers</p></div><div><p>own {i}</p></div>")) for i in range(5)]
    rows += [(2000 + i, f"http://two.example.com/{i}", page(f"<div><p>Our offers</p></div><div><p>own {i}</p></div>")) for i in range(2)]
    found = {r.page_id: r.text for r in main_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[i] for i in range(400)] == [f"own text {i}" for i in range(400)]
    assert [found[1000 + i] for i in range(5)] == [f"own {i}" for i in range(5)]
    assert found[2000] == "Our offers\nown 0"


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    from jobweft.llm import catalog

    rows = catalog.op6_quality(spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([a == b for a, b in held]) > 0.9
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "good words here " * 50), (4, "$$$ ### " * 50), (None, "x")], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("old")).withColumn("label", F.lit(5))
    labels = spark.createDataFrame([(3, 1), (4, 0), (1, 1), (9, 0), (2, 7), (None, 1)], "id long, label int")
    model = quality.train(docs, labels)
    rows = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(rows) == 5 and all(0 <= v <= 1 for v in rows.values()) and rows[1] == rows[2]
    empty = quality.train(docs.limit(0), labels)
    assert {r.score for r in quality.score(docs, empty).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize(
    ("kind", "pattern", "hits"),
    [
        ("prefix", "example.com/ads/", [2, 3]), ("prefix", "https://Example.com:443/ads?x=1", [2, 3]), ("prefix", "example.com//ads", [2, 3]),
        ("prefix", "example.com/", [1, 2, 3, 4, 6]), ("prefix", "example.com/Ads", [4]), ("host", " example.com. ", [1, 2, 3, 4, 6]),
        ("domain", "user@EXAMPLE.com:80", [1, 2, 3, 4, 5, 6]), ("host", "", []), ("prefix", "/ads", []), ("host", None, []),
    ],
)
def test_entries_are_read_as_urls_are(spark, kind, pattern, hits):
    at = datetime.datetime(2024, 5, 1)
    urls = ["http://example.com", "http://example.com/ads/x", "https://EXAMPLE.COM:8080//ads?q", "http://u@example.com./Ads", "ftp://a.example.com/", "http://example.com/x#ads"]
    captures = spark.createDataFrame([(n, u, at) for n, u in enumerate(urls, 1)], "id long, url string, fetched_at timestamp")
    entries = spark.createDataFrame([("l", kind, pattern, "block", at)], "list string, kind string, pattern string, action string, effective_at timestamp")
    assert sorted(r.id for r in url_lists.filter_urls(captures, entries).where("blocked").collect()) == hits


def test_url_lists_over_time(spark):
    day = lambda d: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d)
    entries = spark.createDataFrame(
        [
            ("bad", "domain", "Example.com", "block", day(10)), ("bad", "domain", "example.com", "remove", day(100)),
            ("bad", "domain", "example.com", "block", day(200)), ("ok", "prefix", "a.example.com/en", "allow", day(50)),
            ("tie", "host", "b.org", "allow", day(5)), ("tie", "host", "b.org", "block", day(5)), ("tie", "host", "b.org", "block", day(5)),
            (None, "host", "c.org", "block", day(1)), ("bad", "odd", "c.org", "block", day(1)),
        ],
        "list string, kind string, pattern string, action string, effective_at timestamp_ntz",
    )
    urls = [
        ("http://example.com/", 9), ("http://example.com/", 10), ("http://A.example.com:80/x", 99), ("http://example.com/", 100),
        ("http://example.com", 400), ("https://u@a.example.com/en/1?q", 60), ("http://notexample.com/", 20), ("http://b.org", 6),
        ("http://c.org/", 50), (None, 20), ("no url", 20), ("http://b.org", None), ("http://b.org", 6),
    ]
    captures = spark.createDataFrame(
        [(u, None if d is None else day(d)) for u, d in urls], "url string, fetched_at timestamp_ntz"
    ).withColumns({c: F.lit(1) for c in ("lists", "key", "month")})
    found = url_lists.filter_urls(captures, entries)
    got = Counter((r.url, r.fetched_at and (r.fetched_at - day(0)).days, r.lists, r.blocked) for r in found.collect())
    want = ["", "bad", "bad", "", "bad", "bad,ok", "", "tie", "", "", "", "", "tie"]
    blocked = [w != "" and w != "bad,ok" for w in want]
    assert got == Counter((u, d, w, b) for (u, d), w, b in zip(urls, want, blocked, strict=True))
    assert url_lists.filter_urls(captures.limit(0), entries).count() == 0
    assert {r.blocked for r in url_lists.filter_urls(captures, entries.limit(0)).collect()} == {False}


def test_decontamination_finds_copies_and_paraphrases(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"term{i}" for i in range(3000)]
    prose = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, prose(40) + ". " + prose(5)) for i in range(12)] + [(50, "Question " + prose(30) + " Answer: forty two"), (51, None), (None, prose(30)), (52, " ")]
    texts = dict(items)
    words = texts[3].split()
    loose = " ".join(w for i, w in enumerate(words) if i % 5)
    asked = texts[50].split()
    with_answer = " ".join(w for i, w in enumerate(asked[:31]) if i % 5 not in (1, 3)) + " Answer: forty two"
    docs = [(i, prose(300)) for i in range(60)]
    docs += [(100, prose(80) + " " + texts[1] + " " + prose(80)), (101, (prose(60) + " " + texts[2]).upper()), (102, prose(50) + " " + loose + " " + prose(50)),
             (103, prose(40) + " " + with_answer + " " + prose(40)), (104, None), (105, ""), (None, texts[5]), (106, " ".join(rng.permutation(words)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("item_id", "words", "cosine")})
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contaminations(frame, bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in rows) == [(0, 5), (100, 1), (101, 2), (102, 3), (103, 50)]
    assert {r.doc_id: r.word_order for r in rows}[100] == 1.0
    left = decontaminate.clean(frame, bench)
    assert left.columns == frame.columns and left.count() == len(docs) - 4
    assert decontaminate.contaminations(frame, bench.limit(0)).count() == 0
    assert decontaminate.contaminations(frame.limit(0), bench).count() == 0


def test_common_order_by_table():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = ([b"abcdef"[k : k + 1] for k in rng.integers(0, 6, n)] for n in (rng.integers(1, 20), 25))
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_order(b, masks, len(a)) == table[-1, -1]


def test_latent_space_is_the_truncated_svd(spark):
    bench = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 17}" for k in range(1, 9))) for i in range(30)], "item_id long, text string")
    parts = decontaminate.passages(bench, "item_id", "text")
    weights = np.ones(1 << decontaminate.HASH_BITS)
    space = decontaminate.latent_space(parts, weights)
    dense = np.zeros((30, len(space.vocabulary)))
    for n, row in enumerate(parts.collect()):
        at, counts = np.unique(decontaminate.places([bytes(w) for w in row.words]), return_counts=True)
        dense[n, np.searchsorted(space.vocabulary, at)] = counts / np.linalg.norm(counts)
    kept = dense @ space.basis @ space.basis.T
    assert np.allclose(kept, dense, atol=1e-4)


def test_a_part_of_a_name_drops_no_prose_of_an_article():
    body = (
        "<article><h1>T</h1><p>One.</p><p class='share-price'>Two.</p><section class='related-work'><h2>R</h2><p>Three.</p></section>"
        "<p>Let <math><mi>x</mi></math> be.</p><div class='share-bar'><a>tweet</a></div><div class='comments'><p>nice</p></div>"
        "<section class='comments'><p>bad</p></section></article>"
    )
    assert main_text.Page(f"<body>{body}</body>").text() == "T\nOne.\nTwo.\nR\nThree.\nLet x be."
