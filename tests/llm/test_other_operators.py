import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, invented
from tidemark.llm import decontamination, fingerprints, html_text


def sentence(rng, n):
    return invented(rng, n).capitalize() + "."


@pytest.fixture
def bench(spark):
    rng = random.Random(2)
    items = [sentence(rng, rng.randint(14, 40)) for _ in range(20)] + ["Tom Smith ran 12 km in 3 hours while his sister walked 7 km in the same time on a cold day in spring.", "too short", "", None]
    return items, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_leaks(spark, bench):
    items, table = bench
    rng = random.Random(4)
    docs = {i: sentence(rng, rng.randint(5, 80)) + " " + sentence(rng, 30) for i in range(100)}
    planted = {}
    for i in range(0, 100, 4):
        planted[i] = i // 4 % 20
        w = docs[i].split()
        w.insert(rng.randrange(len(w)), items[planted[i]])
        docs[i] = " ".join(w)
    got = decontamination.leaks(spark.createDataFrame([(i, t, None, None, None) for i, t in docs.items()], SCHEMA).repartition(4), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(planted.items()) and all(r.verbatim for r in got)


def test_other_numbers_names_and_units(spark, bench):
    _, table = bench
    same = "We know that Ann Lee ran 15 miles in 4 hours while his sister walked 9 miles in the same time on a cold day in spring."
    mixed = same.replace("9 miles", "9 kg")
    docs = spark.createDataFrame([(0, same, None, None, None), (1, mixed, None, None, None), (2, "It was a cold day in spring, 12 km from here.", None, None, None)], SCHEMA)
    got = {r.doc_id: r for r in decontamination.leaks(docs, table).collect()}
    assert got[0].item_id == 20 and not got[0].verbatim and got[0].longest_run >= 13
    assert 2 not in got and (1 not in got or got[1].longest_run < got[0].longest_run)


def test_slots_must_agree():
    v = lambda *p: b"".join(bytes([j]) + x.to_bytes(8, "little") for j, x in p)
    agreeing = [(k, k, v((1, 5)), v((1, 9))) for k in range(5)]
    kept, same = decontamination.consistent([*agreeing, (9, 9, v((1, 6)), v((1, 9)))])
    assert kept == [(k, k) for k in range(5)] and not same
    assert decontamination.longest_run(kept) == decontamination.WINDOW + 4
    assert decontamination.longest_run([(0, 0), (50, 8)]) == decontamination.WINDOW


def test_copies_are_judged_alone(spark):
    rng = random.Random(31)
    before, between, after = (invented(rng, 7) for _ in range(3))
    say = lambda number, name: f"{before} {number} {between} with {name} {after}"
    table = spark.createDataFrame([(1, say(41, "Anna"))], "item_id long, text string")
    copies = [say(n, who) for n, who in ((52, "Boris"), (63, "Clara"), (74, "Dorothea"), (85, "Emil"))]
    texts = {1: " . ".join(copies), 2: f"{copies[0]} . {say(41, 'Anna')}", 3: copies[1], 4: invented(rng, 60)}
    got = {r.doc_id: r for r in decontamination.leaks(spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], SCHEMA), table).collect()}
    assert set(got) == {1, 2, 3} and [got[i].verbatim for i in (1, 2, 3)] == [False, True, False]
    v = lambda j, x: bytes([j]) + x.to_bytes(8, "little")
    # two copies, of which the votes over both would take the number of one and the name of the other
    one = [(p, p, v(6 - p, 5) + v(7 - p, 2), v(6 - p, 1) + v(7 - p, 9)) for p in range(6)]
    two = [(100 + p, p, v(6 - p, 4) + v(7 - p, 3), v(6 - p, 1) + v(7 - p, 9)) for p in range(6)]
    assert decontamination.longest_run(decontamination.consistent([*one, *two])[0]) == 0
    assert decontamination.held([*one, *two], decontamination.RUN) == (set(range(6)), 13, False)


def test_short_items_and_items_of_few_literals(spark):
    rng = random.Random(37)
    nine = f"Which {invented(rng, 8)}"
    slots = " plus ".join(str(7 * k) for k in range(1, 20))
    items = {1: "What is 17 + 25?", 2: "Why do birds sing?", 3: nine, 4: slots, 5: "How many apples does the baker sell to Anna"}
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    fill = lambda: invented(rng, 15)
    texts = {i: f"{fill()} {t} {fill()}" for i, t in items.items()}
    texts |= {11: f"{fill()} what is 17 + 26? {fill()}", 12: f"{fill()} birds do sing {fill()}", 13: f"{fill()} {nine} {fill()}".upper(),
              14: f"{fill()} {slots[:30]} {fill()}", 15: f"{fill()} how many apples does the baker sell to Boris {fill()}", 16: fill()}
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], SCHEMA)
    got = {(r.doc_id, r.item_id): r for r in decontamination.leaks(docs, table).collect()}
    assert set(got) == {(i, i) for i in items} | {(13, 3), (15, 5)}
    assert all(r.verbatim == (r.doc_id != 15) for r in got.values())


def test_leaks_odd_rows(corpus, empty, bench, spark):
    _, table = bench
    assert decontamination.leaks(corpus, table).collect() == [] and decontamination.leaks(empty, table).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(corpus, none).collect() == []
    own = corpus.select(F.lit(1).cast("long").alias("item_id"), "text").where("length(text) between 200 and 900").limit(1)
    assert decontamination.leaks(corpus, own).count() >= 1


def naive_anchors(text):
    """By the definition, with whole numbers: the k-mers whose least 6-mer stands first or last."""
    top = 1 << 64

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % top
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB % top
        return x ^ (x >> 31)

    def six(part):
        return mix(sum((ord(c) + 1) * (mix(((k + 1) * 0x9E3779B97F4A7C15 + 131) % top) | 1) for k, c in enumerate(part)) % top)

    out = []
    for at in range(len(text) - 19):
        inner = [six(text[at + k : at + k + 6]) for k in range(15)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(at)
    return out


def test_anchors_depend_on_their_own_letters(monkeypatch):
    rng = random.Random(6)
    text = invented(rng, 60)
    at, h = fingerprints.anchors(fingerprints.code_points(text))
    assert at.tolist() == naive_anchors(text) and len(at) > len(text) / 12
    gaps = np.diff(at)
    assert gaps.max() <= fingerprints.K - fingerprints.S
    moved, g = fingerprints.anchors(fingerprints.code_points("xyz" + text))
    assert set(zip((at + 3).tolist(), h.tolist(), strict=True)) <= set(zip(moved.tolist(), g.tolist(), strict=True))
    monkeypatch.setattr(fingerprints, "CHUNK", 50)
    again, k = fingerprints.anchors(fingerprints.code_points(text))
    assert again.tolist() == at.tolist() and k.tolist() == h.tolist()
    assert (fingerprints.sketches([fingerprints.code_points(text)])[0] >= 0).any()
    assert fingerprints.matches(text, "xyz" + text)[0][1] - fingerprints.matches(text, "xyz" + text)[0][0] == 3


@pytest.mark.parametrize("range_chars", [3_000, 10**9])
def test_fingerprints(corpus, range_chars):
    got = fingerprints.fingerprints(corpus.repartition(6), range_chars).collect()
    rows = [(r.doc_id, r.text or "") for r in corpus.select("doc_id", "text", F.xxhash64("text").alias("h")).orderBy(F.col("doc_id").asc_nulls_first(), "h").collect()]
    want = []
    for k, (d, t) in enumerate(rows):
        then = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + then[:half]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 2 + 128 * 12 and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert len(by[0]) == 1
    text = invented(random.Random(1), 300)
    assert likeness(text, text[:-20]) > 0.8 and likeness(text, text[::-1]) < 0.1 and likeness(text, text) == likeness("", "") == 1


def likeness(x, y):
    (a, b), (p, q) = fingerprints.sketches([fingerprints.code_points(t) for t in (x, y)])
    return fingerprints.likeness(a[None], b[None], p[None], q[None])[0]


def test_likeness_goes_by_places():
    rng = random.Random(8)
    parts = [invented(rng, 60) for _ in range(8)]
    text = " ".join(parts)
    shuffled = " ".join(reversed(parts))
    moved = "before all " * 20 + text
    assert likeness(text, moved) > 0.85
    assert likeness(text, shuffled) < 0.35
    sketch, place = fingerprints.sketches([fingerprints.code_points(text)])
    at, h = fingerprints.anchors(fingerprints.code_points(text))
    for b in range(fingerprints.BINS):
        own = [(int(x >> np.uint64(40)), p) for p, x in zip(at.tolist(), h, strict=True) if int(x) % fingerprints.BINS == b]
        assert (sketch[0, b], place[0, b]) == min(own) if own else sketch[0, b] == -1
    made = fingerprints.as_text(sketch, place, [len(text)])[0]
    one = 2 + 12 * 5
    assert made[:2] == "00" and (sketch[0, 5] < 0 or int(made[one : one + 6], 16) == sketch[0, 5] and int(made[one + 6 : one + 12], 16) == place[0, 5])
    brute = [5, 1, 4, 2, 2, 3, 0]
    assert fingerprints._chain(brute) == max(len(c) for n in range(8) for c in __import__("itertools").combinations(brute, n) if list(c) == sorted(c))


def test_every_text_has_an_anchor():
    rng = random.Random(17)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in range(1, 40) for _ in range(8)]
    points = [fingerprints.code_points(t) for t in texts]
    assert any(len(p) >= fingerprints.K and not len(fingerprints._kmers(p)[0]) for p in points)
    together, place = fingerprints.sketches([fingerprints.code_points(""), *points])
    assert (together[0] < 0).all() and (together[1:] >= 0).any(1).all()
    for t, p, sketch in zip(texts, points, together[1:], strict=True):
        assert len(fingerprints.anchors(p)[0]) and (fingerprints.sketches([p])[0][0] == sketch).all(), t
    alike = fingerprints.likeness(together[1:-1], together[2:], place[1:-1], place[2:])
    assert all(x < 1 for x, a, b in zip(alike, texts[:-1], texts[1:], strict=True) if a != b)


def test_fingerprints_of_nothing(empty):
    assert fingerprints.fingerprints(empty).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>if(a<b){x("</p>")}</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="wrap"><article class="post-%d"><h1>Title &amp; more</h1><p>First <b>bold</b>\n\ttext&nbsp;here.<br>line two<p>Second para.</p><div class="ad-slot">Buy</div>
<ul><li>one<li>two</ul><!-- gone > --><form><label>mail</label><input></form><p>Last &lt;tag&gt;.</p></article>
<section id="comments"><p>nice one</p></section></div><aside>side</aside><footer>&copy; me</footer></body></html>"""
TEXT = "Title & more\n\nFirst bold text here. line two\n\nSecond para.\n\none\n\ntwo\n\nLast <tag>."


def test_extract():
    assert html_text.extract(PAGE % 7) == TEXT
    assert html_text.vote(PAGE % 7) == ">html>body>div.wrap>article.post-#"
    assert html_text.extract("just text & <b>bold</b>") == "just text & bold" and html_text.extract("<p>a<p>b") == "a\n\nb"
    assert html_text.extract('<p title="a > b">x</p') == "x</p" and html_text.extract("a < b") == "a < b"
    assert html_text.extract("") == html_text.extract(None) == html_text.extract("<script>x") == ""
    assert html_text.extract("<div " + "'" * 2000 + "x" * 2000) is not None


def test_consensus_helps_odd_pages(spark):
    normal = [(i, "http://h.example/%d" % i, PAGE % i) for i in range(5)]
    odd = (9, "http://u:p@H.example:80/x", '<html><body><div class="wrap"><article class="post-9"><p>Short.</p></article></div><div class="blurb"><p>' + "long words " * 40 + "</p></div></body></html>")
    rest = [(10, None, PAGE % 1), (11, "http://h.example/", None), (12, "x", ""), (None, "http://h.example/", PAGE % 2), (9, odd[1], odd[2])]
    pages = spark.createDataFrame([*normal, odd, *rest], "page_id long, url string, html string").withColumns({"paths": F.lit(1), "_host": F.lit("z"), "host": F.lit(2), "text": F.lit("no")})
    got = html_text.main_texts(pages.repartition(3)).collect()
    assert len(got) == 11 and html_text.extract(odd[2]).startswith("long words")
    for r in got:
        want = "Short." if r.page_id == 9 else "" if r.page_id in (11, 12) else TEXT
        assert (r.text, r.n_chars) == (want, len(want)), r
    assert html_text.main_texts(pages.limit(0)).collect() == []


def test_names_that_only_hold_a_marking_word():
    article = "<p>" + "word " * 200 + "</p>"
    want = ("word " * 200).strip()
    for name in ("long-form", "related-work", "social-history", "notice-of-motion", "search-engine-article", "comment-piece", "form-body", "search-results"):
        for kind in ("class", "id"):
            page = f'<html><body><nav>menu</nav><div {kind}="{name}">{article}</div><div class="sidebar">side text</div><div id="comments">{article * 3}</div></body></html>'
            assert html_text.extract(page) == want
    for name in ("ad", "sidebar", "site-footer", "related-posts", "cookie-notice", "social-share", "newsletter-signup", "user-comments", "comment-list"):
        page = f'<html><body><div class="{name}">{"other " * 300}</div><div class="story">{article}</div></body></html>'
        assert html_text.extract(page) == want, name
    assert html_text.extract(f'<body><div class="search"><h1>Title</h1>{article}</div></body>') == "Title\n\n" + want
    assert html_text.extract('<body><div class="ad">Only this.</div></body>') == "Only this."


def test_broken_and_deep_pages_take_linear_time():
    import time

    pages = ["<div>" * 24_000 + "x", '<div class="a b">' * 24_000 + "x", '<a x="' * 8_000, '<a x="' * 8_000 + ">x", "<" * 100_000, "<!--" * 20_000, "</x>" * 50_000, "<ul><li>" * 10_000 + "<li>" * 10_000, "<script>" * 20_000, "<td>" * 30_000, "<span hidden>" * 20_000 + "<p>" * 5_000, "&" * 100_000]
    began = time.time()
    for p in pages:
        html_text.extract(p)
        html_text.vote(p)
    assert time.time() - began < 20
    assert html_text.extract('<p>a < b and c</p><p>d <a href="x>y">e</a></p>') == "a < b and c\n\nd e"
    assert html_text.extract("<p>one<p>two <b title='it'>three</b>") == "one\n\ntwo three"
    assert html_text.extract('<p>start</p><a title="never closed><p>rest</p>') == "start\n\nrest"


def test_verbatim_is_all_of_an_item(spark):
    item = "A farmer keeps 12 apples in each of his boxes and sells them at the market to people of the town before noon"
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    texts = [item, "So we read: " + item.upper().lower() + " and so on", item.replace("12", "twelve"), item.replace("apples", "pears"), item.replace("12", "15"), item.replace(" before noon", "")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in decontamination.leaks(docs, table).collect()}
    assert {i for i, r in got.items() if r.verbatim} == {0, 1} and {0, 1, 2, 4, 5} <= set(got)


def test_a_repeated_window_is_judged_place_by_place(spark):
    item = "one two three four five six seven eight " * 40
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(5, item * 20, None, None, None), (6, "one two three four five six", None, None, None)], SCHEMA)
    (r,) = decontamination.leaks(docs, table).collect()
    assert (r.doc_id, r.windows, r.verbatim) == (5, 313, True)
