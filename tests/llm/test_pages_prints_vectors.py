from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ionloom.llm import extraction, fingerprints, hashing, neighbours

from .helpers import empty, frame, odd_rows, shingles

PAGES = "page_id long, url string, html string"


def test_article_without_its_surroundings(spark):
    html = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><header>Site</header><nav><ul><li>Menu</li></ul></nav>"
        "<article><h1>A &amp; B</h1><p>One  two\n three<br>four<p>Five &lt;six&gt; &eacute;<div class='ad'>Buy</div><aside>Side</aside><ul><li>x<li>y</ul><table><tr><td>1<td>2</table>"
        "<form>Search <input></form><section id=comments><p>Nice!</p></section></article><footer>&copy;</footer></body></html>"
    )
    r = extraction.main_text(spark.createDataFrame([(1, "http://a.example/x", html)], PAGES)).first()
    assert r.text == "A & B\n\nOne two three four\n\nFive <six> é\n\nx\n\ny\n\n1 2"
    assert r.n_chars == len(r.text)


def test_site_template_goes_and_articles_stay(spark):
    page = lambda k: f"<body><div class=top>Welcome to the site of all things</div><div><p>Story {k} about number {k * 7}</p><p>It goes on with {k * 13} words</p></div><div class=box><p>Read also our great offers</p></div></body>"
    rows = [(k, f"https://one.example/{k}", page(k)) for k in range(30)] + [(99, "https://two.example/1", page(99))]
    got = {r.page_id: r.text for r in extraction.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "Story 3 about number 21\n\nIt goes on with 39 words"
    assert "Welcome" in got[99]  # one page is no site


def test_paragraphs_that_recur_inside_articles_stay(spark):
    rows = [(k, "https://one.example/", f"<nav>m</nav><article><h1>T{k}</h1><p>The same words stand here.</p><p>{k}</p></article>") for k in range(20)]
    got = extraction.main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert all(r.text == f"T{r.page_id}\n\nThe same words stand here.\n\n{r.page_id}" for r in got)


def test_broken_pages_take_time_in_proportion():
    import time

    n = 1 << 18
    hostile = ["<a ", "<", "</", "<!--", "<a b='", "<a b=\"><c d='", "<p>", "</x>", "<div>", "<li>", "<td>", "<a b=c'd \"", "<script", "<b></i>", "<span><article>", "&amp", "<a  =  ", "<table></span>", "<!", "<?x", "<textarea>", "</script>", "<p/", "<a b= \t "]
    for piece in hostile:
        for page in (piece * (n // len(piece)), "<span><article>" + piece * (n // len(piece)) + "</span>" * 1000, "<div>" * 5000 + piece * 5000 + "</q>" * 5000):
            began = time.perf_counter()
            extraction.extract(page, set())
            assert time.perf_counter() - began < 4, piece


def test_nothing_else_goes():
    inside = "<p>Let <math><mi>x</mi></math> be</p><section class='social-history'><p>Society</p></section><div id='related-work'><p>Others</p></div><canvas>drawn</canvas><object>an object</object><map><p>m</p></map>"
    gone = "<div class='social-links'>f t</div><div class='related-posts box'>r</div><ul class='comment-list'><li>c</ul><div id='cookieNotice'>k</div><p hidden>h</p>"
    assert extraction.extract(f"<article>{inside}{gone}</article>", set()) == "Let x be\n\nSociety\n\nOthers\n\ndrawnan object\n\nm"
    assert extraction.extract("<p>a < b and c <3 d</p><p title='x > y'>e</p><p don't>it's</p>", set()) == "a < b and c <3 d\n\ne\n\nit's"


def test_template_counts_are_those_of_plain_counting(spark):
    """Boxes that stand on enough different pages of a host go, unless they are most of a page."""
    import random
    from collections import defaultdict

    rng = random.Random(4)
    rows, boxes = [], {}
    for k in range(240):
        host = rng.choice(["a", "a", "a", "b", "c"])
        chosen = [f"box {host} {rng.choice([0, 1, 2, 3]) if rng.random() < 0.4 else rng.randrange(4, 60)} with words" for _ in range(rng.randrange(4))]
        boxes[k] = (host, tuple(dict.fromkeys(chosen)), f"story {k % 200} of the page and some more of its own words that are long enough to be most of it")
        rows.append((k, f"http://{host}.example/{k}", "<body>" + "".join(f"<section>{b}</section>" for b in boxes[k][1]) + f"<section>{boxes[k][2]}</section></body>"))
    pages, on = defaultdict(set), defaultdict(set)
    for host, chosen, story in boxes.values():
        pages[host].add((chosen, story))
        for b in (*chosen, story):
            on[host, b].add((chosen, story))
    size = lambda x: sum(map(len, x.split()))
    gone = lambda host, b: len(on[host, b]) >= max(extraction.LEAST_PAGES, extraction.LEAST_SHARE * len(pages[host]))
    for r in extraction.main_text(spark.createDataFrame(rows, PAGES)).collect():
        host, chosen, story = boxes[r.page_id]
        total = sum(map(size, (*chosen, story)))
        assert r.text == "\n\n".join(b for b in (*chosen, story) if not (gone(host, b) and size(b) <= extraction.MOST_OF_PAGE * total))
    assert any(gone(h, b) for h, b in on) and not all(gone(h, b) for h, b in on)


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (None, "no url", "<p>x"), (3, "http://h/", "plain & text"), (3, "http://h/", "plain & text"), (4, "http://h/", "<p" * 50), (5, "http://h/", "<div>" * 3000 + "deep" + "</div>" * 10), (6, "http://h/", "<!-- never ends <p>x</p>"), (7, "http://h/", "<script>x"), (8, "http://h/", "</p></div><b>bold<i>both</b>rest")]
    d = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in ("host", "templates", "text", "key", "salt")})
    got = extraction.main_text(d).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == "" and by[None] == "x" and by[3] == "plain & text" and by[5] == "deep" and by[6] == by[7] == ""
    assert by[8] == "boldbothrest"
    assert extraction.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_words_in_values_and_longer_names_are_no_attributes():
    for attrs in (' style="overflow:hidden"', ' title="The hidden valley"', " data-id='menu-3'", " data-class=ad", ' alt="id=menu"', " x-aria-hidden=true"):
        assert extraction.extract(f"<body><article{attrs}><h1>T</h1><div{attrs}><p>Text</div></article></body>", set()) == "T\n\nText"
    for attrs in (" hidden", ' title="x"hidden', " HIDDEN=''", " id = menu", " data-a=1 class='b ad'", ' aria-hidden="true"'):
        assert extraction.extract(f"<article><p>a</p><div{attrs}><p>Text</div></article>", set()) == "a"


def test_copies_of_a_page_are_no_template(spark):
    plain = "<body><div><p>First part of it</p><p>Second part</p><p>Third one</p></div></body>"
    marked = "<article><h1>T</h1><section><p>One</p></section><div><p>Two</p></div><p>Three and more words</p></article>"
    rows = [(k, "http://a.example/", plain) for k in range(30)] + [(k + 30, "http://b.example/", marked) for k in range(30)]
    got = {r.text for r in extraction.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {"First part of it\n\nSecond part\n\nThird one", "T\n\nOne\n\nTwo\n\nThree and more words"}


def test_paragraphs_on_a_few_pages_stay(spark):
    rows = [(k, "http://a.example/", f"<body><p>Page {k} of many pages</p><p>It goes on {k * 7}</p>{'<p>As we said before.</p>' if k < 4 else ''}</body>") for k in range(40)]
    got = {r.page_id: r.text for r in extraction.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "Page 3 of many pages\n\nIt goes on 21\n\nAs we said before."


def test_salted_join_gives_the_same(spark, small, monkeypatch):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    a = sorted(map(str, extraction.main_text(pages).collect()))
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", -1)
    assert a == sorted(map(str, extraction.main_text(pages).collect()))


# Fingerprints -----------------------------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x1cé", max_size=30), min_size=1, max_size=6))
def test_word_hashes_tell_words_apart(items):
    raw = [x.encode() for x in items]
    hashes, first = hashing.word_hashes(raw)
    words = [w for x in raw for w in x.split()]
    assert len(hashes) == len(words) and np.diff(first).tolist() == [len(x.split()) for x in raw]
    assert len(set(words)) == len(set(hashes.tolist())) == len({(w, h) for w, h in zip(words, hashes.tolist(), strict=True)})


def test_shingles_are_the_distinct_ones():
    texts = [r[1] or "" for r in odd_rows()]
    _, starts = hashing.shingle_hashes([t.encode() for t in texts])
    assert np.diff(starts).tolist() == [len(shingles(t)) for t in texts]


@pytest.mark.parametrize("extra", [False, True])
def test_edited_texts_and_next_documents(spark, extra):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 107]
    texts = {r[0]: r[1] or "" for r in rows}
    ids = sorted(texts)
    got = {r.doc_id: r for r in fingerprints.compare_edited(frame(spark, rows, extra=extra)).collect()}
    assert set(got) == set(ids)
    for k, i in enumerate(ids):
        t, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        n = len(t) // 4
        edited = t[: len(t) - n] + after[:n]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].near_edited == fingerprints.likeness(got[i].fingerprint, got[i].edited_fingerprint)
        assert got[i].near_next == fingerprints.likeness(got[i].fingerprint, got[ids[(k + 1) % len(ids)]].fingerprint)
    assert got[5].fingerprint == got[7].fingerprint


def test_ranges_meet_at_their_ends(spark, monkeypatch):
    rows = [(i * 3, f"text number {i} of the table", "en", "s", None) for i in range(200)]
    whole = sorted(map(str, fingerprints.compare_edited(frame(spark, rows)).collect()))
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 7)
    assert whole == sorted(map(str, fingerprints.compare_edited(frame(spark, rows, 5)).collect()))


def test_repeated_and_missing_ids(spark):
    rows = odd_rows()
    assert fingerprints.compare_edited(frame(spark, rows)).count() == len(rows)
    assert fingerprints.compare_edited(empty(spark)).count() == 0
    lone = fingerprints.compare_edited(frame(spark, [(1, "a b c d e f g h", "en", "s", None)])).first()
    assert lone.edited_sha256 == hashlib.sha256(b"a b c d e f" + b"a b"[:2]).hexdigest() or lone.n_chars == 15


def test_estimates_are_near_the_truth(spark):
    long = " ".join(f"w{k}" for k in range(4000))
    part = " ".join(f"w{k}" for k in range(400))
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(frame(spark, [(1, long, "en", "s", None), (2, part, "en", "s", None)])).collect()}
    assert fingerprints.containment(got[2], got[1]) == 1.0
    assert fingerprints.containment(got[1], got[2]) == pytest.approx(0.1, abs=0.04)
    assert fingerprints.likeness(fingerprints.merged(got[1], got[2]), got[1]) == 1.0


# Neighbours -------------------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>"


def _exact(rows, k=5, every=50):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in ok:
        if q % every == 0:
            near = sorted((-float(x @ y) / float(np.sqrt(x @ x) * np.sqrt(y @ y)), i) for i, y in ok if i != q)
            out[q] = near[:k]
    return out


def _rows(n=1500, d=16):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, d))
    return [(i, (centres[i % 8] + 0.4 * rng.normal(size=d)).tolist()) for i in range(n)]


def test_recall_and_scores(spark):
    rows = _rows()
    got = neighbours.nearest(spark.createDataFrame(rows, VECTORS)).collect()
    want = _exact(rows)
    found: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(want) and all(len(v) == 5 for v in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    vectors = {i: np.array(v) for i, v in rows}
    for q, own in found.items():
        assert [s for _, s in own] == sorted((s for _, s in own), reverse=True)
        for i, s in own:
            x, y = vectors[q], vectors[i]
            assert s == pytest.approx(x @ y / (np.linalg.norm(x) * np.linalg.norm(y)), abs=1e-12)


def test_odd_vectors_and_ties(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0]), (None, [1.0, 1.0]), *[(i, [3.0, 0.0]) for i in range(7, 20)]]
    d = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("list", "label", "score", "rank", "block")})
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(d).collect())
    assert got == [(0, k + 1, 7 + k) for k in range(5)] + [(50, 1, 0)] + [(50, k + 2, 7 + k) for k in range(4)]
    few = neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], VECTORS)).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 1)]
    assert neighbours.nearest(spark.createDataFrame([], VECTORS)).count() == 0


def test_blocks_of_large_lists_give_the_same(spark, monkeypatch):
    rows = _rows(400) + [(i, [1.0] * 16) for i in range(1000, 1300)]
    d = spark.createDataFrame(rows, VECTORS)
    whole = sorted(map(str, neighbours.nearest(d).collect()))
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 3)
    assert whole == sorted(map(str, neighbours.nearest(d).collect()))


def test_rows_that_share_a_query_id_ask_as_one(spark):
    rows = [(0, [1.0, 0.1]), (0, [1.0, 0.1]), (0, [0.0, 1.0]), *[(i, [1.0, i / 10]) for i in range(1, 9)], (3, [1.0, 0.3]), (3, [1.0, 0.3])]
    got = [(r["rank"], r.vec_id) for r in sorted(neighbours.nearest(spark.createDataFrame(rows, VECTORS)).collect(), key=lambda r: r["rank"])]
    assert got == [(1, 8), (2, 7), (3, 6), (4, 5), (5, 4)]  # the smallest vector, [0, 1], asks
    rows = rows[:2] + rows[3:]
    got = [(r["rank"], r.vec_id) for r in sorted(neighbours.nearest(spark.createDataFrame(rows, VECTORS)).collect(), key=lambda r: r["rank"])]
    assert got == [(1, 1), (2, 2), (3, 3), (4, 3), (5, 3)]  # rows that repeat an id are candidates of their own


def test_fewer_lists_are_probed_where_vectors_have_structure():
    rng = np.random.default_rng(5)
    spread = rng.normal(size=(4000, 32))
    near = rng.normal(size=(100, 32))[rng.integers(0, 100, 4000)] + 0.2 * spread
    probes = [neighbours.probes_for(neighbours.fit(x, 100), x, 5, 0.95) for x in (spread, near)]
    assert probes[1] < 10 < probes[0]


def test_each_query_gets_its_five(spark):
    rng = np.random.default_rng(11)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(3000, 24)))]
    got = neighbours.nearest(spark.createDataFrame(rows, VECTORS), wanted_recall=0.2)  # few lists are probed
    assert {r["count"] for r in got.groupBy("query_id").count().collect()} == {5} and got.select("query_id", "vec_id").distinct().count() == got.count() == 300


def test_queries_among_many_equal_vectors_all_ask(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 1000, 10)] + [(i, [2.0, 1.0]) for i in range(3, 60, 10)]
    got = neighbours.nearest(spark.createDataFrame(rows, VECTORS)).collect()
    asked = range(0, 1000, 50)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(q, k + 1, v) for q in asked for k, v in enumerate([v for v in range(0, 100, 10) if v != q][:5])]
