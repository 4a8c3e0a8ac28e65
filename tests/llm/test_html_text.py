import random

import numpy as np
import pytest

from tidemark.llm import html_text


def text(page):
    return "\n".join(t for t, _ in html_text.blocks(page))


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>no</title></head><body><nav>menu</nav><article><h1>Head</h1><p>one <b>two<br>three<p>four</article><footer>no</footer>", "Head\none two three\nfour"),
    ("<article><p>a &amp; b &copy; &am &#x41;&nbsp; c</p><script>if (a<b) '</p>'</script><style>p{}</style></article>", "a & b © &am A c"),
    ("<article><p>kept</p><div class='ad'>buy</div><aside>side</aside><form><p>name</p></form><div id=comments><p>nice</p></div><p>end", "kept\nend"),
    ("<article><header><h1>Title</h1></header><p>x<!-- <p>no</p> -->y</p></article><!-- open", "Title\nxy"),
    ("<ARTICLE><P CLASS=\"lead text\">up</P><P hidden>no</P><p style='display: none'>no</p></ARTICLE>", "up"),
    ("<main><p>in main</p></main><p>out</p>", "in main"),
    ("<body><p>no article</p><div>loose</div>", "no article\nloose"),
    ("<article><p>1 < 2 and 3 > 2</p><p>cut <a href='x", "1 < 2 and 3 > 2\ncut"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ("<article><p>same</p></article><article class='comment'><p>reader</p></article>", "same"),
    ("<header>site</header><article><p>" + "long " * 5 + "</p></article>", "long long long long long"),
    ("", ""), ("plain", "plain"), ("<", "<"), ("<p", ""), ("</p", ""), ("<!--", ""), ("<script>", ""), ("a</>b", "ab"),
])
def test_structure(page, want):
    assert text(page) == want


def brute(pages, depth):
    """Unique runs of each page's open words, by comparing all pages of a host."""
    out = {}
    for k, (host, words) in enumerate(pages):
        other = {tuple(w[i:i + depth]) for j, (h, w) in enumerate(pages) if h == host and w != words for i in range(max(1, len(w) - depth + 1))}
        covered = set()
        for i in range(max(1, len(words) - depth + 1)):
            if tuple(words[i:i + depth]) in other:
                covered.update(range(i, i + depth))
        out[k] = " ".join(w for i, w in enumerate(words) if i not in covered)
    return out


def test_suffix_array_against_all_pages(spark):
    draw = random.Random(6)
    frames = [["home", "news", "about", "us", "login", "now", "please"], ["all", "rights", "kept", "by", "the", "firm"]]
    pages = []
    for k in range(60):
        host = f"h{k % 4}.example"
        own = [f"{draw.choice('abcdefgh')}{draw.randrange(30)}" for _ in range(draw.randint(0, 40))]
        pages.append((host, frames[0] + own + frames[1] if k % 4 < 3 else own))
    pages += [("h0.example", []), pages[1]]
    rows = [(k, f"http://{h.upper()}/p", "<body><div>" + " ".join(w) + "</div>", 1) for k, (h, w) in enumerate(pages)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, host int").repartition(4))
    assert {r["page_id"]: r["text"] for r in got.collect()} == brute(pages, html_text.DEPTH)


def test_prose_of_an_article_stays_where_pages_repeat_it(spark):
    page = "<article><p>the same words on every page of this host</p><div>please accept all of our cookies right now</div><p>own {}</p></article>"
    got = html_text.extract(spark.createDataFrame([(k, "http://a.example/", page.format(k)) for k in range(3)], "page_id bigint, url string, html string"))
    assert {r["page_id"]: r["text"] for r in got.collect()} == {k: f"the same words on every page of this host\nown {k}" for k in range(3)}


def test_odd_rows(spark, rows):
    odd = [(1, None, None), (None, "no host", "<article><p>é😀</article>"), (2, "http://a/", ""), (2, "http://a/", ""), (3, "http://a/", "<p>" + "word " * 50_000)]
    got = rows(html_text.extract(spark.createDataFrame(odd, "page_id bigint, url string, html string")))
    assert [r[:2] + (r[3],) for r in got] == [(1, None, 0), (2, "http://a/", 0), (2, "http://a/", 0), (3, "http://a/", 249_999), (None, "no host", 2)]
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_given_pages(spark):
    from html import unescape
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S).group(1))
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in parts if x)
        assert got[r["page_id"]] == (want, len(want))


@pytest.mark.parametrize("page", [
    '<div class="layout with-sidebar"><article><p>kept</p></article></div>', '<div id="page" class="no-comments"><article><p>kept</p></article></div>',
    '<div class="header-fixed"><article><p>kept</p></article></div>', '<form action="/"><div><article><p>kept</p></article></div></form>',
    '<div class="sidebar widget"><main><p>kept</p></main></div>', '<form><p>kept</p></form>', '<div class="promo"><form><article><p>kept</p></article></form></div>',
    '<article><div class="entry-header"><p>kept</p></div></article>', '<article><div class="social"><p>kept</p></div></article>',
    '<article><div class="related"><p>kept</p></div></article>', '<article><div class="notice"><p>kept</p></div></article>',
    '<article><p>kept</p></article><div class="related"><article><p>other</p></article></div><form><p>name</p></form>',
    '<article><p>kept</p><form><p>name</p></form><div class="ads"><p>buy</p></div></article>', '<p>kept</p><form><p>name</p></form><div class="ad"><p>buy</p></div>',
    '<div class="comments"><article class="comment"><p>reader</p></article></div><p>kept</p>', '<main><p>kept</p><div class="related"><article><p>other</p></article></div></main>',
])
def test_wrappers_do_not_take_the_article_along(page):
    assert text(page) == "kept"


def test_an_articles_doubtful_parts_are_left_to_the_host(spark):
    page = "<div class='with-sidebar'><article><div class='notice'><p>please accept all of our cookies right now</p></div><p>own {}</p></article></div>"
    got = html_text.extract(spark.createDataFrame([(k, "http://a.example/", page.format(k)) for k in range(3)], "page_id bigint, url string, html string"))
    assert {r["page_id"]: r["text"] for r in got.collect()} == {k: f"own {k}" for k in range(3)}


def test_boilerplate_is_shared_by_many_pages_and_long_or_at_an_end(spark):
    draw = random.Random(13)

    def own(n):
        return " ".join("w%d" % draw.randrange(10**6) for _ in range(n))

    notice, phrase, two = own(12), own(7), own(9)
    rows, want = [], {}
    for k in range(20):
        parts = [own(9) for _ in range(4)]
        rows.append((k, "http://a.example/", f"<article><p>{parts[0]}</p><p>{notice}</p><p>{parts[1]}</p></article>"))
        want[k] = "\n".join(parts[:2])  # a notice in the article of every page
        middle = f"{parts[2]} {phrase} {parts[3]}"
        rows.append((100 + k, "http://b.example/", f"<body><div>{middle}</div>" + f"<div>{two}</div>" * (k < 2)))
        want[100 + k] = middle + f"\n{two}" * (k < 2)  # seven words in mid-sentence, and a block of two pages in twenty
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4))
    assert {r["page_id"]: r["text"] for r in got.collect()} == want


def test_comments_adverts_and_notices_inside_articles_go(spark, rows):
    foreign = ('<div class="reader-comments"><p>comment {0}</p><article>reply {0}</article></div>', '<div id="comment-12">me too {0}</div>', '<div class="ad-slot">buy {0}</div>',
               '<div class="notice">note {0}</div>', '<section id="newsletter_box"><p>read {0}</p></section>')
    kept = '<div class="content no-comments with-sidebar"><p>More of {0}.</p></div><pre><span class="comment-line"># code {0}</span></pre>'
    pages = [(k, "http://a.example/", "<article><h1>Title {0}</h1>".format(k) + "".join(foreign).format(k) + kept.format(k) + "</article>") for k in range(10)]
    got = rows(html_text.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")), "page_id", "text")
    assert got == [(k, f"Title {k}\nMore of {k}.\n# code {k}") for k in range(10)]


def brute_prose(pages):
    """Paragraphs without stretches of 16 words, or whole shorter paragraphs, that enough other pages have, by comparing all pages of a host."""
    hosts, out = {}, {}
    for host, paragraphs in pages:
        hosts.setdefault(host, set()).add(paragraphs)

    def grams(p):
        return {tuple(p[i:i + 16]) for i in range(len(p) - 15)} or {("whole", *p)}

    for k, (host, paragraphs) in enumerate(pages):
        least = max(5, -(-len(hosts[host]) // 2))
        kept = []
        for p in paragraphs:
            gone = set()
            for g in grams(p):
                if sum(any(g in grams(q) for q in other) for other in hosts[host]) >= least:
                    gone |= set(range(len(p))) if g[0] == "whole" else {j for i in range(len(p) - 15) if tuple(p[i:i + 16]) == g for j in range(i, i + 16)}
            kept.append(" ".join(w for i, w in enumerate(p) if i not in gone))
        out[k] = "\n".join(x for x in kept if x)
    return out


def test_stretches_inside_prose_against_all_pages(spark):
    draw = random.Random(21)

    def own(n):
        return tuple("w%d" % draw.randrange(10**6) for _ in range(n))

    notices = [own(n) for n in (22, 16, 15, 40, 7)]
    pages = []
    for k in range(66):
        host = f"h{k % 3}.example"
        paragraphs = []
        for notice in notices:
            body = own(draw.randint(0, 12)) + (notice if draw.random() < 0.6 else notice[:-3]) + own(draw.randint(0, 12))
            paragraphs.append(body if draw.random() < 0.8 else notice)
        pages.append((host, tuple(paragraphs)))
    pages += [pages[0]] * 30  # copies make no boilerplate
    rows = [(k, f"http://{h}/p", "<article>" + "".join(f"<p>{' '.join(p)}</p>" for p in ps) + "</article>") for k, (h, ps) in enumerate(pages)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4))
    want = brute_prose(pages)
    assert {r["page_id"]: r["text"] for r in got.collect()} == want
    assert any(len(t.split()) < sum(map(len, pages[k][1])) for k, t in want.items())


def test_intervals_over_borders_of_ranges(spark):
    page = "<body><div>please accept all of our cookies right now {}</div></body>"
    frame = spark.createDataFrame([(k, "http://a.example/", page.format(f"own{k}")) for k in range(200)], "page_id bigint, url string, html string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # every range is a task
    try:
        got = {r["page_id"]: r["text"] for r in html_text.extract(frame).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == {k: f"own{k}" for k in range(200)}


def test_equal_stretches_and_blocks_have_an_anchor_in_common():
    draw = random.Random(8)
    shared = [draw.choice(["é😀", "a", "word", "zz"]) + str(draw.randrange(99)) for _ in range(html_text.LONG)]
    texts = ["one", "two three", "one", " ".join(shared)] + [" ".join([str(draw.randrange(999)) for _ in range(n)] + shared + ["x"] * n) for n in (0, 1, 9, 40)]
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, raw)])
    for is_open in (False, True):
        block, keys = html_text._anchors(np.frombuffer(b"".join(raw), np.uint8), bounds, np.full(len(raw), is_open), np.full(len(raw), 7, np.uint64), html_text.DEPTH)
        of = [set(keys[block == n]) for n in range(len(raw))]
        assert of[0] == of[2] and of[0] and not of[0] & of[1] and all(k % 2 != is_open for k in keys)
        assert all(of[a] & of[b] for a in range(3, 8) for b in range(3, 8))
        if is_open:
            assert [len(o) for o in of] == [len({tuple(w[i:i + 6]) for i in range(max(1, len(w) - 5))}) for w in map(str.split, texts)]
