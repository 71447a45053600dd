import hashlib
import math
import random
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from knownwhen.llm import html_text, topk, warc
from tests.llm.conftest import prose, rows_of

PAGE_SCHEMA = "page_id long, url string, html string, data string, record int"


# ------------------------------------------------------------------ archives

def payloads():
    long = prose(1, 400)
    head = "WARC/1.1\r\n"
    return [(1, "http://a b/", long), (2, None, long), (9, "http://x", long), (3, "u", "short"),
            (4, "u", "short"), (5, "u", None), (6, "u", ""), (7, "u\r\nX: y", "é" * 2000),
            (8, "u", head + long + "\r\n\r\n" + head + "WARC/1.1\r\nWARC/1.1\r\n\r\n"),
            (10, "u", head * 200), (11, "u", "\r\n\r\n" * 300), (12, "u", "x" * 5000),
            (12, "u", "x" * 5000), (None, "u", long), (None, None, None)]


def expected(rows):
    digest = [(i, (t or "").encode(), hashlib.sha1((t or "").encode()).hexdigest())
              for i, _, t in rows]
    top = {}
    for i, b, d in digest:
        if i is not None and len(b) >= 1000:
            top[d] = max(top.get(d, i), i)
    out = []
    for i, b, d in digest:
        own = i is None or len(b) < 1000 or i == top[d]
        out.append((i, len(b), d, "response" if own else "revisit", None if own else top[d]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1 << 18, 100, 7])
def test_archives_round_trip(spark, size):
    rows = payloads()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGE_SCHEMA)
    assert rows_of(warc.archived(df, size=size)) == expected(rows)


def test_no_pages(spark):
    assert rows_of(warc.archived(spark.createDataFrame([], PAGE_SCHEMA))) == []


def test_files_hold_plain_warc_records(spark):
    df = spark.createDataFrame([(1, "http://a", "hello", "x", 1)], PAGE_SCHEMA)
    path = warc.write(df)
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    assert text.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(
        "hello\r\n\r\n")


def test_parts_hold_no_head_line():
    for data in (warc.HEAD, b"x" + warc.HEAD * 3 + b"y", b"", b"abc"):
        parts = list(warc.cut(data, 4))
        assert b"".join(parts) == data and all(
            warc.HEAD not in p and len(p) <= 4 and p[:4] != warc.HEAD[:4] or len(p) < 10
            for p in parts)


def test_chunk_rows_carry_bytes_and_digests_so_far(spark):
    page = "\u00fc" * 700 + warc.HEAD.decode() + "x" * 900
    rows = spark.createDataFrame([(1, None, page), (1, "u", page), (2, "u", "")],
                                 "page_id long, url string, p string")
    got = warc.chunks(rows.selectExpr("page_id", "url", "CAST(p AS BINARY) p"), 512).collect()
    by_copy = {}
    for r in sorted(got, key=lambda r: r.chunk):
        by_copy.setdefault(r.copy, []).append(r)
    assert sorted(len(v) for v in by_copy.values()) == [1, 5, 5]  # 1,403 bytes up to the cut head line, 907 after it
    for record in by_copy.values():
        data = b""
        for n, r in enumerate(record):
            data += r.data
            assert r.chunk == n and len(r.data) <= 512 and r.bytes_so_far == len(data)
            assert r.sha1_so_far == hashlib.sha1(data).hexdigest()
            assert r.last == (n == len(record) - 1)
        assert record[0].digest == record[-1].sha1_so_far and record[0].total == len(data)
        assert data.decode() == (page if record[0].page_id == 1 else "")


def test_chunks_of_a_large_payload_take_little_memory():
    whole = memoryview(bytes(64 << 20))
    tracemalloc.start()
    total = sum(len(bytes(r["data"])) for r in warc.chunk_rows(whole))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert total == 64 << 20 and peak < 4 * warc.CHUNK


# ------------------------------------------------------------------ main text

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body><header><h1>Site name</h1></header><nav><ul><li><a href=/x>Menu one</a><li>Menu two</ul></nav>
<div class="ad">Buy this, now, today, and again!</div><div id=cookie-notice>We use cookies.</div>
<article><h1>Head &amp; shoulders</h1><p>First <b>bold</b> text,&nbsp;with   marks. More of it,
and more.<p>Second paragraph; not closed. It goes on, for a while, like that.<ul><li>Point one
<li>Point <i>two</i></ul><aside>Related: other things.</aside><form><input>Name<button>Go</button>
</form><div class="comments"><p>I agree, said a reader. Very much so, indeed, yes.</p></div></article>
<div class=sidebar>Popular posts</div><footer>&copy; Someone</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == (
        "Head & shoulders\n\nFirst bold text, with marks. More of it, and more.\n\n"
        "Second paragraph; not closed. It goes on, for a while, like that.\n\nPoint one\n\nPoint two")


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p>", ""), ("no tags", "no tags"), ("<p>a</div></p>b", "a\n\nb"),
    ("<nav>only a menu</nav>", ""), ("<div><p>x<p>y</div>", "x\n\ny"), ("a < b & c", "a < b & c"),
    ("<!-- <p>c</p> --><p>d", "d"), ("<p title='a>b'>quoted</p>", "quoted"),
    ("<p title='open>text</p>", "text"), ("<main><p>&#65;&lt;&eacute;</p></main>", "A<é")])
def test_small_and_broken_pages(page, text):
    assert html_text.main_text(page) == text


STORY = ("<h1>A headline</h1><p>First text, with marks. More of it, and more.</p>"
         "<p>Second one; it goes on, for a while.</p>")
TOLD = ("A headline\n\nFirst text, with marks. More of it, and more.\n\n"
        "Second one; it goes on, for a while.")
MENU = "<nav><a href=/>Home</a></nav>"


@pytest.mark.parametrize("wrapper", [
    "<div class='content-sidebar-wrap'>", "<div id=page class='no-sidebar'>", "<form action=/>",
    "<div class='site has-header widget'>", "<div class=sidebar>", "<div id=form><div class=share>",
    "<section class='banner'>", "<form><div class=no-comments>"])
@pytest.mark.parametrize("inner", ["", "<article>", "<main>", "<main><article>"])
def test_marked_wrappers_keep_the_text(wrapper, inner):
    page = f"<body>{MENU}{wrapper}{inner}{STORY}</body>"
    assert html_text.main_text(page) == TOLD
    page = f"<body>{MENU}<div class='ad'>Buy, buy!</div>{wrapper}<nav>x</nav>{inner}{STORY}"
    assert html_text.main_text(page) == TOLD


def test_articles_in_marked_nodes_keep_the_text():
    page = "".join(f"<div class=widget><article><p>Text {i}, of it.</p></article></div>"
                   for i in range(3))
    assert html_text.main_text(page) == "Text 0, of it.\n\nText 1, of it.\n\nText 2, of it."
    page = page.replace("article", "section")
    assert html_text.main_text(page) == "Text 0, of it.\n\nText 1, of it.\n\nText 2, of it."


@pytest.mark.parametrize("mark", [
    "div class=sidebar", "div class='sidebar-left'", "div id=cookie-notice", "div class='site-footer'",
    "div class='post-comments'", "div class='x share-buttons'", "form", "aside", "footer"])
def test_marked_nodes_beside_the_text_are_no_text(mark):
    more = f"<{mark}><p>Other things, quite some.</p></{mark.split()[0]}>"
    assert html_text.main_text(f"<body>{MENU}<div>{STORY}{more}</div></body>") == TOLD
    assert html_text.main_text(f"<body><div class=no-sidebar>{more}<main>{STORY}</main>") == TOLD
    comments = "<div id=comments>" + "<article><p>I, too, say so; yes, I do!</p></article>" * 40
    assert html_text.main_text(f"<body><article>{STORY}</article>{comments}</div></body>") == TOLD


LONG = "".join(f"<p>Paragraph {i}{', and more of it' * i}.</p>" for i in range(9))
LINKS = "<div><ul><li><a href=/a>One thing</a><li><a href=/b>Another thing</a></ul></div>"


@pytest.mark.parametrize("page", [
    "<div><h1>Title</h1><p>lead</p><div>{}</div><p>The end</p></div>",
    "<body><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul><div><h1>Title</h1><h2>lead</h2></div>"
    "<div><div>{}</div><p>The end</p></div><p><a href=/>Home</a> <a href=/c>C</a></p></body>",
    "<main><h1>Title</h1><p>lead</p><article>{}</article>" + LINKS + "<p>The end</p></main>",
    "<body>" + LINKS + "<p>not this</p><div><h1>Title</h1><p>lead</p><article>{}<p>The end</p>"
    "</article></div><p>nor this</p></body>",
    "<main><article><h1>Title</h1>lead<section>{}</section></article>The end</main><div>x</div>"])
def test_headline_lead_and_end_beside_the_paragraphs(page):
    out = html_text.main_text(page.format(LONG)).split("\n\n")
    assert out[:3] == ["Title", "lead", "Paragraph 0."] and out[-1] == "The end"
    assert len(out) == 12


def test_links_in_the_core_and_single_ones_are_text():
    page = f"<div><p><a href=/s>Source</a></p><div>{LONG}{LINKS}</div><p>a <a name=x>b<p>c</div>"
    out = html_text.main_text(page).split("\n\n")
    assert out[0] == "Source" and out[10:] == ["One thing", "Another thing", "a b", "c"]


def test_a_very_long_page_takes_time_in_proportion():
    body = "".join(f"<p>Sentence number {i}, with a comma.</p>" for i in range(20000))
    out = html_text.main_text(f"<body><article>{body}</article></body>")
    assert out.count("\n\n") == 19999
    deep = "<div>" * 3000 + "deep text, here" + "</div>" * 3000
    assert html_text.main_text(deep) == "deep text, here"


def test_pages_as_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1),
                                (None, None, None, None, None)], PAGE_SCHEMA)
    rows = html_text.extracted(df).collect()
    assert len(rows) == 3 and {r["n_chars"] for r in rows} == {0, len(html_text.main_text(PAGE))}
    assert rows_of(html_text.extracted(df.limit(0))) == []


# ------------------------------------------------------------------ top k

def brute(rows, k=10):
    sound = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in sound:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound
                        if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def test_top_k_of_awkward_vectors(spark):
    draw = random.Random(4)

    def vec(n):
        return [float(np.float32(draw.gauss(0, 1))) for _ in range(n)]

    rows = [(i, vec(6)) for i in range(450)]
    rows += [(i, [0.5] * 6) for i in range(1000, 1100)]  # ties
    rows += [(1200, [0.5] * 6), (7, [1.0] * 6), (100, vec(6)), (1300, vec(3)), (1301, vec(3)),
             (1400, vec(9)), (1500, None), (1501, []), (1600, [float("nan")] * 6),
             (1601, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1602, [float("inf")] * 6), (None, vec(6)),
             (1700, [-1.0] * 6), (1800, [0.0] * 6), (1900, [3e15] * 6)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "vec_id long, embedding array<float>, v int, score int")
    rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    small = [r for r in rows if r[0] != 1900]
    got = topk.top_k(df.filter("vec_id <> 1900"), F.col("vec_id") % 100 == 0)
    assert rows_of(got) == brute([r for r in small if r[0] is not None])
    blocks, topk.QUERY_BLOCK = topk.QUERY_BLOCK, 2
    assert rows_of(topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0)) == []
    topk.QUERY_BLOCK = blocks


def test_top_k_in_blocks_equals_a_scan(spark):
    draw = random.Random(6)
    rows = [(i, [float(draw.randrange(-3, 4)) for _ in range(5)]) for i in range(0, 1000, 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert rows_of(topk.top_k(df, F.col("vec_id") % 100 == 0, block_size=4)) == brute(rows)


def test_query_blocks(spark):
    rows = spark.createDataFrame([(i, [float(i)]) for i in range(7)], "vec_id long, v array<double>")
    rows = rows.select("vec_id", F.transform("v", lambda x: x.cast("long")).alias("v"))
    assert [len(ids) for ids, _ in topk.query_blocks(rows, 3)] == [3, 3, 1]


READERS = ("<p>I agree, said a reader. Very much so, indeed, yes.</p>",
           "<p>Nonsense, all of it! Where did you get that from?</p>")


@pytest.mark.parametrize("comments", [
    f"<div class=comment-body>{READERS[0]}</div><div class=comment-body>{READERS[1]}</div>",
    f"<div id='user-comments-list'>{READERS[0]}{READERS[1]}</div>",
    f"<section class=articleComments><div>{READERS[0]}</div></section>",
    f"<div id=disqus_thread>{READERS[0]}</div>",
    f"<h3>2 comments</h3><ul><li>{READERS[0]}<li>{READERS[1]}</ul>",
    f"<section><h2>Comments (2)</h2><div>{READERS[0]}</div><div>{READERS[1]}</div></section>",
    "<ol>" + "".join(f"<li><p>Reader {i}</p>{r}<p>Reply</p>" for i, r in enumerate(READERS)) + "</ol>",
    "".join(f"<div><b>Reader {i}</b>{r}<a href=#r>Reply</a></div>" for i, r in enumerate(READERS)),
    "<div><ul><li>" + "<li>".join(f"{r}<p>Reply<ul><li>{r}<p>Reply</ul>" for r in READERS) + "</ul></div>"])
@pytest.mark.parametrize("page", [
    "<body>{menu}<article>{story}</article>{comments}</body>",
    "<body>{menu}<article>{story}{comments}</article></body>",
    "<body>{menu}<main>{story}</main>{comments}</body>",
    "<body>{menu}<div class=page><div>{story}</div>{comments}</div></body>"])
def test_reader_comments_go_with_or_without_a_name(page, comments):
    assert html_text.main_text(page.format(menu=MENU, story=STORY, comments=comments)) == TOLD


@pytest.mark.parametrize("aside", [
    "<div class=cookie-consent-banner-v2><p>We use cookies. Fine?</p></div>",
    "<div class='menu-x'><p>Home, away, and more.</p></div>", "<div class=navBar>Home</div>",
    "<ul id=nav-2><li>Home</ul>", "<div class='ad-slot-7'>Buy, buy, buy!</div>"])
def test_asides_by_other_forms_of_their_names(aside):
    assert html_text.main_text(f"<body>{aside}<article>{STORY}</article>{aside}</body>") == TOLD
    assert html_text.main_text(f"<body>{aside}<div>{STORY}</div></body>") == TOLD


@pytest.mark.parametrize("page", [
    "<article class=comments-open>{}</article>", "<div class=has-comments><article>{}</article></div>",
    "<article>{}</article><a class=comment-count></a>", "<div class=menu-open-left>{}</div>",
    "<title>abc</head><body>{}", "<svg><path d=x>{}", "<noscript><p></p>{}", "<select><option></option>{}",
    "<iframe src=x>{}", "<textarea></textarea>{}<textarea>", "<script>if (a < b) '<p>no</p>'</script >{}",
    "<SCRIPT>x</SCRIPT>{}<style>p", "<!-->x-->{}", "<!doctype html>{}<!-- open", "<?xml?>{}</>",
    "<head><script>var a = 1;</head><body>{}", "<p title=\"x>y\"></p>{}", "{}<p class='open"])
def test_pages_that_keep_all_their_text(page):
    assert html_text.main_text(f"<body>{page.format(STORY)}") == TOLD


def test_an_article_about_comments_stays():
    body = "<h1>Comments</h1><div>One, of them.</div><div>Two, of them.</div>"
    assert html_text.main_text(f"<body>{body}</body>") == "Comments\n\nOne, of them.\n\nTwo, of them."
    body = "<h2>Replies</h2><p>They came, late.</p><p>None was, in fact, polite.</p>"
    assert "None was" in html_text.main_text(f"<body><article>{STORY}{body}</article></body>")


@pytest.mark.parametrize("piece", [
    "<script ", "<!-- ", "<a \"", "<a '\" ", "<!x ", "</script ", "<title>", "<svg>", "<div>Reply",
    "<li><p>Reply", "<p '>", "<", "</", "<ul><li>x", "<div class=comment>", "<p \"'>x"])
def test_time_grows_with_the_page(piece):
    page = piece * (300_000 // len(piece))
    begin = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - begin < 15


@pytest.mark.parametrize("seed", range(40))
def test_pages_built_from_known_articles(seed):
    rng = random.Random(seed)
    part = [f"{prose(seed * 99 + i, rng.randint(8, 60))}." for i in range(rng.randint(3, 9))]
    lead, rest = part[0], part[1:]
    wrap = rng.choice(["<article>{}</article>", "<main>{}</main>", "<div class=post-body>{}</div>",
                       "<main><article>{}</article></main>", "<div><div>{}</div></div>"])
    leaf = rng.choice(["<p>{}</p>", "<div>{}</div>", "<p>{}"])
    body = f"<h1>{lead}</h1>" + "".join(leaf.format(x) for x in rest)
    noise = ["<nav><a href=/>Home</a> <a href=/x>Away</a></nav>", "<div class=sidebar>Popular posts, here.</div>",
             "<div class='ad'>Buy this, now!</div>", "<form><input>Name<button>Go</button></form>",
             "<aside>Related: other things.</aside>", "<style>p{{}}</style>",
             "<div class=comment-list><div>I agree, so much.</div></div>"]
    before = "<header>A site</header>" + "".join(rng.sample(noise, 3))
    after = "".join(rng.sample(noise, 4)) + "<footer>The end.</footer>"
    page = f"<html><head><title>{lead}</title></head><body>{before}{wrap.format(body)}{after}</body></html>"
    assert html_text.main_text(page) == "\n\n".join(part)
