from hypothesis import given
from hypothesis import strategies as st

from seqloom.llm import line_blocks
from seqloom.llm.line_blocks import extracted, kept_stretches, lines_of, main_text, stretches

LONG = "This is a paragraph of some length that a reader would come here to read, and it goes on for a while."
PAGE = f"""<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{{margin:0}}</style><script>var t="</p><article>no</article>";</script></head><body class="header-page">
<header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav><!-- <p>not this</p> --><div class="ad">Buy now! {LONG}</div>
<div id="cookie-notice">We use cookies. {LONG}</div>
<article><header><h1>Title&nbsp;of\nit</h1></header><p>First <b>bo</b>ld &lt;tag&gt; &copy; caf&eacute;.<br>After break<p>Sh is.</p><form>Name <input name=x></form><p>{LONG}</p>
<aside>Aside {LONG}</aside><p>Last.</p><section id="comments"><p>I disagree. {LONG}</p></section></article>
<footer>&copy; Site {LONG}</footer></body></html>"""
WANT = f"Title of it First bold <tag> © café. After break Sh is. {LONG} Last."


def test_article_of_a_marked_page():
    assert main_text(PAGE) == WANT


def test_pages_without_an_article_element():
    body = "".join(f"<div class=x><p>{LONG} {i}</p></div>" for i in range(4))
    menu = "".join(f'<div><a href="/{i}">Entry number {i} of the menu</a></div>' for i in range(9))
    page = f"<body>{menu}{body}<p>Short end.</p>{menu}<div>(c)</div></body>"
    assert main_text(page) == " ".join([*(f"{LONG} {i}" for i in range(4)), "Short end."])


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("   ") == main_text("<p></p>") == ""
    assert main_text("<script>" + LONG) == ""
    assert main_text("<article>a < b and <b>unclosed") == "a < b and unclosed"
    assert main_text("<article><p>x</div></span></p>y</article>") == "x y"
    assert main_text("<article><p don't>it's</p><p title='a>b' x=\"c>d\">ok</p></article>") == "it's ok"
    assert main_text("<ARTICLE CLASS='post'><P>Up</P></ARTICLE>") == "Up"
    assert main_text("<article>a<span class='ad'>no</span>b<i>c</i></article>") == "a bc"
    assert main_text("<article><p>" + "word " * 100_000 + "</p></article>") == ("word " * 100_000).strip()
    assert main_text("<main><p>one</p><nav><a>x</a><a>y</a></nav><div class=sidebar><p>a</p><p>b</p><p>c</p><p>d</p></div><p>two</p></main>") == "one two"
    assert lines_of("<p>a &amp; b</p>")[0][0] == "a & b"


def test_rows(spark):
    rows = [(1, "u", PAGE, 1, "x"), (1, "u", PAGE, 1, "x"), (2, None, None, 1, "x"), (None, "v", "", 1, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = extracted(df).collect()
    assert [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got] == [(1, "u", WANT, len(WANT))] * 2 + [(2, None, "", 0), (None, "v", "", 0)]
    assert extracted(df.limit(0)).count() == 0


def test_short_and_parted_text_without_an_article_element():
    assert main_text("<body><p>One paragraph of a page, and short.</p></body>") == "One paragraph of a page, and short."
    adverts = "<div class=ad>Buy</div>" * 3
    assert main_text(f"<div><p>{'word ' * 200}</p>{adverts}<p>{'end ' * 50}</p></div>") == ("word " * 200 + "end " * 50).strip()
    assert main_text(f"<div><p>{LONG}</p>{adverts}<p>Short.</p>{adverts}<p>{LONG}</p></div>") == f"{LONG} Short. {LONG}"
    assert main_text(f"<div><p>{LONG}</p></div>{adverts}<div>(c)</div>") == LONG


def test_self_closed_elements_end_at_once():
    for name in ("svg", "math", "iframe src='x'"):
        assert main_text(f"<article><p>one</p><{name}/><p>two</p></article>") == "one two"
    assert main_text("<article><svg/><p>two</p><svg><title>no</title></svg></article>") == "two"
    assert main_text("<article><iframe/>no</iframe><p>two</p></article>") == "two"


@given(st.lists(st.sampled_from([0, 0, 1, 5, 30, 400]), max_size=40), st.data())
def test_stretches_and_choice_by_brute_force(size, data):
    w = line_blocks.WINDOW
    containers = data.draw(st.lists(st.integers(0, 3), min_size=len(size), max_size=len(size)))
    runs, gap = [], w  # a run ends when w empty lines in a row make a block's sum zero
    for k, n in enumerate(size):
        if n and gap >= w:
            runs.append([k, k + 1])
        elif n:
            runs[-1][1] = k + 1
        gap = 0 if n else gap + 1
    block = [sum(size[max(0, k) : k + w]) for k in range(1 - w, len(size))]
    want = [(a, b, max(block[k + w - 1] for k in range(a - w + 1, b))) for a, b in runs]
    assert stretches(size) == want
    sure = [r for r in want if r[2] > line_blocks.SURGE * max(block)]
    at = {containers[k] for a, b, _ in sure for k in range(a, b) if size[k]}
    near = [i for i, (a, b, _) in enumerate(want) if any(size[k] and containers[k] in at for k in range(a, b))]
    assert kept_stretches(size, containers) == ([r[:2] for r in want[near[0] : near[-1] + 1]] if near else [])


def test_window_and_surge_decide_where_no_article_is_named(monkeypatch):
    advert = "<div class=ad>Buy</div>"
    near, far = (f"<div><p>{LONG}</p></div>{advert * n}<div><p>End.</p></div>" for n in (2, 3))
    assert main_text(near) == f"{LONG} End."
    assert main_text(far) == LONG  # the sums dive, and do not surge again
    monkeypatch.setattr(line_blocks, "WINDOW", 2)
    assert main_text(near) == LONG
    monkeypatch.setattr(line_blocks, "WINDOW", 4)
    assert main_text(far) == f"{LONG} End."
    monkeypatch.setattr(line_blocks, "WINDOW", 3)
    monkeypatch.setattr(line_blocks, "SURGE", 0.01)
    assert main_text(far) == f"{LONG} End."


def test_no_stretch_of_a_named_article_is_lost():
    aside = f"<aside>{LONG}</aside>" * 3
    long = "word " * 300
    assert main_text(f"<article><div><p>{long}</p></div>{aside}<div><p>The closing remark.</p></div></article>") == f"{long.strip()} The closing remark."
    assert main_text(f"<main><p>A.</p>{aside}<div><p>{long}</p></div></main><p>{LONG}</p>") == f"A. {long.strip()}"


def test_names_count_as_wholes():
    kept = ["comments-on-history", "advertising-in-japan", "share-of-wealth", "news-headernote", "search-for-meaning", "navalbattles"]
    gone = ["comments", "comment-list", "site-footer", "cookie-notice", "left-sidebar", "ad_box", "share-buttons", "header-nav", "post x sidebar"]
    for name in kept:
        assert main_text(f"<article><p>One.</p><section id='{name}'><p>Two.</p></section></article>") == "One. Two.", name
    for name in gone:
        assert main_text(f"<article><p>One.</p><section class='{name}'><p>Two.</p></section></article>") == "One.", name


def test_batches_of_pages_are_bounded(spark):
    extracted(spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")).collect()
    assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4 << 20
