import json
import random

from tidemark.llm import wrappers as W

PAGE = """<!DOCTYPE html><html><head><title>T &amp; more</title><style>p{{a:b}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- no <p>text</p> -->
<div class="ad">Buy &lt;now&gt;</div><div id="cookie-notice"><p>We use cookies.</p></div>
<article class="post"><header><h1>Title &eacute; {n}</h1></header><p><b>First   block
goes on<br>here<p>Second &nbsp;one</p>{more}<form><input value=1><button>Send</button></form>
<section class="comments"><p>Nice post!</p></section></article><aside><p>Related</p></aside><footer>&copy; me</footer>"""


def test_the_article_without_furniture():
    page = PAGE.format(n=1, more="<ul><li>item one<li>item <i>two</i></ul><blockquote>Said <a href=x>so</a>.</blockquote>")
    assert W.main_text(page).split("\n\n") == [
        "Title é 1", "First block goes on here", "Second one", "item one", "item two", "Said so.",
    ]
    assert W.main_text(None) == W.main_text("") == W.main_text("<nav>x</nav>") == ""
    assert W.main_text("plain &amp; simple") == "plain & simple"
    assert W.main_text("<main><p>in</p></main><p>out</p>") == "in"
    assert W.main_text("<div><p>a<div>b</div>c</div><p>d") == "a\n\nb\n\nc\n\nd"
    assert W.main_text("<p>a &lt;b&gt; c <broken") == "a <b> c"
    long = "<article>" + "<p>word</p>" * 20000 + "</article>"
    assert W.main_text(long).count("word") == 20000


def strip(nodes):
    return [[n[0], strip(n[1])] if n[0] in "?+" else (n[1] or "*") for n in nodes]


def test_folding_and_alignment_find_slots_repeats_and_optional_parts():
    a = W.page_nodes("<ul><li>a</li><li><b>b</b></li></ul><h1>x</h1><div>same</div>")
    assert strip(a)[1] == ["+", ["<li>", "*", "</li>"]]
    w = W.align(a, W.page_nodes("<ul><li>q</li><li>r</li><li>s</li></ul><h1>y</h1><p>more</p><div>same</div>"))
    assert strip(w) == [
        "<ul>", ["+", ["<li>", "*", "</li>"]], "</ul>", "<h1>", "*", "</h1>", ["?", ["<p>", "more", "</p>"]], "<div>", "same", "</div>",
    ]
    assert W.furniture(w, 2) == {"same"} and W.furniture(w, 3) == W.furniture(W.page_nodes("<p>a</p>"), 1) == set()


def test_blocks_in_any_order_become_one_group():
    kinds = ["<p>{}</p>", "<p>{}</p><p>{}</p>", "<h2>{}</h2>", "<ul><li>{}</li></ul>"]
    wrapper = W.page_nodes("<h1>t</h1><p>a</p><h2>b</h2><p>c</p><footer>f</footer>")
    for i in range(60):
        body = "".join(kinds[(i * 7 + k * k) % 4].format(k, k + 1) for k in range(3 + i % 9))
        wrapper = W.align(wrapper, W.page_nodes(f"<h1>{i}</h1>{body}<footer>f</footer>"))
    assert len(json.dumps(wrapper)) < 3000
    assert W.furniture(wrapper, 50) == {"f"}


def rows():
    out = [(i, f"http://site.example/{i}", PAGE.format(n=i, more="<p>Own text %d</p>" % i * (i % 4))) for i in range(30)]
    # furniture that no tag or name gives away, in all articles of a host
    out += [(100 + i, f"https://other.example/{i}", f"<body><div><h2>Written by our team</h2><p>Text {i} of its own.</p></div>") for i in range(20)]
    return out + [(200, None, None), (201, "", ""), (202, "http://site.example/0", "x"), (202, "http://site.example/0", "x")]


def test_pages(spark):
    df = spark.createDataFrame([(*r, "a", 1) for r in rows()], "page_id long, url string, html string, host string, known int").repartition(5)
    got = W.extract(df).toPandas()
    by = dict(zip(got["page_id"], got["text"]))
    assert len(got) == 54 and (got["n_chars"] == got["text"].map(len)).all()
    for i in range(30):
        assert by[i].split("\n\n") == [f"Title é {i}", "First block goes on here", "Second one"] + [f"Own text {i}"] * (i % 4)
    assert all(by[100 + i] == f"Text {i} of its own." for i in range(20))
    assert by[200] == by[201] == "" and by[202] == "x"
    assert W.extract(df.limit(0)).count() == 0


def test_wrappers_don_t_depend_on_how_pages_are_dealt(spark):
    df = spark.createDataFrame([(r[1], r[2]) for r in rows()[:50]], "url string, html string").selectExpr("parse_url(url, 'HOST') AS host", "html")
    found = [{r["host"]: r for r in W.infer(df.repartition(n)).collect()} for n in (1, 7)]
    for host in found[0]:
        assert found[0][host]["pages"] == found[1][host]["pages"]
        a, b = (W.furniture(json.loads(f[host]["wrapper"])) for f in found)
        assert a == b


def test_no_article_text_is_lost_to_names():
    assert W.main_text('<article><div class="content no-sidebar"><p>All of it</p></div></article>') == "All of it"
    assert W.main_text('<article><section id="related-work"><h2>Before</h2><p>Others.</p></section></article>') == "Before\n\nOthers."
    assert W.main_text('<article><h2 id="side-effects">Effects</h2><p>None.</p><section id="legal-issues"><p>Few.</p></section></article>') == "Effects\n\nNone.\n\nFew."
    assert W.main_text("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds, <object>as shown</object>.</p></article>") == "So x=1 holds, as shown."
    for name in ("ad", "sidebar", "ad-slot", "cookie-notice", "site-footer", "related", "comments", "comment-list", "newsletter-form", "nav1", "social-share"):
        assert W.main_text(f'<article><p>In.</p><div class="{name} x"><p>Out.</p></div></article>') == "In.", name


def pages_of(host, n, notice="Read our terms."):
    """Articles with a notice that no tag or name gives away."""
    return [(f"http://{host}/{i}", f"<article><h1>T{i}</h1><p>Body {i} of {host}.</p><div><p>{notice}</p></div></article>") for i in range(n)]


def test_the_wrapper_decides_within_articles(spark):
    rows = pages_of("a.example", 20) + pages_of("b.example", 3)
    # near copies of one article are not most of a host, and what they share is theirs
    rows += [(f"http://a.example/x{i}", f"<article><h1>Copy</h1><p>Shared words.</p><p>Own {i}.</p><div><p>Read our terms.</p></div></article>") for i in range(9)]
    # copies of one page on a host that varies: its quote is its own
    rows += [(f"http://c.example/{i}", f"<div><h2>T{i}</h2><p>P{i}</p></div>") for i in range(20)]
    rows += [(f"http://c.example/c{i}", "<div><h2>C</h2><blockquote>Quote</blockquote><p>end</p></div>") for i in range(12)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").repartition(6)
    got = {r["url"]: r["text"] for r in W.extract(df).collect()}
    without = {r["url"]: r["text"] for r in W.extract(df, share=2.0).collect()}
    assert got["http://a.example/1"] == "T1\n\nBody 1 of a.example." != without["http://a.example/1"]
    assert got["http://b.example/1"] == "T1\n\nBody 1 of b.example.\n\nRead our terms."  # too few pages to tell
    assert got["http://a.example/x3"] == "Copy\n\nShared words.\n\nOwn 3."
    assert got["http://c.example/c3"] == "C\n\nQuote\n\nend"


def test_extraction_equals_brute_force_on_planted_pages(spark):
    """Pages built from known article blocks and furniture: the text is what was planted."""
    rng = random.Random(4)
    shells = {
        "tags": "<body><nav><p>Go</p></nav>{0}<footer><p>End</p></footer></body>",
        "names": '<body><div class="menu"><p>Go</p></div>{0}<div id="comments"><p>Me too</p></div></body>',
        "bare": "<body><div><h4>Welcome to the site</h4>{0}<address>All rights are ours</address></div></body>",
    }
    rows, want = [], {}
    for host, shell in shells.items():
        for i in range(25):
            blocks = [f"{host} {i} {k} " + " ".join(rng.choice("ab cd ef gh".split()) for _ in range(6)) for k in range(rng.randint(1, 6))]
            marked = "".join(rng.choice(["<p>{}</p>", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>"]).format(b) for b in blocks)
            page = shell.format(marked if host == "bare" else f"<article>{marked}</article>")
            rows.append((len(rows), f"https://{host}.example/{i}", page))
            want[rows[-1][0]] = "\n\n".join(blocks)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r["page_id"]: r["text"] for r in W.extract(df).collect()} == want
