import html
import re
import time

from conftest import SF001
from riskgrid.llm.page_text import extract_text, main_text


def article_of(page):
    m = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", m[1]) if m else []
    text = [" ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<br>", " ", p))).split()) for p in parts]
    return "\n\n".join(t for t in text if t)


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    want = {r.page_id: article_of(r.html) for r in pages.collect()}
    out = extract_text(pages).collect()
    assert {r.page_id: r.text for r in out} == want and len(out) == len(want)
    assert all(r.n_chars == len(r.text) for r in out)


def wrap(body, extra=""):
    return f"<html><body><div class='top'>Site</div><ul><li>One<li>Two</ul><div id=content>{body}</div>{extra}<div class=legal>All text ours</div></body>"


def test_template_without_an_article_element(spark):
    pages = [(i, f"http://h.org/{i}", wrap("".join(f"<p>story {i} part {j} &amp; more</p>" for j in range(5 + i))), "x") for i in range(6)]
    pages += [(90, None, "", None), (91, "http://solo.net/", None, None), (92, "nourl", "<p>just  this\n&#233;<p class='notice'>no<p>and", None),
              (93, "http://solo.net/", "<body><nav>menu</nav><main><h1>T</h1>a<b>b</b>c<section class='comments'><p>hi</p></section></main>", None),
              (93, "http://solo.net/", "<body><nav>menu</nav><main><h1>T</h1>a<b>b</b>c<section class='comments'><p>hi</p></section></main>", None),
              (94, "http://long.net/", "<article>" + "<div>" * 3000 + "x &lt;y&gt; " * 50_000 + "<script>if (a<b) {</script>", None), (None, "http://h.org/z", wrap("<p>zed"), "x")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, host string")  # host clashes with an inner name
    out = extract_text(df).collect()
    assert len(out) == len(pages)
    got = {r.page_id: r.text for r in out}
    for i in range(6):
        assert got[i] == "\n\n".join(f"story {i} part {j} & more" for j in range(5 + i))
    assert got[None] == "zed" and got[90] == got[91] == "" and got[92] == "just this é\n\nand"
    assert got[93] == "T\n\nabc" and got[94] == " ".join(["x <y>"] * 50_000)
    assert extract_text(df.limit(0)).count() == 0


def test_parts_that_are_never_text():
    page = ("<title>t</title><!-- c --><header>h</header><article><header><h1>Head</h1></header><p>a <i>b</i> c<br>d</p><aside>no</aside>"
            "<div class='share-box'>no</div><form>no</form><style>p{}</style><ul><li>x<li>y</ul></article><footer>f</footer>")
    assert main_text(page, [], set()) == "Head\n\na b c d\n\nx\n\ny"


def test_repeated_text_in_the_main_slot_stays(spark):
    """Copies of one page make up most of a host without article elements."""
    copy = wrap("".join(f"<p>the same long story part {j}</p>" for j in range(4)))
    pages = [(i, f"http://c.org/{i}", copy) for i in range(6)]
    pages += [(10 + i, f"http://c.org/o{i}", wrap("".join(f"<p>tale {i} has its own part {j}</p>" for j in range(4)))) for i in range(3)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert all(got[i] == "\n\n".join(f"the same long story part {j}" for j in range(4)) for i in range(6))
    assert got[11] == "\n\n".join(f"tale 1 has its own part {j}" for j in range(4))


def test_wrapped_articles_and_titled_headers():
    for name in ("content-sidebar-wrap", "layout has-sidebar", "elementor-widget", "site header"):
        assert main_text(f"<body><nav>menu</nav><div class='{name}'><article><p>text</p><div class='comments'>no</div></article></div></body>", [], set()) == "text"
        assert main_text(f"<body><nav>menu</nav><div class='{name}'><p>text</p></div></body>", [], set()) == "text"
    assert main_text("<article><div class='post-header'><h1>Title</h1></div><p>text</p><div class='share-box'>no</div></article>", [], set()) == "Title\n\ntext"
    assert main_text("<form><main><p>text</p></main></form><aside><article>other</article></aside>", [], set()) == "text"


def test_empty_and_unclosed_raw_elements():
    assert main_text("<article><p>a <svg class='i' width=1 /> b</p><p>c<svg><path d=1 /></svg> d</p></article>", [], set()) == "a b\n\nc d"
    for tag in ("button", "object", "select"):
        assert main_text(f"<article><p>a <{tag} id=x> b</p><p>c <{tag}>no</{tag}> d</p></article>", [], set()) == "a b\n\nc d"


def test_names_do_not_take_the_article():
    for name in ("layout has-comments", "bg-navy", "ad-free", "navy-theme", "social-layout"):
        assert main_text(f"<body><nav>menu</nav><div class='{name}'><article><p>text</p></article></div><p>rest</p></body>", [], set()) == "text", name
        if "comments" not in name:
            assert main_text(f"<body><div class='{name}'><p>a long text of its own</p></div><p>rest</p></body>", [], set()).startswith("a long text"), name
    assert main_text("<article><h1 class='entry-header'>Title</h1><p class='share-price'>It rose</p><p class='notice'>no</p>"
                     "<div class='related-work'><p>no</p></div></article>", [], set()) == "Title\n\nIt rose"
    # reader comments go: in a section, as articles, in a section without a name, and where they are most of the page
    assert main_text("<article><p>text</p></article><section class='comments'><article><p>no</p></article></section>", [], set()) == "text"
    assert main_text("<article><p>text</p></article><section><article class='comment'><p>no, and at length</p></article></section>", [], set()) == "text"
    assert main_text("<div><p>text</p></div><div id='comments'><p>no, and at some length besides</p></div>", [], set()) == "text"


def test_the_template_chooses_over_tags(spark):
    """The same promotion stands in an article element of every page; the story does not.  Without the template it would win."""
    def page(i):
        story = "".join(f"<p>story {i} has part {j} &amp; more</p>" for j in range(4 + i % 3))
        return (f"<body><div class=top>Site</div><article class=teaser><h2>Buy</h2><p>our book</p></article>"
                f"<div id=story><h1>Title {i}</h1>{story}</div><div class=legal>All ours</div></body>")
    pages = spark.createDataFrame([(i, f"http://t.org/{i}", page(i)) for i in range(6)], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    for i in range(6):
        want = "\n\n".join([f"Title {i}", *(f"story {i} has part {j} & more" for j in range(4 + i % 3))])
        assert got[i] == want and main_text(page(i), [], set()) == "Buy\n\nour book"


def test_tags_end_at_the_next_bracket():
    assert main_text("<article><p>a <b c <i>d</i> e</p><p title='x < y' id=\"p\">f</p>g<", [], set()) == "a d e\n\nf\n\ng<"
    assert main_text("<article><p>a<!-- <p>no</p> -->b<![CDATA[c]]>d<? e ?>f<!-- open <p>no</p>", [], set()) == "abdf"
    assert main_text("<article><p>a<script>if (x<y) { '</p>' }</SCRIPT >b</p></script>c", [], set()) == "ab\n\nc"


def test_time_follows_the_length():
    def took(text):
        began = time.perf_counter()
        main_text(text, [], set())
        return time.perf_counter() - began
    for unit in ("<" + "a" * 50, "<a ", "<script ", "<svg x", "<button ", "<!", "<!-- ", "<a \"", "<a '\"", "<div class='ads'>", "</div>", "&amp", "<select><button>"):
        small, large = (min(took(unit * n) for _ in range(3)) for n in (4_000, 32_000))
        assert large < 20 * small + 0.5, (unit, small, large)
