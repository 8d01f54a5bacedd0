"""Main text of pages: of the given ones against another reading, and of odd ones."""

from html.parser import HTMLParser

import pytest

from quotelane.llm import templates
from quotelane.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


class _Article(HTMLParser):
    """Blocks of the article as the standard parser tells tags and text apart."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = {r["page_id"]: r for r in QUERIES["op13_templates"](spark, SF).collect()}
    assert len(found) == len(pages)
    for page in pages:
        reader = _Article()
        reader.feed(page["html"])
        reader.close()
        text = "\n".join(b for b in (" ".join(b.split()) for b in reader.blocks) if b)
        row = found[page["page_id"]]
        assert (row["text"], row["n_chars"], row["url"]) == (text, len(text), page["url"])


def _extract(spark, rows):
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS host", "2 AS token", "'x' AS text", "3 AS slots")
    return sorted(((r["page_id"], r["text"]) for r in templates.extract(frame).collect()), key=_by_id)


def _by_id(row):
    return -1 if row[0] is None else row[0]


def _page(i, body):
    return (i, f"https://www.site.example/p{i}?q=1#a", f"<html><head><title>T</title></head><body>{body}</body></html>")


def test_template_of_a_host_without_articles(spark):
    """Menus without any name are known by their links, fixed lines by being on all pages."""
    bodies = [
        f"<div><a href='/'>Home</a> <a href='/b'>About us {i}</a></div><div class=x{i}><h2>Title {i}</h2><p>Text number {i} says much &amp; more.</p>"
        f"<p>Second   part\n{i}</p></div><div>All rights reserved by nobody.</div>"
        for i in range(6)
    ]
    got = _extract(spark, [_page(i, b) for i, b in enumerate(bodies)])
    assert got == [(i, f"Title {i}\nText number {i} says much & more.\nSecond part {i}") for i in range(6)]


def test_copies_of_an_article_are_not_its_template(spark):
    body = "<nav>menu</nav><article><h1>Same</h1><p>words in all copies</p></article><footer>foot</footer>"
    got = _extract(spark, [_page(i, body) for i in range(30)])
    assert got == [(i, "Same\nwords in all copies") for i in range(30)]


CASES = {
    "nested parts": (
        "<header>h</header><main><article><header><h1>A</h1></header><aside>no</aside><p>one<form><p>no</form><ul><li>x<li>y</ul>"
        "<div class='ad-box'>no</div><div id='newsletter'>no</div></article><section id=comments><article>no</article></section></main>",
        "A\none\nx\ny",
    ),
    "notices": ("<div class='cookie-notice'>no</div><div role='banner'>no</div><div id='content'><p>yes<div hidden>no</div></div>", "yes"),
    "references": ("<article><p>a&nbsp;b &lt;p&gt; &#65;&#x42; &amp;lt; &copy &nosuch; 1 < 2</article>", "a b <p> AB &lt; © &nosuch; 1 < 2"),
    "scripts": ("<article><script>var a='<p>no</p></article>'</script><style>p{}</style><p>yes<!-- <p>no --></p><noscript>no</noscript></article>", "yes"),
    "attributes": ("<article><p title='a>b' data-x=\"</p>\">yes <a href=\"x>y\">link</a></p></article>", "yes link"),
    "unclosed menu": ("<nav><ul><li>no<article><p>yes</article>", "yes"),
    "unclosed comment": ("<article><p>yes</p><!-- no <p>no", "yes"),
    "white space": ("<article><p> a\n\tb<br>c <b>d</b>e  f </p>\n\n<p> </p></article>", "a b c de f"),
    "table": ("<article><table><tr><td>a<td>b<tr><th>c</table><dl><dt>d<dd>e</dl><pre> f\n g</pre></article>", "a\nb\nc\nd\ne\nf g"),
    "no markup": ("plain words", "plain words"),
    "only a menu": ("<nav><a href=x>no</a></nav>", ""),
}


@pytest.mark.parametrize("case", list(CASES))
def test_one_page(case):
    body, text = CASES[case]
    assert templates.main_text(f"<html><head><title>T</title><meta x></head><body>{body}", {}, set()) == text


def test_odd_rows(spark):
    long = "<article>" + "<p>many words here</p>" * 20_000 + "</article>"
    rows = [(1, None, "<p>a</p>"), (2, "", None), (3, "no host", ""), (4, "https://h.example/", long), (4, "https://h.example/", long),
            (None, "https://h.example/x", "<article>z</article>"), (5, "HTTP://user@H.example:80", "<article>q")]
    expected = [(1, "a"), (2, ""), (3, ""), (4, "\n".join(["many words here"] * 20_000))] + [(4, "\n".join(["many words here"] * 20_000))]
    assert _extract(spark, rows) == sorted([*expected, (None, "z"), (5, "q")], key=_by_id)
    assert templates.extract(spark.createDataFrame(rows, PAGES).limit(0)).count() == 0


def test_long_broken_markup_is_read_in_time():
    for page in ("<a " * 50_000, "<" * 200_000, "<p x='" * 20_000, "&" * 200_000, "<div>" * 3_000 + "t" + "</div>" * 3_000):
        templates.main_text(page, {}, set())
