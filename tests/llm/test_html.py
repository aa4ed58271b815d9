import random
from html import escape
from html.parser import HTMLParser

import pytest

from clickloom.llm.html import BLOCKS, Page, extracted, host_of, main_text, op10_html_text, winning_paths

SCHEMA = "page_id long, url string, html string, path string, host string"
LONG = "A sentence of some length, with a comma, that could be part of an article."


def page(body, cls="post-12"):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>"
        f"<div class='cookie-notice'>We use cookies, of course, many, many of them.</div><div class='{cls}'>{body}</div>"
        "<div class=sidebar><p>Side text, also long, with commas, a few of them.</p></div>"
        "<section id=comments><p>A reader says a lot, really a lot, on and on, more than the article, far more."
        "</p></section><form>Name <input></form><footer>&copy; all</footer></body></html>"
    )


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p", ""), ("<!-- <p>x</p>", ""),
    (f"<article><h1>H</h1><p>{LONG}<p>a&amp;b &lt;c&gt;\n\t d<br>e</article>", f"H\n{LONG}\na&b <c> d e"),
    (page(f"<p>{LONG}</p><ul><li>one<li>two</ul><script>if (1<2) x('</p>')</script>"), f"{LONG}\none\ntwo"),
    (page(f"<p>{LONG} <a href=x>a link</a>, more.<aside>not this</aside><div class='ad box'>nor this</div>"), f"{LONG} a link, more."),
    (f"<article><p>{LONG}</p><p>cut &am", f"{LONG}\ncut &am"),
    (f"<article><p>{LONG}</p><p class='x", LONG),
    (f"<ARTICLE><P>{LONG}</P><TEXTAREA>no <p>no</TEXTAREA></ARTICLE>", LONG),
    (f"<article><p><b>bold <i>both</b> rest</p><p>{LONG}</article><p>out", f"bold both rest\n{LONG}"),
    # Names that say something about an article.
    (f"<div class='content no-sidebar'><p>{LONG}</p></div>", LONG),
    (f"<div class='site has-sidebar'><p>{LONG}</p><div class=sidebar><p>{LONG} side</p></div></div>", LONG),
    (f"<article class='post comments-open'><p>{LONG}</p></article>", LONG),
    (f"<main class='search-results'><p>{LONG}</p></main>", LONG),
    (f"<article title='not hidden here'><p>{LONG}</p></article>", LONG),
    (f"<div class='share-page'><h1>H</h1><p>{LONG}</p></div>", f"H\n{LONG}"),
    (f"<form id=page><div><h1>H</h1><p>{LONG}</p></div></form>", f"H\n{LONG}"),
    (f"<div class=widget><p>{LONG}</p></div>", LONG),
    (f"<div hidden><p>{LONG} no</p></div><div class=x><p>{LONG}</p></div>", LONG),
    # An article in parts.
    (f"<article><h1>H</h1><p>lead</p><div class=body>{f'<p>{LONG}</p>' * 9}</div></article>", "\n".join(["H", "lead"] + [LONG] * 9)),
    (f"<div class=story><div class=a><p>{LONG}</p></div><div class=b>{f'<p>{LONG}</p>' * 3}</div></div>", "\n".join([LONG] * 4)),
    (f"<div class=story><ul><li><a href=x>{LONG}</a></ul><div class=b><p>{LONG}</p></div></div>", LONG),
])
def test_pages(html, text):
    assert main_text(html) == text


def test_long_page():
    blocks = [f"{LONG} {k}" for k in range(5000)]
    assert main_text(page("".join(f"<p>{b}</p>" for b in blocks))) == "\n".join(blocks)


def test_host(spark):
    urls = ["http://A.example:80/x", "https://u:p@b.example?q", "ftp://c", "no url", None, "http://"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.h for r in frame.select(host_of(frame.url).alias("h")).collect()] == ["a.example", "b.example", "c", "", "", ""]


def test_the_host_decides(spark):
    # The template's article is div.story; on one page another block is longer.
    story = "<div class='story'><p>{}</p></div><div class='box'><p>{}</p></div>"
    rows = [(k, "http://h/x", story.format(LONG * 3, "x"), "p", "h") for k in range(5)]
    rows += [(9, "http://h/y", story.format("Short.", LONG * 5), "p", "h"), (10, "http://other/", story.format("Short.", LONG * 5), "p", "h")]
    rows += [(11, None, None, "p", "h"), (12, "http://h/z", f"<td>{LONG}</td>", "p", "h"), (12, "http://h/z", f"<td>{LONG}</td>", "p", "h")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert dict(winning_paths(frame).where("host = 'h'").collect()) == {"h": "/div.story"}
    got = sorted((tuple(r) for r in extracted(frame).collect()), key=repr)
    text = {9: "Short.", 10: LONG * 5, 11: "", 12: LONG} | {k: LONG * 3 for k in range(5)}
    assert got == sorted(((r[0], r[1], text[r[0]]) for r in rows), key=repr)
    assert extracted(frame.limit(0)).count() == 0


def test_paths_have_no_digits():
    assert Page(page(f"<p>{LONG}</p>", "post-77 a9")).best().path == "/body/div.a#.post-#"


class Tree(HTMLParser):
    """A second extractor, for well-formed pages: every element is a node, and the article's blocks are
    read off by walking the tree."""

    VOID = {"br", "img", "meta", "link", "input", "hr"}

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.root = self.at = {"tag": "", "classes": [], "kids": [], "up": None}
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "classes": (dict(attrs).get("class") or "").split() + [dict(attrs).get("id") or ""], "kids": [], "up": self.at}
        self.at["kids"].append(node)
        if tag not in self.VOID:
            self.at = node

    def handle_endtag(self, tag):
        at = self.at
        while at["up"] is not None and at["tag"] != tag:
            at = at["up"]
        if at["up"] is not None:
            self.at = at["up"]

    def handle_data(self, data):
        self.at["kids"].append(data)

    def find(self, node, wanted):
        if wanted(node):
            return node
        for kid in node["kids"]:
            if isinstance(kid, dict) and (found := self.find(kid, wanted)):
                return found
        return None

    def blocks(self, node, wanted, out):
        """Texts of the blocks in a node; anything with a block inside is cut there."""
        for kid in node["kids"]:
            if isinstance(kid, str):
                out[-1] += kid
            elif kid["tag"] == "br":
                out[-1] += " "
            elif not wanted(kid):
                out.append("")
            elif kid["tag"] in BLOCKS:
                out.append("")
                self.blocks(kid, wanted, out)
                out.append("")
            else:
                self.blocks(kid, wanted, out)
        return out

    def text(self, holder, wanted):
        found = self.find(self.root, holder)
        texts = [" ".join(b.split()) for b in self.blocks(found, wanted, [""])] if found else []
        return "\n".join(t for t in texts if t)


NOT_ARTICLE = {"script", "style", "nav", "aside", "footer", "form", "button"}


def wanted(node):
    names = {"ad", "cookie-notice", "sidebar", "comments", "related-posts", "share-bar", "newsletter"}
    return node["tag"] not in NOT_ARTICLE and not names.intersection(node["classes"])


@pytest.mark.parametrize("seed", range(6))
def test_generated_templates(seed):
    """Articles in parts, in wrappers with telling names, among all kinds of noise."""
    rng = random.Random(seed)
    words = "time river stone, people house, morning water garden; road winter & <tag> “quote” é".split()

    def sentence(low=6, high=30):
        return escape(" ".join(rng.choice(words) for _ in range(rng.randrange(low, high)))) + "."

    noise = ["<aside>{}</aside>", "<div class='ad'><p>{}</p></div>", "<div class='share-bar'>{}</div>", "<script>var a = '<p>{}</p>';</script>",
             "<form><label>{}</label><input></form>", "<ul class='related-posts'><li>{}</li></ul>", "<div id='newsletter'><p>{}</p></div>"]
    for _ in range(60):
        parts = [f"<h1>{sentence(2, 5)}</h1>", f"<p>{sentence()}</p>"]
        for _ in range(rng.randrange(1, 5)):
            paragraphs = "".join(rng.choice([f"<p>{sentence(20, 60)}</p>", f"<p>{sentence()} <a href='x'>{sentence(2, 4)}</a> {sentence()}</p>",
                                             f"<ul><li>{sentence()}</li><li>{sentence()}<br>{sentence(2, 4)}</li></ul>", f"<h2>{sentence(2, 5)}</h2>"]) for _ in range(rng.randrange(1, 6)))
            parts.append(rng.choice([paragraphs, f"<div class='part-{rng.randrange(9)}'>{paragraphs}</div>", f"<section>{paragraphs}</section>"]))
            if rng.random() < 0.5:
                parts.append(rng.choice(noise).format(sentence(3, 50)))
        tag = rng.choice(["article", "main"])
        names = rng.choice(["", " class='post comments-open'", " class='no-sidebar'", " class='ad-free has-ad'", " title='hidden'"])
        article = f"<{tag}{names}>{''.join(parts)}</{tag}>"
        outer = rng.choice(["{}", "<div class='site has-sidebar'>{}</div>", "<div id='page'><div class='row'>{}</div></div>"])
        html = (
            "<html><head><title>t</title></head><body><header><h1>Site</h1><p>words, words</p></header><nav><a href='/'>Home</a></nav>"
            f"<div class='cookie-notice'><p>{sentence(20, 80)}</p></div>" + outer.format(article)
            + f"<div class='sidebar'><p>{sentence(20, 80)}</p></div><section id='comments'><p>{sentence(50, 200)}</p></section><footer>{sentence()}</footer></body></html>"
        )
        assert main_text(html) == Tree(html).text(lambda n: n["tag"] == tag, wanted)


def test_given_pages(spark, sf_dir):
    """Every given page against the walk over its tree."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in op10_html_text(spark, sf_dir).collect()}
    assert got.keys() == pages.keys()
    for page_id, html in pages.items():
        assert got[page_id] == Tree(html or "").text(lambda n: n["tag"] == "article", wanted)
