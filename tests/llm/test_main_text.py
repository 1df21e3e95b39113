import html
import re

from skyledger.llm import main_text as M
from tests.conftest import SF

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{x}</style></head><body class="no-sidebar">
<header><a href="/">Site</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this page better for everyone who reads it.</p></div>
<main><article><h1>A &lt;title&gt;</h1><p>First  part,
with <a href="x>y">a link</a> &eacute;&#233;.<br>More.<p>Second<script>var a="<p>no</p>";</script> part.
<ul><li>An item</li></ul><div class="ad">Buy now</div><form><label>Name</label></form>
<section id="comments"><p>A long comment of a reader with many words that looks like text of the page.</p></section>
</article></main><aside>Side words</aside><footer>&copy; all</footer></body></html>"""


def test_blocks_of_a_page():
    wanted = "A <title>\n\nFirst part, with a link éé. More.\n\nSecond part.\n\nAn item"
    assert M.main_texts([PAGE]) == [wanted]


def test_plain_pages_without_an_article():
    body = "<div>" + "word " * 50 + "</div>"
    assert M.main_texts([f"<ul><li><a>x</a></li><li><a>y</a></li></ul>{body}<p>{'more ' * 40}"]) == [
        ("word " * 50).strip() + "\n\n" + ("more " * 40).strip()
    ]


def test_query_returns_the_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = M.op8_main_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>|</?b>", " ", inside[1] if inside else ""))
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(>|\Z)", " ", b)).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, "<!-- open"), (4, "<article><p>a b c d e f g h i j k l m n o p q r s t</article><scr"),
        (5, "<p>" * 20_000 + "x" * 10), (6, "<a b='" * 2000), (7, "</div></p>" * 5000), (8, PAGE), (8, PAGE),
        (9, "<article>" + "<p>same words again</p>" * 3),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, html string, main_text string")
    got = {}
    for r in M.with_main_text(pages).collect():
        got.setdefault(r.page_id, []).append(r.main_text)
    assert [got[i] for i in (1, 2, 3)] == [[""]] * 3
    assert got[4] == ["a b c d e f g h i j k l m n o p q r s t"]
    assert got[8][0] == got[8][1] and got[9] == ["\n\n".join(["same words again"] * 3)]
    assert M.with_main_text(pages.limit(0)).count() == 0


def test_layout_with_furniture_names_keeps_the_article():
    text, more = ("word " * 50).strip(), ("more " * 40).strip()
    body = f"<p>{text}</p><p>{more}</p>"
    links = "<ul><li><a>One</a></li><li><a>Two</a></li></ul>"
    wanted = [f"{text}\n\n{more}"]
    assert M.main_texts([f"<div class='content-sidebar-wrap'><main><h1>T</h1>{body}</main></div>"]) == [f"T\n\n{wanted[0]}"]
    assert M.main_texts([f"<div class='sidebar'><main>{body}</main>{body}</div>"]) == wanted
    assert M.main_texts([f"<div class='widget'><article>{body}</article></div>{links}"]) == wanted
    for wrapper in ("class='layout has-sidebar'", "id='page' class='with-menu'"):
        assert M.main_texts([f"<div {wrapper}>{links}<div>{body}</div>{links}</div>"]) == wanted
    for wrapper in ("aside", "div class='sidebar'", "div class='comments'"):
        assert M.main_texts([f"<{wrapper}>{body}</{wrapper.split()[0]}>"]) == [""]
    assert M.main_texts([f"<div class='comments'><article>{body}</article></div>"]) == [""]
