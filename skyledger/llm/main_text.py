"""Main text of web pages: flat text blocks judged by a small decision tree.

The page is read once from left to right. Block tags end a block; each block keeps its text, its words,
the share of them inside links, whether it stands inside an article, and whether an element around it
names itself as furniture (a menu, notice, advert, form, reader comment and so on). The mark is a half
where only the layout around speaks of furniture (``has-sidebar``) or where an article stands in an element
with such a name; a main element, or an article in mere layout, is free of marks from around it. The tree
sees these and the words and link shares of the blocks before and after. It is grown at import from ``LABELLED``, a
table of blocks labelled by hand. Blocks it keeps are joined by an empty line.

Edge cases: NULL and empty pages have no text. An open comment or script, and a tag cut off by the
page's end, take the rest of the page. Any two blocks with equal text are both kept. Repeated pages are
extracted each. Columns named like the results are replaced; others are kept.
"""

from __future__ import annotations

import html as references
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W

# Element names of the markup language and their roles.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACE_TAGS = frozenset(["br", "img", "wbr", "input"])
DROPPED_TAGS = "script|style|noscript|template|title|textarea|select|button|svg|math|iframe|object|head"
FURNITURE_TAGS = frozenset("nav aside form menu dialog fieldset".split())
OUTER_FURNITURE_TAGS = frozenset(["header", "footer"])
ARTICLE_TAGS = frozenset(["article", "main"])
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs comment comments disqus reply replies respond share sharing social related "
    "recommended newsletter subscribe subscription signup login search widget toolbar pagination pager "
    "copyright legal disclaimer contentinfo complementary form".split()
)
#: Names that hold no article of the page itself, though they may hold article elements.
REPEATED_NAMES = frozenset("comment comments disqus reply replies respond related recommended".split())
#: Beside one of these, a furniture name only tells what the layout has.
LAYOUT_NAMES = frozenset(
    "has with without no wrap wrapper wrappers layout container outer inner page site content row columns grid".split()
)
OUTER_FURNITURE_NAMES = frozenset("header footer masthead topbar bottombar".split())

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    | <(?P<raw>{DROPPED_TAGS.replace("|head", "")})\b(?:[^"'>]|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)
    | <(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^"'>]|"[^"]*+"|'[^']*+')*+)(?:>|\Z)
    | </?[a-z!?/][^>]*+(?:>|\Z)""",
    re.X | re.S | re.I,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile("[a-z0-9]+")

#: words, link share, words before, link share before, words after, link share after, furniture, article,
#: and whether the block belongs to the main text.
FEATURES = 8
LABELLED = np.array(
    [
        # words, links, before, its links, after, its links, furniture, article, main text
        (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0), (2, 1.0, 1, 1.0, 12, 0.0, 1, 0, 0),
        (9, 0.0, 1, 1.0, 11, 0.0, 1, 0, 0), (31, 0.0, 2, 1.0, 8, 0.0, 1, 0, 0), (14, 0.1, 60, 0.0, 0, 0.0, 1, 0, 0),
        (90, 0.0, 40, 0.0, 5, 0.0, 1, 1, 0), (12, 0.0, 80, 0.0, 30, 0.0, 1, 1, 0), (45, 0.1, 3, 0.0, 20, 0.0, 1, 1, 0),
        (3, 0.0, 45, 0.0, 45, 0.0, 1, 1, 0), (6, 0.5, 70, 0.0, 6, 0.5, 1, 1, 0), (150, 0.0, 9, 0.0, 3, 1.0, 1, 0, 0),
        (11, 0.0, 14, 0.0, 52, 0.0, 0, 1, 1), (7, 0.0, 2, 1.0, 40, 0.0, 0, 1, 1), (55, 0.0, 12, 0.0, 64, 0.0, 0, 1, 1),
        (2, 0.0, 60, 0.0, 75, 0.0, 0, 1, 1), (120, 0.02, 30, 0.0, 44, 0.0, 0, 1, 1), (18, 0.0, 80, 0.0, 9, 0.1, 0, 1, 1),
        (1, 0.0, 25, 0.0, 31, 0.0, 0, 1, 1), (4, 0.0, 35, 0.0, 0, 0.0, 0, 1, 1), (40, 0.3, 50, 0.1, 22, 0.0, 0, 1, 1),
        (8, 0.4, 30, 0.0, 41, 0.0, 0, 1, 1), (25, 0.6, 60, 0.0, 40, 0.0, 0, 1, 1), (66, 0.0, 7, 1.0, 10, 1.0, 0, 1, 1),
        (1, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1), (2, 0.0, 1, 0.0, 1, 0.0, 0, 1, 1), (30, 0.0, 40, 0.0, 0, 0.0, 0, 1, 1),
        (9, 0.0, 0, 0.0, 6, 0.0, 0, 1, 1), (3, 0.0, 9, 0.0, 4, 0.1, 0, 1, 1), (70, 0.0, 1, 1.0, 0, 0.0, 0, 1, 1),
        (16, 0.0, 11, 0.0, 2, 1.0, 0, 1, 1), (44, 0.1, 5, 0.0, 3, 0.0, 0, 1, 1), (6, 0.0, 2, 1.0, 12, 1.0, 0, 1, 1),
        (200, 0.0, 6, 0.0, 1, 0.0, 0, 1, 1), (13, 0.2, 0, 0.0, 90, 0.0, 0, 1, 1), (2, 0.0, 3, 0.0, 5, 0.0, 0, 1, 1),
        (36, 0.0, 90, 0.0, 100, 0.0, 1, 0, 0), (60, 0.1, 50, 0.0, 70, 0.0, 1, 1, 0), (8, 0.0, 70, 0.0, 60, 0.0, 1, 0, 0),
        (20, 0.0, 0, 0.0, 45, 0.0, 1, 0, 0), (3, 1.0, 3, 1.0, 50, 0.0, 1, 0, 0), (110, 0.0, 100, 0.0, 0, 0.0, 1, 1, 0),
        (5, 1.0, 60, 0.0, 4, 1.0, 0, 1, 0), (3, 1.0, 4, 1.0, 3, 1.0, 0, 1, 0), (6, 1.0, 3, 1.0, 14, 0.0, 0, 1, 0),
        (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0), (4, 1.0, 0, 0.0, 5, 1.0, 0, 0, 0), (8, 0.9, 20, 0.0, 7, 1.0, 0, 0, 0),
        (5, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0), (4, 0.2, 0, 0.0, 1, 1.0, 0, 0, 0), (6, 0.0, 2, 1.0, 3, 0.5, 0, 0, 0),
        (3, 0.0, 5, 0.0, 2, 0.0, 0, 0, 0), (9, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0), (7, 0.1, 8, 0.1, 0, 0.0, 0, 0, 0),
        (30, 0.8, 10, 0.5, 25, 0.9, 0, 0, 0), (18, 0.7, 40, 0.1, 3, 1.0, 0, 0, 0), (12, 0.5, 6, 0.9, 5, 0.8, 0, 0, 0),
        (48, 0.0, 8, 0.0, 51, 0.0, 0, 0, 1), (75, 0.05, 40, 0.0, 33, 0.1, 0, 0, 1), (28, 0.0, 50, 0.0, 62, 0.0, 0, 0, 1),
        (130, 0.1, 3, 1.0, 20, 0.0, 0, 0, 1), (22, 0.1, 70, 0.0, 25, 0.0, 0, 0, 1), (35, 0.2, 26, 0.0, 4, 1.0, 0, 0, 1),
        (8, 0.0, 3, 1.0, 55, 0.0, 0, 0, 1), (6, 0.0, 60, 0.0, 70, 0.0, 0, 0, 1), (10, 0.0, 44, 0.0, 38, 0.0, 0, 0, 1),
        (48, 0.0, 8, 0.0, 51, 0.0, 0.5, 0, 1), (75, 0.05, 40, 0.0, 33, 0.1, 0.5, 0, 1), (60, 0.0, 0, 0.0, 0, 0.0, 0.5, 0, 1),
        (35, 0.0, 26, 0.0, 4, 1.0, 0.5, 0, 1), (52, 0.0, 8, 0.0, 51, 0.0, 0.5, 1, 1), (80, 0.1, 40, 0.0, 33, 0.1, 0.5, 1, 1),
        (3, 1.0, 4, 1.0, 3, 1.0, 0.5, 0, 0), (5, 0.0, 3, 1.0, 4, 1.0, 0.5, 0, 0), (30, 0.8, 10, 0.5, 25, 0.9, 0.5, 0, 0),
        (9, 0.0, 2, 0.0, 3, 0.0, 0.5, 1, 0), (8, 0.0, 3, 1.0, 55, 0.0, 0.5, 0, 1), (7, 0.0, 3, 1.0, 55, 0.0, 0.5, 1, 1),
        (1, 1.0, 1, 1.0, 50, 0.0, 0.5, 0, 0), (2, 1.0, 40, 0.0, 1, 1.0, 0.5, 0, 0), (2, 1.0, 45, 0.0, 60, 0.0, 0.5, 1, 0),
        (60, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (26, 0.0, 5, 1.0, 4, 1.0, 0, 0, 1), (5, 0.0, 0, 0.0, 45, 0.0, 0, 0, 1),
    ]
)


def grow(table: np.ndarray, depth: int = 6) -> tuple | float:
    """A tree of (feature, threshold, at most, above) with leaf shares, by the largest fall in impurity."""
    label = table[:, -1]
    share = float(label.mean())
    if share in (0, 1) or not depth:
        return share
    best = None
    for feature in range(FEATURES):
        values = np.unique(table[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            low = table[:, feature] <= cut
            impurity = sum(part.size * part.mean() * (1 - part.mean()) for part in (label[low], label[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, cut)
    if best is None:
        return share
    low = table[:, best[1]] <= best[2]
    return best[1], float(best[2]), grow(table[low], depth - 1), grow(table[~low], depth - 1)


#: The first splits are by the mark, so that blocks of one mark do not move the cuts of another.
MARK = 6
_by_mark = [grow(LABELLED[LABELLED[:, MARK] == mark]) for mark in (0, 0.5, 1)]
TREE = (MARK, 0.25, _by_mark[0], (MARK, 0.75, _by_mark[1], _by_mark[2]))


def shares(tree: tuple | float, rows: np.ndarray) -> np.ndarray:
    """The leaf share of each row of features."""
    if not isinstance(tree, tuple):
        return np.full(len(rows), tree)
    feature, cut, low_tree, high_tree = tree
    low, out = rows[:, feature] <= cut, np.empty(len(rows))
    out[low], out[~low] = shares(low_tree, rows[low]), shares(high_tree, rows[~low])
    return out


#: Marks of an element: none, of the layout, by name, and for good.
CLEAR, LAYOUT, NAMED_SO, FIXED = range(4)


def furniture(tag: str, attrs: str, in_article: bool) -> int:
    if tag in ARTICLE_TAGS or tag in ("body", "html"):
        return CLEAR
    if tag in FURNITURE_TAGS or (not in_article and tag in OUTER_FURNITURE_TAGS):
        return FIXED
    return named(attrs, in_article)


def named(attrs: str, in_article: bool) -> int:
    """The mark by class, id and role."""
    names: set[str] = set()
    if "=" in attrs:
        for m in NAMED.finditer(attrs):
            names.update(NAME.findall((m[1] or m[2] or m[3] or "").lower()))
    if FURNITURE_NAMES.isdisjoint(names) and (in_article or OUTER_FURNITURE_NAMES.isdisjoint(names)):
        return CLEAR
    if not REPEATED_NAMES.isdisjoint(names):
        return FIXED
    return NAMED_SO if LAYOUT_NAMES.isdisjoint(names) else LAYOUT


class Reader:
    """Blocks of one page in order: (text, words, words in links, furniture, article)."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, int, int, float, bool]] = []
        self.pieces: list[tuple[str, bool]] = []
        self.open: list[tuple[str, int, bool]] = []  # tag, mark, article
        self.depth: dict[str, int] = {}
        self.marks, self.n_article = [0] * 4, 0
        self.outside: list[list[int]] = []  # marks around each open article

    def end_block(self) -> None:
        if not self.pieces:
            return
        text = " ".join("".join([p for p, _ in self.pieces]).split())
        if text:
            linked = sum(len(p.split()) for p, link in self.pieces if link)
            n = text.count(" ") + 1
            self.blocks.append((text, n, min(linked, n), self.mark(), self.n_article > 0))
        self.pieces = []

    def mark(self) -> float:
        _, layout, by_name, fixed = self.marks
        return 1.0 if by_name or fixed else 0.5 if layout else 0.0

    def text(self, text: str) -> None:
        if text:
            self.pieces.append((references.unescape(text) if "&" in text else text, self.depth.get("a", 0) > 0))

    def pop(self) -> str:
        tag, mark, article = self.open.pop()
        self.depth[tag] -= 1
        self.n_article -= article
        if article:
            self.marks = self.outside.pop()
        self.marks[mark] -= 1
        return tag

    def start(self, tag: str, attrs: str) -> None:
        if tag in BLOCK_TAGS:
            self.end_block()
            while tag != "p" and self.depth.get("p") and self.open[-1][0] not in BLOCK_TAGS - {"p"}:
                if self.pop() == "p":
                    break
        elif tag in SPACE_TAGS:
            self.pieces.append((" ", False))
        if tag in VOID_TAGS or attrs.endswith("/"):
            return
        if tag == "p" and self.depth.get("p") and "p" == self.open[-1][0]:
            self.pop()
        mark, article = furniture(tag, attrs, self.n_article > 0), tag in ARTICLE_TAGS
        self.open.append((tag, mark, article))
        self.depth[tag] = self.depth.get(tag, 0) + 1
        self.marks[mark] += 1
        if article:
            self.outside.append(list(self.marks))
            own = tag == "article" and named(attrs, True) != CLEAR
            if not self.n_article and not self.marks[FIXED] and not own:
                self.marks = [0, int(tag == "article" and self.marks[NAMED_SO] > 0), 0, 0]
        self.n_article += article

    def end(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.end_block()
        if self.depth.get(tag):
            while self.pop() != tag:
                pass

    def read(self, page: str) -> list[tuple[str, int, int, float, bool]]:
        at = 0
        for m in TOKEN.finditer(page):
            self.text(page[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag and (m.end() < len(page) or page[-1] == ">"):
                tag = tag.lower()
                self.end(tag) if m["close"] else self.start(tag, m["attrs"])
        self.text(page[at:])
        self.end_block()
        return self.blocks


def main_texts(pages: list[str]) -> list[str]:
    blocks = [Reader().read(p) for p in pages]
    flat = [b for own in blocks for b in own]
    if not flat:
        return [""] * len(pages)
    n = np.array([b[1] for b in flat], float)
    link = np.array([b[2] for b in flat]) / n
    page = np.repeat(np.arange(len(pages)), [len(own) for own in blocks])
    rows = np.zeros((len(flat), FEATURES))
    rows[:, 0], rows[:, 1] = n, link
    same = page[1:] == page[:-1]
    rows[1:, 2], rows[1:, 3] = n[:-1] * same, link[:-1] * same
    rows[:-1, 4], rows[:-1, 5] = n[1:] * same, link[1:] * same
    rows[:, 6], rows[:, 7] = [b[3] for b in flat], [b[4] for b in flat]
    keep, out, at = shares(TREE, rows) > 0.5, [], 0
    for own in blocks:
        out.append("\n\n".join([b[0] for b, k in zip(own, keep[at : at + len(own)], strict=True) if k]))
        at += len(own)
    return out


def with_main_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` with ``main_text``."""

    def run(column):
        return [pa.array(main_texts([p or "" for p in column.to_pylist()]), pa.string())]

    return W.with_columns(pages, page, run, "main_text string")


def op8_main_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return with_main_text(pages).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
