"""Main text of HTML pages by tree scoring (operator 5).

A page is parsed into a tree (implied and missing end tags included). Elements that are not
article text by tag, role, class or id are cut off. A name says less than a tag: words after "has-",
"no-" and the like do not count, an ambiguous name ("legal", "notice") does not cut the only element
with paragraphs, and a form that wraps paragraphs of a page is a container like others. Every block with text of its own passes
points for its length and commas to its ancestors, halved and thinned with the distance; an
ancestor's points are discounted by its link density. The best container is widened to the
article element around it, else to the outermost main element or element named as content, of
which every block is kept that is not mostly links. Without either, its siblings with enough
points of their own are kept. The text is read off block by block.

One pass over whole pages, without a shuffle. Edge cases: null or empty html gives an empty
text; white space is every blank that Unicode names; of equally good containers the first on the
page counts; pages of any length are read whole; html without tags is one block; unclosed comments, tags and elements run to the end;
very deep pages are read without recursion; columns of any other name do not matter; repeated rows are separate rows; an empty table
gives an empty result.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.llm.common import ready_workers

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
option p pre section select summary table tbody td tfoot th thead tr ul""".split())
CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"),
          "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPE = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "option": ("select",)}
# What is not article text.
CUT_TAGS = RAW | frozenset("""head nav footer aside form template object applet svg canvas button select
input label fieldset menu dialog audio video map""".split())
CUT_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alertdialog alert menu
menubar toolbar form status""".split())
CUT_WORDS = frozenset("""ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo
promotion sidebar sidebars rail comment comments commentlist disqus reply replies respond cookie cookies
consent gdpr notice notices notification alert newsletter subscribe subscription signup paywall popup modal
overlay menu menus nav navbar navigation breadcrumb breadcrumbs footer foot masthead share sharing
social related recommended recommendations recirc outbrain taboola widget widgets toolbar pagination pager
login search skip copyright legal disclaimer tags hidden""".split())
# Names of CUT_WORDS that articles bear as well, and prefixes after which a name tells what an element
# has or has not, not what it is.
UNSURE_WORDS = frozenset("""legal copyright disclaimer notice notices notification alert widget widgets modal overlay popup
social search promo promotion sponsored related recommended skip tags share sharing""".split())
BESIDE = re.compile(r"^(?:has|have|no|not|non|with|without|is|hide|show|below|above|js|can|enable|disable)[-_]")
PARAGRAPH = 80       # characters of a block that reads like a paragraph
FEW_PARAGRAPHS = 3   # so many make a wrapping form, or the only named element with text, a container
HEAD_WORDS = frozenset(["header", "head", "topbar", "banner"])
ARTICLE_WORDS = frozenset("article post story entry content main body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)
|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)
|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S | re.X)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"([a-z])([A-Z])")


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "unsure", "named", "points", "chars", "linked")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False, named: bool = False, unsure: bool = False):
        self.tag, self.parent, self.cut, self.named, self.unsure = tag, parent, cut, named, unsure
        self.children: list = []
        self.points = 0.0
        self.chars = self.linked = 0


def _marks(tag: str, attrs: str, inside_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element is cut off, whether its name says that it holds the article, and whether
    the cut is unsure (see ``uncut``)."""
    if tag in CUT_TAGS and tag != "form" or (tag == "header" and not inside_article):
        return True, False, False
    if not attrs:
        return tag == "form", tag in ("article", "main"), tag == "form"
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)}
    role = found.get("role", "").lower()
    names = CAMEL.sub(r"\1 \2", found.get("class", "") + " " + found.get("id", "")).lower().split()
    words = set(WORD.findall(" ".join(n for n in names if not BESIDE.match(n))))
    shown = not ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
                 or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I))
    if tag in ("html", "body", "article", "main"):
        return not shown and tag in ("article", "main"), tag in ("article", "main"), False
    heads = words & HEAD_WORDS and not inside_article and tag not in ("h1", "h2", "h3")
    sure = not shown or role in CUT_ROLES or bool(heads) or bool(words & CUT_WORDS - UNSURE_WORDS)
    cut = sure or tag == "form" or bool(words & CUT_WORDS)
    return cut, role in ("main", "article") or bool(words & ARTICLE_WORDS) and tag in ("div", "section"), cut and not sure


def parse(page: str) -> Node:
    """The page as a tree; text nodes are decoded strings."""
    root = node = Node("#root", None)
    at, end = 0, len(page)
    article = 0  # open article and main elements
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            node.children.append(html.unescape(page[at:lt]))
        if lt == end:
            break
        m = TOKEN.match(page, lt)
        if not m:
            node.children.append("<")
            at = lt + 1
            continue
        at = m.end()
        if m[1]:  # end tag: closes the nearest open element of that name, if any
            tag, up = m[1].lower(), node
            while up is not root and up.tag != tag:
                up = up.parent
            while up is not root and node is not up.parent:
                article -= node.tag in ("article", "main")
                node = node.parent
            continue
        tag = (m[2] or m[4] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                node.children.append(m[0][9:].removesuffix("]]>"))
            continue
        attrs = (m[3] if m[2] else m[5]) or ""
        closes = (*CLOSES.get(tag, ()), *(("p",) if tag in BLOCK else ()))
        if closes:  # implied end tags
            up, stop = node, SCOPE.get(tag, ("table",) if tag in CLOSES else ())
            while up is not root and up.tag not in stop and up.tag not in closes and (
                    up.tag not in BLOCK or tag in CLOSES and up.tag in ("p", "tr", "td", "th", "thead", "tbody")):
                up = up.parent
            if up.tag in closes and up is not root:
                while node is not up.parent:
                    article -= node.tag in ("article", "main")
                    node = node.parent
        child = Node(tag, node, *_marks(tag, attrs, article > 0))
        node.children.append(child)
        if tag in RAW:
            close = re.compile(f"</{tag}[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not SELF_CLOSED.search(attrs):  # a slash may end an unquoted value
            article += tag in ("article", "main")
            node = child
    return root


def _walk(top: Node):
    """(node or text, entering) in page order, cut elements left out, without recursion."""
    stack = [(top, True)]
    while stack:
        item, entering = stack.pop()
        yield item, entering
        if entering and isinstance(item, Node):
            stack.append((item, False))
            stack.extend((c, True) for c in reversed(item.children) if not (isinstance(c, Node) and c.cut))


def blocks(top: Node) -> list[tuple[str, Node, int]]:
    """Texts of the blocks below ``top`` in page order: (text, block element, chars in links)."""
    out, buffer, linked, links, holder = [], [], 0, 0, top
    open_blocks = [top]

    def flush():
        nonlocal buffer, linked
        text = " ".join("".join(buffer).split())
        if text:
            out.append((text, open_blocks[-1], linked))
        buffer, linked = [], 0

    for item, entering in _walk(top):
        if isinstance(item, str):
            if entering:
                buffer.append(item)
                linked += links * len(item.strip())
        elif item.tag in ("br", "wbr"):
            if entering:
                buffer.append(" " if item.tag == "br" else "")
        elif item.tag in BLOCK and item is not top:
            flush()
            open_blocks.append(item) if entering else open_blocks.pop()
        elif item.tag == "a":
            links = 1 if entering else 0
    flush()
    return out


def _near(node: Node, most: int = 6):
    """Ancestors of a block, itself first, with the share of its points that they get."""
    share = (1.0, 1.0, 0.5)
    up, k = node, 0
    while up is not None and k < most:
        yield up, share[k] if k < 3 else 1 / (3 * (k - 1))
        up, k = up.parent, k + 1


def _paragraphs(top: Node) -> int:
    return sum(len(text) >= PARAGRAPH and linked < 0.5 * len(text) for text, _, linked in blocks(top))


def uncut(root: Node) -> None:
    """Take back unsure cuts: of forms that hold paragraphs, and, while the rest of the page
    holds none, of the named element that holds most of them (of equal ones the first)."""
    unsure, stack = [], [root]
    while stack:
        node = stack.pop()
        for child in reversed(node.children):
            if isinstance(child, Node):
                if child.unsure:
                    unsure.append(child)
                if not child.cut or child.unsure:
                    stack.append(child)
    for node in unsure:
        if node.tag == "form" and _paragraphs(node) >= FEW_PARAGRAPHS:
            node.cut = False
    while not _paragraphs(root):
        held = [(_paragraphs(node), -i) for i, node in enumerate(unsure) if node.cut]
        most, at = max(held, default=(0, 0))
        if most < FEW_PARAGRAPHS:
            return
        node = unsure[-at]
        while node is not None:  # it counts once nothing unsure around it is cut
            node.cut = node.cut and not node.unsure
            node = node.parent


def best_container(root: Node) -> Node:
    found = blocks(root)
    scored: dict[int, Node] = {}
    for text, block, linked in found:
        points = (len(text) >= 25) + text.count(",") + min(len(text) / 100, 3)
        # A paragraph is read through its container; a container with bare text is one itself.
        own = block.tag in ("div", "section", "article", "main", "body", "td", "#root")
        for up, share in _near(block if own or block.parent is None else block.parent):
            up.points += points * share
            scored[id(up)] = up
        up = block
        while up is not None:
            up.chars += len(text)
            up.linked += linked
            up = up.parent
    best, most = root, -1.0
    for node in scored.values():
        value = node.points * (1 - min(1, node.linked / max(1, node.chars)))
        value *= {"article": 2.0, "main": 1.5}.get(node.tag, 1.25 if node.named else 1.0)
        node.points = value
        if value > most:
            best, most = node, value
    up = best.parent
    while up is not None:  # the whole article element around the best container
        if up.tag == "article":
            best = up
        up = up.parent
    return best


def content_holder(best: Node) -> Node | None:
    """The outermost element around a container, or itself, whose name says that it holds the article."""
    holder, up = None, best
    while up is not None:
        if up.named:
            holder = up
        up = up.parent
    return holder


def _inside(node: Node | None, top: Node) -> bool:
    while node is not None and node is not top:
        node = node.parent
    return node is top


def main_text(page: str | None) -> str:
    """The article's text: white space made single, blocks joined by a line feed."""
    if not page:
        return ""
    root = parse(page)
    uncut(root)
    best = best_container(root)
    around = best.parent
    if around is None or best.tag == "article":
        return "\n".join(t for t, *_ in blocks(best))
    holder = content_holder(best)
    if holder is not None:
        return "\n".join(text for text, block, linked in blocks(holder)
                         if linked < 0.5 * len(text) or block.tag in HEADINGS or _inside(block, best))
    out = []
    for node in around.children:
        if not isinstance(node, Node) or node.cut:
            continue
        density = node.linked / max(1, node.chars)
        heading = node.tag in ("h1", "h2") and around.tag != "#root"
        long = node.tag in ("p", "blockquote", "pre") and node.chars >= 80 and density < 0.25
        if node is best or heading or long or node.points >= max(10, 0.2 * best.points) and density < 0.5:
            out += [t for t, *_ in blocks(node)]
    return "\n".join(out)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    ready_workers(pages.sparkSession)

    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(main_text, na_action=None)

    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("page"))
    return (own.withColumn("text", texts("page"))
            .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")))
